"""Choosing snapshots, as DataFrames of snapshot ids."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_snapshot_date(text: str) -> str:
    """``yyyy-mm-dd`` to a snapshot id; unpadded or impossible dates raise."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"not a yyyy-mm-dd date: {text!r}")
    return date.fromisoformat(text).strftime("%Y%m%d")


def select_snapshots(landed: DataFrame, choice: str = "today", today: date | None = None) -> DataFrame:
    """Requested snapshots among the landed ones: ``today``, ``latest``, ``all`` or one date."""
    ids = landed.select("file_index").distinct()
    if choice == "all":
        return ids
    if choice == "latest":
        return ids.agg(F.max("file_index").alias("file_index")).dropna()
    wanted = (today or date.today()).strftime("%Y%m%d") if choice == "today" else parse_snapshot_date(choice)
    return ids.filter(F.col("file_index") == wanted)


def pending_snapshots(requested: DataFrame, loaded: DataFrame) -> DataFrame:
    """Requested snapshots that have no row in the target yet."""
    return requested.join(loaded.select("file_index").distinct(), "file_index", "left_anti")
