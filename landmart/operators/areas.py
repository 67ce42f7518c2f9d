"""Land area per parcel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parcel_area(parcels: DataFrame, *keys: str) -> DataFrame:
    """Sum of feature areas per parcel and snapshot (or per the given keys).

    Partial sums run before the shuffle, so a parcel with very many features stays cheap.
    """
    keys = keys or ("parcel_id", "file_index")
    return parcels.groupBy(*keys).agg(F.sum("area_m2").alias("area_m2"))


def area_per_parcel(parcels: DataFrame) -> DataFrame:
    """Parcel areas from features, for a join with ownership."""
    return one_row_per(parcels, "parcel_id", "file_index", area_m2=F.sum("area_m2"))


def one_row_per(df: DataFrame, *keys: str, **aggregates) -> DataFrame:
    """Aggregate by ``keys`` into the single-row side of a join with a possibly skewed side.

    Grouping by one struct hides the result's partitioning from the join, which then shuffles
    both sides afresh. Adaptive execution splits a hot key's partition only in that shape: an
    aggregate between the shuffle and the join would leave all rows of the hot key to one task.
    The extra shuffle moves one narrow row per key.
    """
    packed = df.dropna(subset=list(keys)).groupBy(F.struct(*keys).alias("key"))
    columns = [expr.alias(name) for name, expr in aggregates.items()]
    grouped = packed.agg(*columns) if columns else packed.agg(F.lit(1).alias("present")).drop("present")
    return grouped.select("key.*", *aggregates)
