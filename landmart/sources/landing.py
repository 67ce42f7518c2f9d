"""What has landed: one folder per snapshot, named yyyyMMdd, below a landing root."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_PATH = r"/(\d{8})/((?:Parcels/)?[^/]+)$"


def qualified(spark: SparkSession, root: str) -> str:
    """The root as listings spell it: with its file system, absolute."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def snapshot_of(path: Column) -> Column:
    return F.regexp_extract(path, SNAPSHOT_PATH, 1)


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Files of the snapshot folders right below ``root`` as (path, file_index, name), without opening
    any of them.

    Two levels are listed, the snapshot folders and their ``Parcels``; nothing below, however much there is. Hidden names and
    folders that are no snapshot id are left out. A folder without files does not count as landed.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    top = fs.Path(qualified(spark, root))
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(folder) -> list[tuple[str, bool, object]]:
        found = [(x.getPath().getName(), x.isDirectory(), x.getPath()) for x in system.listStatus(folder)]
        return sorted((x for x in found if not x[0].startswith((".", "_"))), key=lambda x: x[0])

    rows = []
    for day, is_folder, folder in listed(top):
        if not (is_folder and re.fullmatch(r"\d{8}", day, re.ASCII)):
            continue
        inside = listed(folder)
        files = [(name, path) for name, deeper, path in inside if not deeper]
        for name, deeper, path in inside:
            if deeper and name == "Parcels":
                files += [(f"Parcels/{x}", below) for x, again, below in listed(path) if not again]
        rows += [(path.toString(), day, name) for name, path in files]
    return spark.createDataFrame(rows, "path string, file_index string, name string")
