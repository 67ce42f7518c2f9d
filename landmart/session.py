"""Session settings the jobs rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings only; sizing (executors, memory, shuffle partitions) stays with the cluster.
SETTINGS = {
    # bad numbers, dates and overflows raise instead of turning into NULL
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # snapshot ids are text, also when read back from folder names
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # replacing a snapshot leaves the other snapshots alone
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a task that holds few snapshots writes them side by side, without sorting its rows first
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot parcel's join partition even if the aggregation above then needs a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Used unless the session has a value of its own.
DEFAULTS = {
    # sorting, joining and grouping in one task take some 25 times the bytes that its shuffle delivers
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # grouping before a shuffle holds most rows that a task reads, some 17 times their bytes in a file
    "spark.sql.files.maxPartitionBytes": "32m",
    # a join whose one side is at most two tasks' shuffle in every partition hashes it instead of sorting both
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


#: Lets Spark drop the shuffle files of a query as soon as the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffles of what is run within go at once."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def build_session(app_name: str = "landmart", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in extra.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
