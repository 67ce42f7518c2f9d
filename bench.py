"""Times the registered queries: ``BENCH_SF_DIR=... BENCH_CPUS=8 python bench.py [name...]``.

Prints one JSON line. All queries run twice to warm up; timed is a third, full run of each. The questions
named ``*_mart`` read marts that were written before, as they do in use; building them is timed by the two summaries.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import SNAPSHOT_DAY, queries  # noqa: E402
from landmart.plans import analyst  # noqa: E402

HEADLINE = (
    "owner_daily_summary", "land_type_daily_summary", "parcel_area", "parcel_account_type",
    "owner_weighted_area", "residential_acres_raw", "residential_acres_mart", "owners_by_residential_raw",
    "owners_by_residential_mart", "owners_by_property_count_raw", "owners_by_property_count_mart",
    "geodesic_area", "dq_unknown_parcel", "dq_unowned_parcel", "dq_overallocated",
)


def seconds(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def on_written_marts(spark: SparkSession, sf_dir: str, folder: str) -> dict:
    """The mart questions over the two marts, written once."""
    built = {name: queries()[name](spark, sf_dir) for name in ("owner_daily_summary", "land_type_daily_summary")}
    for name, df in built.items():
        df.repartitionByRange("report_date").sortWithinPartitions("report_date").write.parquet(f"{folder}/{name}")
    owners, types = (spark.read.parquet(f"{folder}/{name}") for name in built)
    return {
        "residential_acres_mart": lambda *_: analyst.residential_acres_mart(types, SNAPSHOT_DAY),
        "owners_by_residential_mart": lambda *_: analyst.owners_by_residential_mart(owners, SNAPSHOT_DAY),
        "owners_by_property_count_mart": lambda *_: analyst.owners_by_property_count_mart(owners, SNAPSHOT_DAY),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        # the queries together compile more stages than the default cache keeps
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.TemporaryDirectory(prefix="landmart-bench-")
    registered = queries() | on_written_marts(spark, sf_dir, folder.name)
    names = sys.argv[1:] or HEADLINE
    for _ in range(2):
        for name in names:
            seconds(registered[name](spark, sf_dir))
    timings = {name: round(seconds(registered[name](spark, sf_dir)), 3) for name in names}
    print(json.dumps({
        "metric": "headline queries, total wall time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
