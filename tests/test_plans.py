"""Physical plans: what is read, what is shuffled, and that hot keys are split."""

import contextlib
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import bindings, registry
from landmart.plans import analyst, marts
from landmart.plans.tables import commit, create_tables, write_snapshots, write_version
from landmart.session import configure
from tests.test_load_jobs import places  # noqa: F401

SF = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    names = {key: "spark.sql." + key.replace("__", ".") for key in values}
    before = {name: spark.conf.get(name, None) for name in names.values()}
    for key, name in names.items():
        spark.conf.set(name, values[key])
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after adaptive execution has run."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the ownership rows on one parcel, another third with one owner, one snapshot large."""
    rows = spark.range(0, 60000, 1, 8)
    n = F.col("id")
    owners = rows.select(
        n.cast("string").alias("account_id"),
        F.when(n % 3 == 0, "HOT").otherwise((n % 5000).cast("string")).alias("parcel_id"),
        (n % 5 > 0).alias("is_real_property"),
        F.when(n % 3 == 1, "HOT").otherwise((n % 20011).cast("string")).alias("owner_name"),
        (F.lit(1) / (n % 4 + 1)).cast("decimal(10,3)").alias("pct_own"),
        F.when(n % 2 == 0, "RESIDENTIAL").otherwise("EXEMPT").alias("account_type"),
        F.when(n % 10 == 0, "20210525").otherwise("20210526").alias("file_index"),
    )
    parcels = spark.range(0, 5001, 1, 4).crossJoin(
        spark.createDataFrame([("20210525",), ("20210526",)], "file_index string")
    ).select(
        F.when(n == 5000, "HOT").otherwise(n.cast("string")).alias("parcel_id"),
        (n % 100 + 1).cast("decimal(12,2)").alias("area_m2"), "file_index",
    )
    return owners, parcels


SKEWED_JOINS = {
    "owner_daily_summary": marts.owner_daily_summary,
    "land_type_daily_summary": marts.land_type_daily_summary,
    "owners_by_residential_raw": lambda o, p: analyst.owners_by_residential_raw(o, p, "20210526"),
    "owners_by_property_count_raw": lambda o, p: analyst.owners_by_property_count_raw(o, p, "20210526"),
}


@pytest.mark.parametrize("name", SKEWED_JOINS)
def test_hot_parcel_is_split(spark, skewed, name):
    build = SKEWED_JOINS[name]
    with settings(spark, adaptive__enabled="false", autoBroadcastJoinThreshold="-1"):
        expected = sorted(map(tuple, build(*skewed).collect()), key=repr)
    with settings(
        spark, adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="2.0", adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__autoBroadcastJoinThreshold="-1", autoBroadcastJoinThreshold="-1", shuffle__partitions="8",
        adaptive__coalescePartitions__enabled="false",  # or this little data ends up in one task
    ):
        df = build(*skewed)
        assert "skew=true" in final_plan(df)
        assert sorted(map(tuple, df.collect()), key=repr) == expected


@pytest.mark.parametrize("limit, join", [(None, "ShuffledHashJoin"), ("100", "SortMergeJoin")])
def test_a_side_is_hashed_only_if_small(spark, skewed, limit, join):
    """Unless a partition of either side is larger than the limit; 100 bytes are less than the advisory size."""
    more = {"adaptive__maxShuffledHashJoinLocalMapThreshold": limit} if limit else {}
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", **more):
        for build in (marts.owner_daily_summary, marts.land_type_daily_summary):
            assert set(re.findall(r"ShuffledHashJoin|SortMergeJoin", final_plan(build(*skewed)))) == {join}


def test_owner_mart_plan(spark):
    text = plan(marts.owner_daily_summary(bindings.owners(spark, SF), bindings.parcels(spark, SF)))
    assert "Expand" not in text  # distinct counts do not multiply rows
    assert len(re.findall(r"\+- Window |- Window ", text)) == 1  # both changes share one window and sort
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - {"csv_records", "wkb_vertices"}))
def test_queries_stay_in_the_jvm_and_join_on_keys(spark, name):
    text = plan(registry.queries()[name](spark, SF))
    for operator in ("Python", "Arrow", "CartesianProduct", "NestedLoop"):
        assert operator not in text


def test_top_rows_are_not_fully_sorted(spark):
    df = analyst.owners_by_property_count_raw(
        bindings.owners(spark, SF), bindings.parcels(spark, SF), "19980301", top=5
    )
    assert "TakeOrderedAndProject" in plan(df)


def test_raw_tables_prune_snapshots_and_columns(spark, places, skewed):  # noqa: F811
    create_tables(spark, places[1])
    owners, parcels = skewed
    missing = ["lot", "status_cd", "address", "address_unit", "city"]
    filled = owners.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])
    write_snapshots(filled.withColumn("created_at", F.current_timestamp()), "raw.owners", [], mixed=True)
    features = parcels.select(
        "parcel_id", F.col("area_m2").cast("double"), "file_index",
        *[F.lit(None).alias(c) for c in ("object_id", "shape_area", "shape_len", "geom")],
    )
    write_snapshots(features, "raw.parcels", [], mixed=True)
    df = analyst.owners_by_property_count_raw(spark.table("raw.owners"), spark.table("raw.parcels"), "20210526")
    scans = [line for line in plan(df).splitlines() if "FileScan" in line]
    owner_scan = next(line for line in scans if "owner_name" in line)
    assert "PartitionFilters: [isnotnull(file_index" in owner_scan and "address" not in owner_scan
    assert all("geom" not in line for line in scans)
    mart = marts.owner_daily_summary(spark.table("raw.owners"), spark.table("raw.parcels"))
    assert all("geom" not in line and "address" not in line for line in plan(mart).splitlines())


def test_several_snapshots_are_rebalanced(spark, skewed):
    hinted = skewed[0].hint("rebalance", "file_index")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(hinted)


def test_mart_of_one_day_reads_its_partition(spark, places, skewed):  # noqa: F811
    create_tables(spark, places[1])
    owners, parcels = skewed
    days = spark.range(30).select(F.concat(F.lit("202106"), F.lpad((F.col("id") + 1).cast("string"), 2, "0")).alias("file_index"))
    some = owners.filter("owner_name <> 'HOT' AND account_id < 2000").drop("file_index").crossJoin(days)
    areas = parcels.select("parcel_id", "area_m2").distinct().crossJoin(days)
    name = "marts.owner_daily_summary"
    found = write_version(marts.owner_days(some, areas, None, None), name, "v", mixed=True)
    assert len(found) == 30
    commit(spark, {name: dict.fromkeys(found, "v")})
    day = analyst.owners_by_property_count_mart(spark.table(name), date(2021, 6, 7))
    assert re.search(r"PartitionFilters: \[.*\(report_date#\d+ = 2021-06-07\)", plan(day))
    # one day's partition is there, in one file
    assert len(day.collect()) > 2 and len(spark.read.parquet(*[f"{places[1]}/marts/owner_daily_summary/version=v/report_date=2021-06-07"]).inputFiles()) == 1


def test_rebuild_reads_stored_areas(spark, places):  # noqa: F811
    create_tables(spark, places[1])
    tables = [spark.table(f"raw.{name}") for name in ("owners", "parcels", "parcel_areas")]
    for build in (marts.owner_daily_summary, marts.land_type_daily_summary):
        scans = {re.search(r"raw\.(\w+)_versions", line)[1] for line in plan(build(*tables)).splitlines() if "FileScan" in line}
        assert scans == {"owners", "parcel_areas"}


def test_tasks_are_small_unless_the_session_says_otherwise(spark):
    keys = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    before = [spark.conf.get(key, None) for key in keys]
    try:
        for given, found in ((None, ["16m", "32m"]), ("5m", ["5m", "5m"])):
            for key in keys:
                spark.conf.unset(key) if given is None else spark.conf.set(key, given)
            assert [configure(spark).conf.get(key) for key in keys] == found
    finally:
        for key, value in zip(keys, before):
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
