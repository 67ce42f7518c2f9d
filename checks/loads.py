"""Queries that load the given tables into a warehouse of their own and read what is there afterwards.

The tables go through the same jobs as landed files do: files are landed, loaded and replaced, marts are rebuilt.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import bindings as b
from landmart.operators.areas import parcel_area
from landmart.plans import jobs, quality
from landmart.plans.tables import create_tables, drop_tables, location, versions, write_snapshots
from landmart.schemas import OWNER_FILE_COLUMNS, RAW_OWNERS, TABLES_BY_NAME
from landmart.session import dropped_shuffles
from landmart.sources.owner_csv import DIALECT

#: Rows of a landed file, about: a file is written by one task.
FILE_ROWS = 1_000_000
#: Rows that are landed and loaded at a time, at least, and how many rounds there are at most, about.
ROUND_ROWS = 2_000_000
ROUNDS = 10


def _folder(spark: SparkSession, name: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="landmart-checks-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _kept(spark: SparkSession, name: str) -> DataFrame:
    """A table's rows by the files in use, so that the catalog can forget it."""
    key = "file_index" if name.startswith("raw") else "report_date"
    layout, folder = TABLES_BY_NAME[name], location(spark, name)
    paths = [f"{folder}/version={version}/{key}={part}" for part, version in versions(spark).get(name, {}).items()]
    return spark.read.schema(layout).option("basePath", folder).parquet(*paths).select(layout.names)


def marts_after_replacement(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A mart whose snapshots came out of order: some first with wrong rows, then replaced, the newest last, and one
    that is emptied and loaded again. It is rebuilt three times, each time from the earliest change on."""
    drop_tables(spark)
    create_tables(spark, _folder(spark, "warehouse"))
    missing = [f.name for f in RAW_OWNERS.fields if f.name not in b.owners(spark, d).columns]
    owners = b.owners(spark, d).withColumns({x: F.lit(None) for x in missing})
    areas = parcel_area(b.parcels(spark, d))
    year = F.substring("file_index", 1, 4)
    is_wrong = year == "1995"
    some_wrong = owners.withColumns({
        "pct_own": F.when(is_wrong, F.col("pct_own") / 2).otherwise(F.col("pct_own")),
        "owner_name": F.concat("owner_name", F.when(is_wrong, "?").otherwise("")),
    })

    def load(rows: DataFrame, table: str, replaced: list[str] = []) -> None:  # noqa: B006
        write_snapshots(rows, table, replaced, mixed=True)

    load(some_wrong.filter(year != "1998"), "raw.owners")
    load(areas, "raw.parcel_areas")
    jobs.rebuild(spark)
    load(owners.filter(year == "1995"), "raw.owners")
    load(owners.filter(year == "1994").limit(0), "raw.owners", ["19940301"])
    jobs.rebuild(spark)
    load(owners.filter((year == "1998") | (F.col("file_index") == "19940301")), "raw.owners")
    jobs.rebuild(spark)
    found = _kept(spark, name)
    drop_tables(spark)
    return found


def _rounds(counts: dict[str, int]) -> list[dict[str, range]]:
    """The files to land in each round, by year: about as many rows in each, the years in order. ``counts`` are a year's rows."""
    size = max(ROUND_ROWS, -(-sum(counts.values()) // ROUNDS))
    rounds: list[dict[str, range]] = []
    room = 0.0
    for year, n in sorted(counts.items()):
        files = _files(n)
        for k in range(files):
            if room <= 0:
                rounds.append({})
                room = size
            first = rounds[-1].get(year, range(k, k)).start
            rounds[-1][year] = range(first, k + 1)
            room -= n / files
    return rounds


def _files(rows: int) -> int:
    return min(365, -(-rows // FILE_ROWS))


def landed_owner_rows(spark: SparkSession, d: str) -> DataFrame:
    """Ownership files of every year, landed, found, read and loaded: quoted names with line breaks, so that the files are
    cut into records by quotes. A year of more than about ``FILE_ROWS`` rows lands as several snapshots, one a day from its first
    day on, and counts as one again in the result. Rows that a load would collapse share a file. Files land and are loaded in
    rounds, the oldest first; those of a round go when the next one lands."""
    landing, warehouse = _folder(spark, "landing"), _folder(spark, "warehouse")
    staged = b.staged_owner_file(spark, d).withColumn("created_date", F.col("created_date").cast("date").cast("string"))
    staged = staged.withColumn("owner_name", F.concat("owner_name", F.lit('\n"'), F.col("status_cd"), F.lit('", heir')))
    staged = staged.withColumn("year", F.substring("file_index", 1, 4))
    with dropped_shuffles(spark):
        found = staged.filter("year IS NOT NULL").groupBy("year").count().collect()  # one row per year
    counts = {r["year"]: r["count"] for r in found}
    # as written: a cell's outer blanks go
    alike = F.xxhash64("folio", "pct_own", F.regexp_replace("owner_name", "[\\x00-\\x20]+", ""))
    first = F.to_date(F.concat("year", F.lit("0101")), "yyyyMMdd")
    columns = [(F.col(x) if x in staged.columns else F.lit(None).cast("string")).alias(x) for x in OWNER_FILE_COLUMNS]
    options = {k: v for k, v in DIALECT.items() if k != "nullValue"} | {"emptyValue": '""'}
    fs = spark._jvm.org.apache.hadoop.fs
    system = fs.Path(landing).getFileSystem(spark._jsc.hadoopConfiguration())
    drop_tables(spark)
    for files in _rounds(counts) or [{}]:
        system.delete(fs.Path(landing), True)
        here, k = F.lit(False), F.lit(0)
        for year, some in files.items():
            n = _files(counts[year])
            k = F.when(F.col("year") == year, F.pmod(alike, F.lit(n)).cast("int")).otherwise(k)
            whole = len(some) == n
            here |= (F.col("year") == year) & (F.lit(True) if whole else F.pmod(alike, F.lit(n)).between(some.start, some.stop - 1))
        day = F.date_format(F.date_add(first, k), "yyyyMMdd")
        # the years by themselves are looked for where lines are read
        rows = staged.filter(F.col("year").isin(*files) & here).select(*columns, day.alias("day")).repartition("day")
        with dropped_shuffles(spark):
            rows.write.partitionBy("day").options(header=True, nullValue="", **options).csv(f"{landing}/parts")
        for status in system.globStatus(fs.Path(f"{landing}/parts/day=*/part-*.csv")):
            at = status.getPath().getParent().getName().split("=")[1]
            system.mkdirs(fs.Path(f"{landing}/{at}"))
            system.rename(status.getPath(), fs.Path(f"{landing}/{at}/Owner_Address.csv"))
        jobs.run(spark, landing, warehouse, "all")
    again = jobs.run(spark, landing, warehouse, "latest", overwrite=True)  # the newest one is replaced by itself
    assert len(again.owners_loaded) == 1
    found = _kept(spark, "raw.owners").drop("created_at").withColumn(
        "file_index", F.concat(F.substring("file_index", 1, 4), F.lit("0101")))
    drop_tables(spark)
    return found


def parcel_profile(spark: SparkSession, d: str) -> DataFrame:
    """How many parcels, and features, each of the six reports names, from one pass over owners and features."""
    features = b.parcels(spark, d).withColumn("drawn", F.col("area_m2") % 7 != 0)
    profile = quality.parcel_profile(b.tenfold_owners(spark, d), features, F.col("drawn"))
    return quality.report_sizes(profile)
