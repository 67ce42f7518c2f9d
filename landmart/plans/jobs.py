"""The daily jobs: load landed snapshots into the raw tables, and rebuild the marts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landmart.constants import OWNER_FILE, PARCEL_FILE, SNAPSHOT_FORMAT
from landmart.operators.areas import parcel_area
from landmart.operators.snapshots import parse_snapshot_date, pending_snapshots, select_snapshots
from landmart.plans import marts
from landmart.plans.tables import (
    SOURCES, Changes, as_written, clear_unused, commit, create_tables, loaded_snapshots, new_version, read_version,
    versions, write_snapshots, write_version,
)
from landmart.session import configure
from landmart.sources import shapefile
from landmart.sources.landing import landed_files, snapshot_of
from landmart.sources.owner_csv import raw_owner_rows, read_owner_files
from landmart.sources.parcel_features import raw_parcel_rows


@dataclass
class Report:
    """What a run did; skipped features lack a geometry."""

    owners_loaded: list[str] = field(default_factory=list)
    parcels_loaded: list[str] = field(default_factory=list)
    features_skipped: int = 0
    invalid_date: str | None = None
    rebuilt: bool = False


def _pick(
    spark: SparkSession, landed: DataFrame, requested: DataFrame, name: str, table: str, overwrite: bool
) -> dict[str, str]:
    """Paths by snapshot: requested, landed for this source, and not loaded unless to be replaced."""
    found = landed.filter(F.col("name") == name).join(requested, "file_index", "left_semi")
    if not overwrite:
        found = pending_snapshots(found, loaded_snapshots(spark, table))
    paths: dict[str, str] = {}
    for row in found.collect():  # one row per snapshot
        if paths.setdefault(row.file_index, row.path) != row.path:
            raise ValueError(f"two files for snapshot {row.file_index}: {paths[row.file_index]}, {row.path}")
    return paths


def load_owners(
    spark: SparkSession, landed: DataFrame, requested: DataFrame, overwrite: bool = False
) -> list[str]:
    """Load ownership files; snapshots without one and those already loaded are skipped."""
    configure(spark)
    paths = _pick(spark, landed, requested, OWNER_FILE, "raw.owners", overwrite)
    if paths:
        clear_unused(spark)
        staged = read_owner_files(spark, sorted(paths.values()))
        rows = raw_owner_rows(staged).withColumn("created_at", F.current_timestamp())
        # the grouping of duplicates has spread every snapshot over all tasks
        write_snapshots(rows, "raw.owners", list(paths), mixed=True)
    return sorted(paths)


def load_parcels(
    spark: SparkSession, landed: DataFrame, requested: DataFrame, overwrite: bool = False
) -> tuple[list[str], int]:
    """Load parcel shapes; returns the snapshots and the number of features without geometry."""
    configure(spark)
    shapefile.register(spark)
    paths = _pick(spark, landed, requested, PARCEL_FILE, "raw.parcels", overwrite)
    skipped = 0
    if paths:
        features = spark.read.format("parcel_shapes").option("paths", "\n".join(sorted(paths.values()))).load()
        # a task reads a piece of one file, so of one snapshot
        skipped = _write_parcels(
            spark, features.withColumn("file_index", snapshot_of(F.col("path"))), list(paths), mixed=False)
    return sorted(paths), skipped


def load_features(
    spark: SparkSession, features: DataFrame, overwrite: bool = False
) -> tuple[list[str], int]:
    """Load parcels from a table of features (object_id, parcel_no, shape_area, shape_len, geom,
    file_index) instead of shapefiles; see ``features_from_wkt`` and ``features_from_wkb``."""
    configure(spark)
    requested = features.select("file_index").distinct()
    if not overwrite:
        requested = pending_snapshots(requested, loaded_snapshots(spark, "raw.parcels"))
    chosen = sorted(row.file_index for row in requested.collect())  # one row per snapshot
    skipped = 0
    if chosen:
        skipped = _write_parcels(spark, features.filter(F.col("file_index").isin(chosen)), chosen, mixed=True)
    return chosen, skipped


def _write_parcels(spark: SparkSession, features: DataFrame, snapshots: list[str], mixed: bool) -> int:
    """Replace the snapshots' parcels together with their areas; returns the features without geometry."""
    count = Observation()
    clear_unused(spark)
    version = new_version()
    changes: Changes = {}
    changes["raw.parcels"] = dict.fromkeys(snapshots) | dict.fromkeys(
        write_version(raw_parcel_rows(features, count), "raw.parcels", version, mixed), version)
    areas = parcel_area(read_version(spark, "raw.parcels", version))
    changes["raw.parcel_areas"] = dict.fromkeys(snapshots) | dict.fromkeys(
        write_version(areas, "raw.parcel_areas", version, mixed=True), version)
    commit(spark, changes)
    return count.get["records_skipped"]


def add_missing_areas(spark: SparkSession) -> None:
    """Sum the features of every parcel in the snapshots that have no areas yet."""
    missing = pending_snapshots(loaded_snapshots(spark, "raw.parcels"), loaded_snapshots(spark, "raw.parcel_areas"))
    chosen = sorted(row.file_index for row in missing.collect())  # one row per snapshot
    if chosen:
        parcels = spark.table("raw.parcels").filter(F.col("file_index").isin(chosen))
        write_snapshots(parcel_area(parcels), "raw.parcel_areas", chosen, mixed=True)


@dataclass(frozen=True)
class Mart:
    """How a mart's days are computed, and which columns of a key's last row the next day's change goes by."""

    build: Callable[..., DataFrame]
    last: str
    key: str
    count: str


MARTS = {
    "marts.owner_daily_summary": Mart(marts.owner_days, "marts.owner_last", "owner_name", "total_real_property_owned"),
    "marts.land_type_daily_summary": Mart(marts.land_type_days, "marts.land_type_last", "account_type", "total_parcels"),
}


def _last_rows(rows: DataFrame, mart: Mart) -> DataFrame:
    """The last row of each key."""
    one = F.struct("report_date", mart.count, "exact_m2")
    return rows.groupBy(mart.key).agg(F.max_by(one, "report_date").alias("row")).select(mart.key, "row.*")


def rows_before(spark: SparkSession, name: str, first: str) -> DataFrame | None:
    """The last row of each key before a snapshot: those noted by the last build or, where an older day is replaced, from
    the mart's earlier days. None if there are none."""
    mart = MARTS[name]
    noted = versions(spark).get(mart.last)
    if not noted:
        return None
    if max(noted) < first:
        return spark.table(mart.last).drop("part")
    earlier = as_written(spark, name).filter(F.col("report_date") < F.to_date(F.lit(first), "yyyyMMdd"))
    return _last_rows(earlier.select(mart.key, "report_date", mart.count, "exact_m2"), mart)


def days_from(
    spark: SparkSession, name: str, first: str, before: DataFrame | None, same: list[str] = [],  # noqa: B006
) -> DataFrame:
    """A mart's rows from a snapshot on, from the raw snapshots from there on and the last rows before. A day goes by its
    own snapshot but for the change, so those of the ``same`` snapshots, which the mart was built from, are taken from it."""
    owners, parcels, areas = (
        spark.table(f"raw.{x}").filter((F.col("file_index") >= first) & ~F.col("file_index").isin(same))
        for x in ("owners", "parcels", "parcel_areas"))
    kept = as_written(spark, name).filter(F.date_format("report_date", SNAPSHOT_FORMAT).isin(same)) if same else None
    return MARTS[name].build(owners, parcels, areas, before, kept)


def rebuild(spark: SparkSession, full: bool = False) -> str | None:
    """Bring both marts to the raw snapshots, from the first snapshot on that was added, replaced or emptied since the last
    build (``full``: from the first of all); returns that snapshot. Earlier days are neither read nor written. All days
    from there on are written with their change; holdings are computed for changed snapshots, the others' read from the mart.
    All days of both marts switch at once."""
    configure(spark)
    add_missing_areas(spark)
    used = versions(spark)
    owners, areas, built = (used.get(x, {}) for x in ("raw.owners", "raw.parcel_areas", SOURCES))
    now = {x: f"{owners.get(x, '')}/{areas.get(x, '')}" for x in owners.keys() | areas.keys()}
    changed = sorted(x for x in now.keys() | built.keys() if full or now.get(x) != built.get(x))
    if not changed:
        return None
    clear_unused(spark)
    first, version = changed[0], new_version()
    same = sorted(x for x in now if x > first and x not in changed)
    day = date.fromisoformat(f"{first[:4]}-{first[4:6]}-{first[6:]}").isoformat()
    changes: Changes = {SOURCES: {x: now.get(x) for x in changed}}
    for name, mart in MARTS.items():
        before = rows_before(spark, name, first)
        found = write_version(days_from(spark, name, first, before, same), name, version, mixed=True)
        changes[name] = {x: None for x in used.get(name, {}) if x >= day} | dict.fromkeys(found, version)
        rows = read_version(spark, name, version).select(mart.key, "report_date", mart.count, "exact_m2")
        last = _last_rows(rows if before is None else rows.unionByName(before), mart)
        part = max(now, default=first)
        parts = write_version(last.withColumn("part", F.lit(part)), mart.last, version, mixed=False)
        changes[mart.last] = dict.fromkeys(used.get(mart.last, {})) | dict.fromkeys(parts, version)
    commit(spark, changes)
    return first


def run(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    snapshots: str = "today",
    overwrite: bool = False,
    rebuild_marts: bool = False,
    today: date | None = None,
) -> Report:
    """One run: load ``today``, ``latest``, ``all`` or one yyyy-mm-dd snapshot, then maybe rebuild.

    An invalid date skips the load but not the rebuild; a load alone leaves the marts unchanged.
    """
    configure(spark)
    create_tables(spark, warehouse)
    report = Report()
    if snapshots not in ("today", "latest", "all"):
        try:
            parse_snapshot_date(snapshots)
        except ValueError:
            report.invalid_date = snapshots
    if report.invalid_date is None:
        landed = landed_files(spark, landing)
        requested = select_snapshots(landed, snapshots, today)
        report.owners_loaded = load_owners(spark, landed, requested, overwrite)
        report.parcels_loaded, report.features_skipped = load_parcels(spark, landed, requested, overwrite)
    if rebuild_marts:
        rebuild(spark)
        report.rebuilt = True
    return report
