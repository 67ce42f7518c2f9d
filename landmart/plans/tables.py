"""Raw and mart tables in the session catalog, below one warehouse folder, in versions.

A table's rows lie in ``<table>_versions``, a table partitioned by version and key (a snapshot or a day). A load or
build writes its rows to a version of its own, which nobody reads yet. Which version of each key is in use stands in one
view, ``raw.versions_in_use``; ``raw.owners`` and the others are views that join it. So:

1. rows are written below fresh folders, for all tables that change together;
2. one line file in the warehouse's log makes the change final;
3. one statement replaces the view, which switches all tables and keys at once;
4. partitions that are not in use any more leave the catalog; the next write deletes their files.

A failure before 2 leaves everything as it was, one after 2 is made good by the next run. No data is ever renamed,
and readers of the version before are not disturbed until the write after the next one. One job writes at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landmart.schemas import EXACT_AREA, TABLES_BY_NAME, conform
from landmart.session import dropped_shuffles
from landmart.sources.landing import qualified

RAW_TABLES = {name: layout for name, layout in TABLES_BY_NAME.items() if name.startswith("raw.")}
MART_TABLES = {name: layout for name, layout in TABLES_BY_NAME.items() if name.endswith("_summary")}
#: The last row of each owner and type, from which a build goes on.
STATE_TABLES = {name: layout for name, layout in TABLES_BY_NAME.items() if name.endswith("_last")}
#: What is read by the tables' names; the marts' files have one column more.
TABLES = TABLES_BY_NAME
WRITTEN = TABLES | {name: T.StructType([*layout.fields, EXACT_AREA]) for name, layout in MART_TABLES.items()}
KEYS = dict.fromkeys(RAW_TABLES, "file_index") | dict.fromkeys(MART_TABLES, "report_date") | dict.fromkeys(STATE_TABLES, "part")
IN_USE = "raw.versions_in_use"
#: Which versions of the raw tables a mart's days were built from, by snapshot.
SOURCES = "marts.sources"
LOG = "commit long, name string, part string, version string"

#: By table: the version of each key, None for keys that go.
Changes = dict[str, dict[str, str | None]]


def _columns(fields: Iterable[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def create_tables(spark: SparkSession, warehouse: str) -> None:
    """Create what is missing, and bring the catalog to what the warehouse's log says: a new catalog, or one left behind by
    a run that broke off. A catalog whose tables lie in another warehouse raises."""
    warehouse = qualified(spark, warehouse)
    for database in ("raw", "marts"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{warehouse}/{database}'")
    new = []
    for name, layout in WRITTEN.items():
        folder, key = f"{warehouse}/{name.replace('.', '/')}", KEYS[name]
        if spark.catalog.tableExists(f"{name}_versions"):
            found = qualified(spark, location(spark, name))
            if found != folder:
                raise ValueError(f"{name} of this catalog lies at {found}, not in {warehouse}")
        else:
            fields = [f for f in layout.fields if f.name != key]
            kind = next(f.dataType.simpleString() for f in layout.fields if f.name == key)
            spark.sql(
                f"CREATE TABLE {name}_versions ({_columns(fields)}, `version` string, `{key}` {kind}) "
                f"USING parquet PARTITIONED BY (version, `{key}`) LOCATION '{folder}'")
            new.append(name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{warehouse}/log")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    used = in_use(_log(spark, warehouse))
    shown = {tuple(r) for r in spark.table(IN_USE).collect()} if spark.catalog.tableExists(IN_USE) else None
    if shown != {(name, part, version) for name in TABLES for part, version in used.get(name, {}).items()}:
        for name in TABLES:
            _add_partitions(spark, name, used.get(name, {}))
        _show(spark, used)
    for name in new:
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {_used_rows(name, TABLES[name])}")


def drop_tables(spark: SparkSession) -> None:
    """Forget all tables in the catalog; the warehouse stays as it is."""
    for name in TABLES:
        spark.sql(f"DROP VIEW IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}_versions")
    spark.sql(f"DROP VIEW IF EXISTS {IN_USE}")


def _used_rows(name: str, layout: T.StructType) -> str:
    kind = next(f.dataType.simpleString() for f in layout.fields if f.name == KEYS[name])
    return (
        f"SELECT {', '.join(f'r.`{f.name}`' for f in layout.fields)} FROM {name}_versions r LEFT SEMI JOIN {IN_USE} v "
        f"ON v.name = '{name}' AND r.version = v.version AND r.`{KEYS[name]}` = CAST(v.part AS {kind})")


def as_written(spark: SparkSession, table: str) -> DataFrame:
    """A table's rows with the columns that its view leaves out."""
    return spark.sql(_used_rows(table, WRITTEN[table]))


def location(spark: SparkSession, table: str) -> str:
    """The folder of a table's versions."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}_versions").collect()
    return next(r.data_type for r in described if r.col_name == "Location").rstrip("/")


def _warehouse(spark: SparkSession) -> str:
    return location(spark, "raw.owners").rsplit("/", 2)[0]


def _log(spark: SparkSession, warehouse: str) -> list[Row]:
    """All changes so far, in order: one row per commit, table and key."""
    return sorted(spark.read.schema(LOG).parquet(f"{warehouse}/log").collect(), key=lambda r: r.commit)


def in_use(log: list[Row]) -> dict[str, dict[str, str]]:
    """The version in use of each table and key."""
    used: dict[str, dict[str, str]] = {}
    for row in log:
        used.setdefault(row.name, {})[row.part] = row.version
    return {name: {part: version for part, version in parts.items() if version} for name, parts in used.items()}


def versions(spark: SparkSession) -> dict[str, dict[str, str]]:
    """The version in use of each table and key, as the warehouse's log has it."""
    return in_use(_log(spark, _warehouse(spark)))


def loaded_snapshots(spark: SparkSession, table: str) -> DataFrame:
    """Snapshots of a raw table, without reading it."""
    return spark.table(IN_USE).filter(F.col("name") == table).select(F.col("part").alias("file_index"))


def new_version() -> str:
    return uuid.uuid4().hex


def write_version(rows: DataFrame, table: str, version: str, mixed: bool) -> list[str]:
    """Write rows as a version that is not in use yet; returns its keys.

    ``mixed`` says that tasks hold rows of many keys. These are first brought together by key in pieces of even
    size, so that a key gets few files and a large one many tasks.
    """
    spark, key = rows.sparkSession, KEYS[table]
    rows = conform(rows, WRITTEN[table])
    if mixed:
        rows = rows.hint("rebalance", key)
    folder = f"{location(spark, table)}/version={version}"
    with dropped_shuffles(spark):
        rows.write.partitionBy(key).parquet(folder)
    return sorted(_value(spark, path) for path in _listed(spark, f"{folder}/{key}=*"))


def _listed(spark: SparkSession, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [x.getPath() for x in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or ()]


def _value(spark: SparkSession, path) -> str:
    """The value in a folder's name, as Spark wrote it."""
    name = path.getName().split("=", 1)[1]
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)


def read_version(spark: SparkSession, table: str, version: str) -> DataFrame:
    """The rows of one version, also before it is in use."""
    path = f"{location(spark, table)}/version={version}"
    return spark.read.schema(WRITTEN[table]).parquet(path)


def commit(spark: SparkSession, changes: Changes) -> None:
    """Put versions in use: all tables and keys at once."""
    log = _log(spark, warehouse := _warehouse(spark))
    before = in_use(log)
    for name, parts in changes.items():
        _add_partitions(spark, name, {part: version for part, version in parts.items() if version})
    number = max((row.commit for row in log), default=0) + 1
    rows = [(number, name, part, version) for name, parts in changes.items() for part, version in parts.items()]
    if not rows:
        return
    _append(spark.createDataFrame(rows, LOG), f"{warehouse}/log")
    after = {name: dict(parts) for name, parts in before.items()}
    for name, parts in changes.items():
        now = after.get(name, {}) | parts
        after[name] = {part: version for part, version in now.items() if version}
    _show(spark, after)
    for name, parts in before.items():
        gone = {part: version for part, version in parts.items() if after.get(name, {}).get(part) != version}
        _partitions(spark, name, "DROP IF EXISTS", gone, ", ")
    for name in changes:
        if name in TABLES:
            spark.catalog.refreshTable(f"{name}_versions")


def _append(rows: DataFrame, folder: str) -> None:
    """One file, which is there as a whole or not at all."""
    rows.coalesce(1).write.mode("append").parquet(folder)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partitions(spark: SparkSession, name: str, verb: str, parts: dict[str, str], between: str) -> None:
    """One statement for all partitions."""
    if name in TABLES and parts:
        listed = between.join(
            f"PARTITION (version = {_quoted(version)}, `{KEYS[name]}` = {_quoted(part)})" for part, version in sorted(parts.items()))
        spark.sql(f"ALTER TABLE {name}_versions {verb} {listed}")


def _add_partitions(spark: SparkSession, name: str, parts: dict[str, str]) -> None:
    _partitions(spark, name, "ADD IF NOT EXISTS", parts, " ")


def _show(spark: SparkSession, used: dict[str, dict[str, str]]) -> None:
    """Replace the view of the versions in use. Its text has each version once, with its keys."""
    grouped: dict[tuple[str, str], list[str]] = {}
    for name in TABLES:
        for part, version in used.get(name, {}).items():
            grouped.setdefault((name, version), []).append(part)
    rows = [{"name": name, "version": version, "parts": parts} for (name, version), parts in grouped.items()]
    spark.sql(
        f"CREATE OR REPLACE VIEW {IN_USE} AS SELECT name, part, version FROM (SELECT inline(from_json({_quoted(json.dumps(rows))}, "
        "'array<struct<name:string,version:string,parts:array<string>>>'))) LATERAL VIEW explode(parts) AS part")


def clear_unused(spark: SparkSession) -> None:
    """Delete the files of versions that are not in use: replaced before the last write, or left by a failed one."""
    used = versions(spark)
    for name in TABLES:
        keep = {(version, part) for part, version in used.get(name, {}).items()}
        for path in _listed(spark, f"{location(spark, name)}/version=*/{KEYS[name]}=*"):
            if (_value(spark, path.getParent()), _value(spark, path)) not in keep:
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_snapshots(rows: DataFrame, table: str, replaced: list[str], mixed: bool) -> None:
    """Write the rows' snapshots to one table, each as a whole, leaving other snapshots alone. Of the ``replaced`` ones
    those without a row are emptied and count as not loaded."""
    version = new_version()
    found = write_version(rows, table, version, mixed)
    commit(rows.sparkSession, {table: dict.fromkeys(replaced) | dict.fromkeys(found, version)})


def empty_snapshot(spark: SparkSession, table: str, file_index: str) -> None:
    """Take a snapshot out of use."""
    commit(spark, {table: {file_index: None}})
