"""The ownership file: 34 positional columns, header ignored, quoted text may hold line breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landmart.functions.attributes import assemble_address, is_real_account, stake
from landmart.schemas import OWNER_FILE_SCHEMA
from landmart.sources.landing import snapshot_of
from landmart.sources.quoted_records import read_records, scanned

DIALECT = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    # A marker no file contains: an empty cell becomes NULL while a quoted empty stays text.
    "nullValue": "\x01",
    # short rows, long rows and bad timestamps raise
    "mode": "FAILFAST",
}


def read_owner_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of the given files with their snapshot id.

    Every file is read in splits. Files whose quoted text spans lines are cut into records by quotes; one pass over the
    bytes finds out which ones, and how many quotes lie before each split.
    """
    known = scanned(spark, paths)
    unclosed = sorted(path for path, (_, _, odd) in known.items() if odd)
    if unclosed:
        raise ValueError(f"unterminated quoted text in {unclosed}")
    plain = sorted(path for path, (_, spans, _) in known.items() if not spans)
    spanning = sorted(path for path, (_, spans, _) in known.items() if spans)
    if not spanning:
        return _read_plain(spark, plain)
    rows = _parsed(read_records(spark, spanning, known=known))
    return rows.unionByName(_read_plain(spark, plain)) if plain else rows


def _read_plain(spark: SparkSession, paths: list[str]) -> DataFrame:
    reader = spark.read.schema(OWNER_FILE_SCHEMA).options(
        header=True, enforceSchema=True, multiLine=False, columnPruning=False, **DIALECT
    )
    return reader.csv(paths).withColumn("file_index", snapshot_of(F.col("_metadata.file_path")))


def _parsed(records: DataFrame) -> DataFrame:
    """Records parsed in the same dialect."""
    row = F.from_csv("value", OWNER_FILE_SCHEMA.simpleString()[len("struct<"):-1].replace(":", " "), DIALECT)
    return records.select(row.alias("row"), snapshot_of(F.col("path")).alias("file_index")).select(
        "row.*", "file_index"
    )


def raw_owner_rows(staged: DataFrame) -> DataFrame:
    """File rows to the raw layout, without the load time; exact duplicates collapse."""
    c = F.col
    # no later step uses created_date; reading it makes a malformed one raise
    dated = c("created_date").isNull() | (c("created_date") >= F.lit("0001-01-01").cast("timestamp"))
    bad = F.raise_error(F.concat(F.lit("created_date out of range: "), c("created_date").cast("string")))
    return staged.filter(F.when(dated, F.lit(True)).otherwise(bad.cast("boolean"))).select(
        c("strap").alias("account_id"),
        c("folio").alias("parcel_id"),
        "lot",
        is_real_account(c("strap")).alias("is_real_property"),
        "status_cd",
        assemble_address(c("street_num"), c("street_prefix"), c("street"), c("street_suffix")).alias("address"),
        c("street_unit").alias("address_unit"),
        "city",
        "owner_name",
        stake(c("pct_own")).alias("pct_own"),
        "account_type",
        "file_index",
    ).distinct()
