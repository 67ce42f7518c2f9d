"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landmart.session import dropped_shuffles

#: What separates words: blank, tab, newline, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=1)
def local_folder() -> str:
    """For a local session without a shared folder, as in tests: one that goes at exit."""
    folder = tempfile.mkdtemp(prefix="landmart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``. Without one, a cluster's tasks have no folder in common: that raises."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(base or local_folder()).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def configure(spark: SparkSession) -> SparkSession:
    """Few texts at a time are handed to Python, since some are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def stored(df: DataFrame, name: str, *by: str, **options: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: a cut of the lineage that outlives
    executors. The shuffles that made it are not needed any more and go at once. ``by`` and ``options`` are the writer's:
    columns that have a folder for each value, and others."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with dropped_shuffles(spark):
        df.write.partitionBy(*by).options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Deletes the files of ``stored`` tables that no step needs any more."""
    spark = tables[0].sparkSession
    for folder in {x.rsplit("/", 1)[0] for table in tables for x in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and the columns of ``more``, whatever else ``docs`` has."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def sample(rows: DataFrame, by: str, size: int) -> DataFrame:
    """At most ``size`` rows of each value of ``by``, one per doc_id: those with the smallest hash of doc_id,
    numbered by ``n``. Of rows that repeat a doc_id the least one is taken, whatever their order. Doc_ids are counted first,
    so that only about twice as many go on as are wanted, however many tasks there are. The values of ``by`` are few."""
    space = 2**40
    counts = {r[by]: r["n"] for r in rows.groupBy(by).agg(F.count_distinct("doc_id").alias("n")).collect()}
    if not counts:
        return rows.withColumn("n", F.lit(0)).limit(0)
    ends = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(space, 2 * size * space // n + 1))])
    near = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(space)) < ends[F.col(by)])
    one = near.groupBy("doc_id").agg(F.min(F.struct(by, *[x for x in rows.columns if x not in (by, "doc_id")])).alias("row"))
    order = Window.partitionBy(by).orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(space)), "doc_id")
    return one.select("doc_id", "row.*").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= size)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case. Text of ASCII letters only takes the faster way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
