"""From raw documents to token ids: STAGES in order, each over all that its predecessor kept.

``run(spark, sf_dir)`` applies them to the documents of a folder. Between stages the documents are written to
the shared folder and read back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landmart.llm import byte_bpe, line_dedup, ngram_join, source_mix, toxicity
from landmart.llm.common import configure, stored, table
from landmart.llm.queries import VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject. Learned from the labels of documents in ``docs``."""
    configure(spark)
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; n_chars follows the text."""
    left = line_dedup.in_batches(docs)
    shorter = F.when(F.col("n_dropped") > 0, F.length("kept_text")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("kept_text"), "n_chars": shorter}
    return left.select(*[new.get(x, F.col(f"row.`{x}`")).cast(t).alias(x) for x, t in docs.dtypes])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates. Documents without doc_id stay.
    Where a doc_id repeats, its rows are told apart by the class of their text: each stands for its own group, and of
    several rows of a group with its smallest doc_id the one of the smallest class, then of the first JSON text stays."""
    configure(spark)
    found = stored(ngram_join.grouped(docs), "groups").filter(F.col("doc_id").isNotNull())
    stay = found.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id", "root").agg(F.min("c").alias("c"))
    again = found.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    once = docs.join(stay.join(again, "doc_id", "left_anti"), "doc_id", "left_semi")
    several = ngram_join.with_class(docs.join(again, "doc_id", "left_semi").select(docs.columns)).join(stay, ["doc_id", "c"], "left_semi")
    order = F.to_json("row", {"ignoreNullFields": "false"})
    one = several.groupBy("doc_id", "c").agg(F.min_by("row", order).alias("row")).select("row.*")
    return once.unionByName(one).unionByName(docs.filter(F.col("doc_id").isNull())).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix uses it."""
    used = source_mix.mixed(docs).filter(F.col("copies") > 0)
    return used.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the token ids, and the digests of ids and of the bytes they decode to."""
    configure(spark)
    return byte_bpe.with_ids(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_join", one_of_each_group),
    ("source_mix", mix),
    ("byte_bpe", encode),
]

#: The first stage is a learned model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
