"""Line dedup: levelled sorted runs of line hashes, merge-joined with each new batch.

A line's key is the line without blanks at both ends and with A-Z lower-cased. A run is a table of
(key hash, documents holding the key, largest doc_id holding it), dealt and sorted by the hash. A batch
becomes one run of level 0; as soon as a level has ``fanout`` runs they are merged into one of the next
level, so a batch meets a number of runs that is logarithmic in the number of batches.

The query cuts the table into ``BATCHES`` batches by a hash of doc_id, so that it levels and compacts runs as a stream of
batches does. Counts are needed of keys that are known as well as of new ones, so a batch's run has both, and lines
that go are found by a join of keys with the runs.

Documents are told apart by doc_id: rows that repeat one are one document of the counts, and the one that keeps a line
keeps it in all its rows. A doc_id's rows must come in one batch. Rows without doc_id are told apart by their text and are
smaller than any doc_id; a line that only they have stays. Null or empty text is one empty line. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landmart.llm.common import BLANKS, documents, lower_ascii, stored

MIN_CHARS = 40
MIN_DOCS = 5
FANOUT = 4
#: Stands for a null doc_id in a run.
NO_ID = -(2**63)
#: Batches that the query makes of a table.
BATCHES = 6
RUN = "h1 long, h2 long, n_docs long, keeper long"


def line_key(line: Column) -> Column:
    return lower_ascii(F.trim(line, F.lit(BLANKS)))


def key_hash(key: Column) -> Column:
    """128 bits of a key."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2"))


def keys(text: Column) -> Column:
    """The distinct keys of a text that are long enough. Cutting and lowering do not change what is long."""
    stripped = F.filter(F.transform(lines(text), lambda x: F.trim(x, F.lit(BLANKS))), lambda x: F.length(x) >= MIN_CHARS)
    return F.array_distinct(F.transform(stripped, lower_ascii))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def identity() -> Column:
    """A doc_id, and for rows without one the hash of the text."""
    null = F.col("doc_id").isNull()
    return F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.when(null, F.xxhash64("text")).otherwise(0).alias("t"))


def keys_of(docs: DataFrame) -> DataFrame:
    """The distinct key hashes of each document."""
    return documents(docs).select(identity().alias("_id"), F.explode(F.transform(keys(F.col("text")), key_hash)).alias("h")).select(
        "_id", "h.h1", "h.h2")


def run_of(found: DataFrame) -> DataFrame:
    """The sorted run of a batch's keys."""
    return found.groupBy("h1", "h2").agg(F.count_distinct("_id").alias("n_docs"), F.max("_id.id").alias("keeper")).sortWithinPartitions("h1", "h2")


def merged(runs: DataFrame) -> DataFrame:
    return (
        runs.groupBy("h1", "h2")
        .agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))
        .sortWithinPartitions("h1", "h2")
    )


class LineRuns:
    """The runs of all batches so far, by level. Each run is a table in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, levels: Sequence[Sequence[DataFrame]] = ()):
        self.spark = spark
        self.fanout = fanout
        self.levels = [list(x) for x in levels]

    def add(self, batch: DataFrame) -> None:
        """Adds the run of a batch of documents and compacts full levels."""
        self.add_keys(keys_of(batch))

    def add_keys(self, found: DataFrame) -> None:
        run, level = stored(run_of(found), "line-run"), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            run = stored(merged(self.union(self.levels[level])), "line-run")
            self.levels[level], level = [], level + 1

    def union(self, runs: Sequence[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs or [self.spark.createDataFrame([], RUN)])

    def all(self) -> DataFrame:
        """One row per key of all batches."""
        flat = [run for level in self.levels for run in level]
        return flat[0] if len(flat) == 1 else merged(self.union(flat))

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """Keys found in at least ``min_docs`` documents, with the document that keeps them."""
        return self.all().filter(F.col("n_docs") >= min_docs).drop("n_docs")


def kept_lines(docs: DataFrame, runs: LineRuns, min_docs: int = MIN_DOCS, found: DataFrame | None = None) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_lines``, ``n_dropped``, ``kept_text``: each line whose key the
    runs hold ``min_docs`` times goes, but for the key's largest doc_id. Null text stays null. ``found`` has the keys of ``docs``
    if they are known.

    Documents are joined with the hashes they lose, of which a document has no more than lines; hashes travel, not lines.
    """
    lost = stored(
        (keys_of(docs) if found is None else found).join(stored(runs.repeated(min_docs), "repeated"), ["h1", "h2"])
        .filter(F.col("_id.id") != F.col("keeper"))
        .groupBy("_id")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("lost")), "lost")
    whole = docs.select(
        F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text")).select("row", identity().alias("_id"))
    text = lines(F.col("row.text").cast("string"))
    stays = F.when(F.col("lost").isNull(), text).otherwise(F.filter(
        text, lambda x: (F.length(F.trim(x, F.lit(BLANKS))) < MIN_CHARS) | ~F.array_contains(F.col("lost"), key_hash(line_key(x)))))
    # the same join at every size: `lost` grows with the documents, so a broadcast of a small one would say nothing of a large one
    return whole.join(lost.hint("merge"), "_id", "left").withColumn("stays", stays).select(
        "row",
        F.size(text).cast("long").alias("n_lines"),
        (F.size(text) - F.size("stays")).cast("long").alias("n_dropped"),
        F.when(F.col("row.text").isNotNull(), F.array_join("stays", "\n")).alias("kept_text"),
    )


def in_batches(docs: DataFrame, batches: int = BATCHES, min_docs: int = MIN_DOCS) -> DataFrame:
    """``kept_lines`` of a table, whose keys come in batches."""
    found = stored(keys_of(docs), "line-keys")
    runs = LineRuns(docs.sparkSession)
    for k in range(batches):
        runs.add_keys(found.filter(F.pmod(F.xxhash64("_id"), F.lit(batches)) == k))
    return kept_lines(docs, runs, min_docs, found)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    return in_batches(documents(docs)).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = """
WITH body AS (SELECT row_number() OVER () AS r, doc_id, coalesce('d' || doc_id, 't' || text, '-') AS id, coalesce(text, '') AS t FROM documents),
line AS (
  SELECT r, doc_id, id, i, x, translate(trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, doc_id, id, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM body)),
often AS (
  SELECT k, max(doc_id) AS keeper FROM line WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT id) >= 5),
marked AS (
  SELECT r, i, x, keeper IS NOT NULL AND keeper IS DISTINCT FROM doc_id AS gone FROM line LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked JOIN body USING (r) GROUP BY r, doc_id
"""
