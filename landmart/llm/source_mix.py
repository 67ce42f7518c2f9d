"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document has the key ``-ln(u) / w``: ``u`` is drawn from a digest of its id and text, ``w`` is its
quality weight. A source's target is its share of all words, at most ``max_epochs`` times its own words;
what is cut off is shared again by weight. A source first gives all its documents as often as whole
epochs fit, then those with the smallest keys until the rest is used up; the last one gives only the
words still wanted.

The order within a source is never one window over the source: keys fall into bands of about ``BAND_DOCS`` documents,
words are summed by band, bands are prefix-summed, and only inside a band are documents sorted one by one. A band
is a part of the key's expected ranks: a document of weight w is below a key with a known chance, and the mean of
these chances over the weights of the source, kept in ``WEIGHT_STEPS`` steps, grows evenly from 0 to 1 whatever the weights
are. Bands of a source are themselves summed in blocks, so no window sees more than a few thousand rows.

Null text has size 0, takes nothing. Null sources are one source, last in the order. Rows that repeat
a doc_id and text have equal keys and one band, and are taken one after the other. Null doc_ids are keys like others.
Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landmart.llm.common import documents, stored, words

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BAND_DOCS = 2000
BLOCK = 1024
#: Steps in which a source's weights are counted.
WEIGHT_STEPS = 16
SEED = "mix-1"
#: 52 bits of the digest become u.
SCALE = 2**52


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def quality_weight(text: Column) -> Column:
    """Half for a text without letters up to one for a text of letters and blanks only."""
    marks = F.length(F.regexp_replace(text, "[\\p{L}\\s]+", ""))
    return F.when(F.length(text) > 0, F.lit(1.0) - marks / F.length(text) * F.lit(0.5)).otherwise(F.lit(0.5))


def uniform(doc_id: Column, text: Column) -> Column:
    """In (0, 1), the same in every run."""
    digest = F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(text.cast("binary"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(SCALE))


def expected_rank(at: Column, weights: Column) -> Column:
    """How many documents of a source, given as (weight, number), have a key below ``at`` on average. It grows with ``at``."""
    return F.aggregate(weights, F.lit(0.0), lambda sum_, x: sum_ + x["n"] * (F.lit(1.0) - F.pow(F.lit(1.0) - at, x["w"])))


def targets(sizes: DataFrame, total: Column | None = None) -> DataFrame:
    """(source, source_size) with the target of each source. The windows run over sources, not documents."""
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in WEIGHTS])
    weighed = sizes.withColumn(
        "weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    ).withColumn("cap", (F.col("source_size") * MAX_EPOCHS).cast("long"))
    # sources reach their caps in this order; `level` is words per unit of weight if all before are capped.
    # It grows as long as the next source is above its cap and falls after that: the largest is the one.
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    final = F.max("level").over(everything)
    return (
        weighed.withColumn("level", level)
        .withColumn("final", final)
        .select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")).alias("target"))
    )


def mixed(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``, by default all), size, source_size, target, taken (words) and
    copies (times a document is used whole) of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select(
        F.struct(*[F.col(f"`{x}`") for x in keep or docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("_id"), F.col("source").cast("string").alias("_src"),
        size_of(text).alias("size"), quality_weight(text).alias("_w"), uniform(F.col("doc_id").cast("long"), text).alias("_u"),
    ).withColumn("_at", F.lit(1.0) - F.pow("_u", F.lit(1.0) / F.col("_w")))  # the exponential key as a number from 0 to 1
    steps = sized.groupBy("_src", F.floor(F.col("_w") * WEIGHT_STEPS)).agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.avg("_w").alias("w"))
    source = stored(steps.groupBy(F.col("_src").alias("source")).agg(
        F.sum("size").alias("source_size"), F.sum("n").alias("_docs"), F.collect_list(F.struct("w", "n")).alias("_weights")), "mix-sources")
    goal = targets(source.select("source", "source_size")).join(
        source.select(F.col("source").alias("_s"), "_docs", "_weights"), F.col("source").eqNullSafe(F.col("_s"))
    ).select(
        "source", "source_size", "target", "_docs", "_weights",
        F.ceil(F.col("_docs") / BAND_DOCS).alias("_bands"),
        F.least(F.lit(MAX_EPOCHS), F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)).cast("long").alias("_epochs"),
    ).withColumn("_rest", F.round(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("long"))
    goal = stored(goal, "mix-goals").withColumnRenamed("source", "_gs")
    banded = sized.join(goal, F.col("_src").eqNullSafe(F.col("_gs"))).withColumn(
        "_band", F.least(F.floor(expected_rank(F.col("_at"), F.col("_weights")) / F.col("_docs") * F.col("_bands")), F.col("_bands") - 1))
    bands = starts(
        banded.groupBy("_gs", "_band").agg(F.sum("size").alias("_words")), "_gs", "_band", "_words")
    bands = stored(bands, "mix-bands").select(F.col("_gs").alias("_bs"), F.col("_band").alias("_bb"), "_start")
    inside = Window.partitionBy("_src", "_band").orderBy("_at", "_id").rowsBetween(Window.unboundedPreceding, -1)
    return (
        banded.join(bands, F.col("_src").eqNullSafe(F.col("_bs")) & (F.col("_band") == F.col("_bb")))
        .withColumn("_before", F.col("_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("_part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_before"))))
        .select(
            "row", "size", "source_size", "target",
            (F.col("_epochs") * F.col("size") + F.col("_part")).cast("long").alias("taken"),
            # a document of which at least half is wanted is used whole
            (F.col("_epochs") + F.when((F.col("_part") * 2 >= F.col("size")) & (F.col("_part") > 0), 1).otherwise(0)).cast("int").alias("copies"),
        )
    )


def starts(sums: DataFrame, group: str, at: str, value: str) -> DataFrame:
    """Adds ``_start``, the sum of ``value`` of all rows of ``group`` before ``at``, by blocks of rows."""
    sums = sums.withColumn("_block", F.floor(F.col(at) / BLOCK))
    blocks = sums.groupBy(group, "_block").agg(F.sum(value).alias("_sum"))
    order = lambda *by, then: Window.partitionBy(*by).orderBy(then).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col(group).alias("_g"), F.col("_block").alias("_b"),
        F.coalesce(F.sum("_sum").over(order(group, then="_block")), F.lit(0)).alias("_base"))
    inside = F.coalesce(F.sum(value).over(order(group, "_block", then=at)), F.lit(0))
    return (
        sums.withColumn("_inside", inside)
        .join(blocks, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_block") == F.col("_b")))
        .withColumn("_start", F.col("_base") + F.col("_inside"))
        .select(group, at, "_start")
    )


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mixed(documents(docs, "source"), ["doc_id"]).select("row.doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS size
  FROM documents),
keyed AS (
  SELECT doc_id, source, size, 1.0::DOUBLE - pow(
      (('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, 'null') || '|' || md5(body)), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0,
      1.0::DOUBLE / CASE WHEN length(body) > 0
        THEN 1.0::DOUBLE - length(regexp_replace(body, '[\\p{L}\\s\\x0B]+', '', 'g'))::DOUBLE / length(body) * 0.5::DOUBLE ELSE 0.5::DOUBLE END) AS pos
  FROM sized),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM keyed GROUP BY source),
filled AS (
  SELECT *, 3 * source_size AS cap,
    ((sum(source_size) OVER ())::BIGINT - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
      / (sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM src),
goal AS (
  SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target
  FROM filled),
parts AS (
  SELECT *, least(3, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END)::BIGINT AS epochs FROM goal)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, round(target - epochs * source_size)::BIGINT - coalesce(sum(size) OVER (
    PARTITION BY k.source ORDER BY pos, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))))::BIGINT AS taken
FROM keyed k JOIN parts p ON k.source IS NOT DISTINCT FROM p.source
"""
