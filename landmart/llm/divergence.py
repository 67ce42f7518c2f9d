"""Source divergence audit: how far the sources of a language lie apart in their words, by a three-dimensional cube.

Every document counts for its language and its (language, source) group. A language keeps the terms that at
least ``MIN_DOCS`` of its documents have; a group gives each of them a share p (parts of ``SCALE``, smoothed), and two
groups differ by the sum of f = (p - q)^2 / (p + q) over all kept terms, each rounded down.

1. Tasks count terms per group over many documents before anything is shuffled. Counts meet by (language, term), where
   terms are kept or go.
2. The groups of a language are dealt into blocks of about ``GROUP_BLOCK``, its terms into blocks of about
   ``TERM_BLOCK``. A cell is (group block, group block, term block); a group's counts are replicated to all cells of its
   block. Only terms that a group has are sent; all others have the group's least share.
3. A cell sums f over its terms for each pair of its groups, as what a pair differs from the f of two least shares.
4. Partial sums are reduced along the term axis. The f of the least shares, times the kept terms, is added once.

A hot source or language only has more cells: a cell's rows are bounded by the block sizes. Sums are whole
numbers below 2^63, since a group's shares add up to about ``SCALE``; counts are multiplied as decimals.

Null text, language and source are read as ''. Every row is a document, also rows that repeat a doc_id or have none.
Groups without terms take part with the least share alone, and where a language keeps no term all values are 0. A language
with one source has no pairs. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landmart.llm.common import stored

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
GROUP_BLOCK = 8
TERM_BLOCK = 16_384
#: Counters that a task holds before it hands them on.
HELD = 400_000
#: Letters of ASCII in lower case and all bytes beyond ASCII make terms, the rest is blank.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTS = "lang string, source string, term string, n long, docs long"


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, one or more rows of each group and term."""

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
        langs, sources, terms, n, documents = [], [], [], [], []
        for (lang, source), (times, found) in held.items():
            langs += [lang] * len(times)
            sources += [source] * len(times)
            terms += times.keys()
            n += times.values()
            documents += map(found.__getitem__, times)
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
             pa.array(n, pa.int64()), pa.array(documents, pa.int64())], ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                found = Counter(text.as_py().translate(TERM_BYTES).split())
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                n.update(found)
                d.update(found.keys())
                size += len(n)
                if size >= HELD:
                    yield rows(held)
                    held, size = {}, 0
        if size:
            yield rows(held)

    named = docs.select(*groups_of(), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return named.mapInArrow(run, COUNTS)


def groups_of() -> list[Column]:
    return [F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("lang", "source")]


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, lang_n, one): counts of the kept terms; ``one`` marks one row of each (lang, term)."""
    term = Window.partitionBy("lang", "term")
    summed = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return summed.select(
        "lang", "source", "term", "n", F.sum("docs").over(term).alias("docs"), F.sum("n").over(term).alias("lang_n"),
        (F.min("source").over(term) == F.col("source")).alias("one"),
    ).filter(F.col("docs") >= min_docs).drop("docs")


def over(a: Column, b: Column) -> Column:
    """Whole division."""
    return F.call_function("div", a, b)


def share(n: Column, total: Column, terms: Column) -> Column:
    """Of ``SCALE`` parts, smoothed by two for every kept term, rounded down, and one."""
    exact = lambda x: x.cast("decimal(20,0)")
    return 1 + over(F.lit(SCALE) * exact(n + 2), exact(F.greatest(total + 2 * terms, F.lit(1))))


def distance(p: Column, q: Column) -> Column:
    return over((p - q) * (p - q), p + q)


def group_table(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per group that occurs: kept words of the group and of its language, kept terms, blocks, least share."""
    every = docs.select(*groups_of()).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = every.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("int").alias("blocks")).join(
        kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("one").alias("terms")), "lang", "left")
    zero = {"total": 0, "lang_total": 0, "terms": 0}
    return every.join(own, ["lang", "source"], "left").join(langs, "lang").fillna(zero).withColumns({
        "least": share(F.lit(0), F.col("total"), F.col("terms")),
        "term_blocks": F.greatest(F.ceil(F.col("terms") / TERM_BLOCK), F.lit(1)).cast("int"),
        "block": F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"),
    })


def cell(key: tuple, rows: pa.Table) -> pa.Table:
    """For each pair of groups of a cell the sum of f over its terms, less as many times the f of their least shares;
    in the first term block with that f for all kept terms. A group's row without a term brings its least share."""
    lang, x, y, _ = (v.as_py() for v in key)
    head = rows.filter(rows["term"].is_null())
    sources, block = head["source"].to_pylist(), head["block"].to_numpy()
    least, terms = head["p"].to_numpy(), head["terms"].to_numpy()
    at = {s: i for i, s in enumerate(sources)}
    body = rows.filter(rows["term"].is_valid())
    term = body["term"].combine_chunks().dictionary_encode()
    if isinstance(term, pa.ChunkedArray):
        term = term.combine_chunks()
    width = len(term.dictionary)
    p = np.repeat(least[:, None], width, axis=1)
    p[np.fromiter(map(at.__getitem__, body["source"].to_pylist()), np.int64, len(body)), term.indices.to_numpy()] = body["p"].to_numpy()
    a, b, f = [], [], []
    for i in np.flatnonzero(block == x):
        others = np.flatnonzero(block == y)
        others = others[others > i] if x == y else others
        q, zero = p[others], least[others]
        here = ((p[i] - q) ** 2 // (p[i] + q)).sum(axis=1)
        both = (least[i] - zero) ** 2 // (least[i] + zero)
        a += [sources[i]] * len(others)
        b += [sources[j] for j in others]
        f.append(here + both * (terms[i] - width))
    values = np.concatenate(f) if f else np.empty(0, np.int64)
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "f": pa.array(values, pa.int64())})


def pair_divergence(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of both orders of each pair of a language's sources."""
    term = shares.select("lang", "source", "block", "blocks", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("t"), "term", "p",
                         F.lit(0).cast("long").alias("terms"))
    blocks = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    head = groups.select("lang", "source", "block", "blocks", F.explode(blocks("term_blocks")).alias("t"), F.lit(None).cast("string").alias("term"),
                         F.col("least").alias("p"), "terms").withColumn("terms", F.when(F.col("t") == 0, F.col("terms")).otherwise(0))
    sent = term.unionByName(head).withColumn("other", F.explode(blocks("blocks")))
    cells = sent.select("lang", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "t", "block", "source", "term", "p", "terms")
    parts = cells.groupBy("lang", "x", "y", "t").applyInArrow(cell, "lang string, a string, b string, f long")
    total = parts.groupBy("lang", "a", "b").agg(F.sum("f").alias("value"))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return total.select("lang", F.explode(both).alias("e"), "value").select("lang", "e.source", "e.item", "value")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows for each other source of the language, and ``term`` rows for
    the ``top`` terms that set a source off from its language."""
    kept = stored(kept_terms(term_counts(docs), min_docs), "terms")
    groups = stored(group_table(docs, kept), "groups")
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    of_lang = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    own = shares.withColumn("q", of_lang).filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    part = lambda df, name: df.select(
        "lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("long").alias("value"), F.row_number().over(order).alias("rank"))
    return part(pair_divergence(shares, groups), "pair").unionByName(part(own, "term").filter(F.col("rank") <= top))


ORACLE_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN kept ON o.lang = kept.lang AND o.term = kept.term
  GROUP BY o.lang, o.source, o.term),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source
  GROUP BY g.lang, g.source),
p AS (
  SELECT gn.lang, gn.source, kept.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 2)::HUGEINT) // (gn.n + 2 * v.v)::HUGEINT AS p,
    1 + (1000000000 * (kept.n + 2)::HUGEINT) // (v.n + 2 * v.v)::HUGEINT AS q
  FROM gn JOIN v ON gn.lang = v.lang JOIN kept ON gn.lang = kept.lang
  LEFT JOIN c ON gn.lang = c.lang AND gn.source = c.source AND kept.term = c.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
