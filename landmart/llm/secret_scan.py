"""Secret scans with corpus-wide ownership frequency.

Base kinds are found in every text by their patterns. The method adds spans of kind ``owned``: long
tokens of letters, in any case, and digits that look like credentials. Their hashes are counted over the corpus by
distinct repositories (host part of ``repo``, here documents) and distinct owners (sources); a value of at
most ``MAX_DOCS`` documents and ``MAX_OWNERS`` owners is live-looking and becomes a span, a widely copied one
is an example and does not. Base spans always stay, with their class beside them.

``digest``, the query op5_secret_scans, returns the contract's columns and the classes; ``classes``, the query
op5_secret_classes, spans with their class. An ``owned`` span can lie in a base span or be the same.

Positions come from the patterns' gaps and matches: a text is the alternation of both, so running sums of
their lengths are the spans, in code points.

Null text is an empty text. Null sources are one owner. Rows that repeat a doc_id and text are one
document of the statistics and each get the same result; null doc_ids are ids like others. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landmart.llm.common import documents, let, stored

MAX_OWNERS = 2
MAX_DOCS = 4


@dataclass(frozen=True)
class Kind:
    """``value`` takes the secret out of a match; shorter ones than ``least`` are dropped. ``hint`` is a
    cheap test that every text with a match passes."""

    name: str
    pattern: str
    least: int
    hint: str
    value: str = "(?s)(.*)"


ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE = (
    Kind("assign", ASSIGN, 6, "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]",
         "^(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)$"),
    Kind("access", "AKIA[A-Z0-9]+", 20, "AKIA"),
    Kind("hex", "[0-9a-f]+", 24, "[0-9a-f]{24}"),
)
#: Letters in any case with a digit. Only the start of a run is tried.
TOKEN = Kind(
    "owned", "[A-Za-z0-9_+/-]+", 20,
    "(?<![A-Za-z0-9_+/-])(?=[A-Za-z0-9_+/-]{20})(?=[A-Za-z_+/-]*[0-9])(?=[0-9_+/-]*[A-Za-z])[A-Za-z0-9_+/-]")
#: What the value of a candidate has besides its length.
LIVE = ("[0-9]", "[A-Za-z]")
SPAN = "array<struct<start:int,kind:int,name:string,stop:int,value:string>>"


def spans(text: Column, kind: Kind, number: int) -> Column:
    """All matches of a kind that are long enough, with their code point spans."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)

    def located(m: Column) -> Column:
        steps = F.transform(m, lambda x, i: F.struct(x.alias("x"), F.length(F.get(gaps_at, i)).alias("gap")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
        return F.aggregate(
            steps, start,
            lambda a, s: F.struct(
                (a["at"] + s["gap"] + F.length(s["x"])).alias("at"),
                F.when(value_of(s["x"]) >= kind.least, F.concat(a["out"], F.array(F.struct(
                    (a["at"] + s["gap"]).alias("start"), F.lit(number).alias("kind"), F.lit(kind.name).alias("name"),
                    (a["at"] + s["gap"] + F.length(s["x"])).alias("stop"), F.regexp_extract(s["x"], kind.value, 1).alias("value"),
                )))).otherwise(a["out"]).alias("out")),
            lambda a: a["out"])

    def value_of(x: Column) -> Column:
        return F.length(F.regexp_extract(x, kind.value, 1))

    gaps_at = None

    def with_gaps(g: Column) -> Column:
        nonlocal gaps_at
        gaps_at = g
        return let(found, located)

    return F.when(text.rlike(kind.hint), let(gaps, with_gaps)).otherwise(F.array().cast(SPAN))


def found_in(docs: DataFrame) -> DataFrame:
    """doc_id, source, the digest of the text, and per document its base spans and credential-like tokens."""
    text = F.col("text")
    live = lambda x: reduce(and_, (x["value"].rlike(p) for p in LIVE))
    rows = documents(docs, F.col("source").cast("string").alias("source")).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"),
        F.concat(*[spans(text, k, i) for i, k in enumerate(BASE)]).alias("base"),
        F.filter(spans(text, TOKEN, len(BASE)), live).alias("more"),
    )


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate value (by hash): distinct documents and owners that have it. Counted in two steps that
    combine before they shuffle; no task gets all documents of a value that is everywhere."""
    each = found.select(
        F.explode(F.array_distinct(F.transform(F.concat("base", "more"), lambda x: F.xxhash64(x["value"])))).alias("secret"),
        "source", "doc_id", "text_hash")
    return each.groupBy("secret").agg(  # structs, so that nulls count
        F.count_distinct(F.struct("doc_id", "text_hash")).alias("n_docs"), F.count_distinct(F.struct("source")).alias("n_owners"))


def scanned(docs: DataFrame, max_owners: int = MAX_OWNERS, max_docs: int = MAX_DOCS) -> DataFrame:
    """doc_id, base spans, all spans with their class and the number of owner-specific base secrets, one row per
    row of ``docs``.

    Spans are joined with the owner-specific values only, which lie in a table of their own: a value that is
    everywhere finds nothing, and Spark can split its rows."""
    found = stored(found_in(docs), "secrets")
    rare = stored(ownership(found).filter((F.col("n_owners") <= max_owners) & (F.col("n_docs") <= max_docs)).select(
        "secret", F.lit(True).alias("live")), "rare-secrets")
    key = ["doc_id", "text_hash"]
    each = (
        found.filter(F.size("base") + F.size("more") > 0)
        .select(*key, F.explode(F.concat("base", "more")).alias("x"))
        .withColumn("secret", F.xxhash64("x.value"))
        .join(rare, "secret", "left").withColumn("live", F.coalesce("live", F.lit(False)))
        .filter((F.col("x.kind") < len(BASE)) | F.col("live"))
        .groupBy(*key)
        .agg(F.array_sort(F.collect_set(F.struct("x.start", "x.kind", "x.name", "x.stop", "live"))).alias("spans"))
    )
    each = stored(each.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans"), "spans")
    classed = "array<struct<start:int,kind:int,name:string,stop:int,live:boolean>>"
    return found.join(
        each, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left"
    ).select("doc_id", "base", F.coalesce("spans", F.array().cast(classed)).alias("spans")).withColumn(
        "n_live", F.size(F.filter("spans", lambda x: (x["kind"] < len(BASE)) & x["live"])).cast("long"))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["name"], x["start"], x["stop"])), ",")


def labelled(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["name"], x["start"], x["stop"], F.when(x["live"], "live").otherwise("copied"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, how many base secrets are owner-specific and how many widely copied, and the class of
    every span."""
    n = lambda i: F.size(F.filter("base", lambda x: x["kind"] == i)).cast("long")
    return scanned(docs).select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(joined(F.array_sort("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        "n_live", (F.size("base") - F.col("n_live")).alias("n_copied"), labelled(F.col("spans")).alias("classes"))


def classes(docs: DataFrame) -> DataFrame:
    """Every span with its class, and how many base secrets are owner-specific and how many widely copied."""
    return scanned(docs).select(
        "doc_id", "n_live", (F.size("base") - F.col("n_live")).alias("n_copied"), labelled(F.col("spans")).alias("spans"))


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


KINDS_SQL = " UNION ALL ".join(
    f"SELECT r, {i} AS kind, {_sql(k.name)} AS name, {k.least} AS least, {_sql(k.value)} AS value, "
    f"regexp_extract_all(t, {_sql(k.pattern)}) AS m, string_split_regex(t, {_sql(k.pattern)}) AS g FROM body"
    for i, k in enumerate((*BASE, TOKEN)))

SPANS_SQL = f"""
WITH body AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
kinds AS ({KINDS_SQL}),
each AS (SELECT r, kind, name, least, value, m, g, unnest(range(1, len(m) + 1)) AS k FROM kinds WHERE len(m) > 0),
placed AS (
  SELECT r, kind, name, least, regexp_extract(m[k], value, 1) AS v, length(m[k]) AS size,
    (list_sum(list_transform(g[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0))::BIGINT AS start
  FROM each),
found AS (
  SELECT *, name || ':' || start || ':' || (start + size) AS span FROM placed
  WHERE length(v) >= least AND (kind < {len(BASE)} OR regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]'))),
owners AS (
  SELECT v, count(DISTINCT coalesce('s' || source, '-')) <= {MAX_OWNERS}
    AND count(DISTINCT coalesce('d' || doc_id, '-') || ' ' || md5(t)) <= {MAX_DOCS} AS live
  FROM found JOIN body USING (r) GROUP BY v),
spans AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(span, ',' ORDER BY start, kind) FILTER (kind < {len(BASE)}) AS base,
    count(*) FILTER (kind < {len(BASE)} AND live) AS n_live, count(*) FILTER (kind < {len(BASE)} AND NOT live) AS n_copied,
    string_agg(span, ',' ORDER BY start, kind) FILTER (kind < {len(BASE)} OR live) AS spans,
    string_agg(span || CASE WHEN live THEN ':live' ELSE ':copied' END, ',' ORDER BY start, kind)
      FILTER (kind < {len(BASE)} OR live) AS classes
  FROM found JOIN owners USING (v) GROUP BY r)
"""

ORACLE_SQL = f"""{SPANS_SQL}
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied, coalesce(classes, '') AS classes
FROM body LEFT JOIN spans USING (r)
"""

CLASSES_SQL = f"""{SPANS_SQL}
SELECT doc_id, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied, coalesce(classes, '') AS spans
FROM body LEFT JOIN spans USING (r)
"""
