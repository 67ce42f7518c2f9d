"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Base counts are exact over the whole text. A document fails the base with fewer than 10 words or with
more than a fifth of its words in repeated five-word windows; otherwise every rule of the table must
hold. A rule bounds a ratio of counts and applies from a number of words on, so short documents are
judged by their length alone.

Null or empty text counts as a text without words: all counts 0, base failed. Repeated rows give
repeated results, null doc_ids stay null, empty tables give empty results. Only doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landmart.llm.common import BLANKS, documents, let, words

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the languages in scope.
STOP_WORDS = (
    "the and of to in is that for it with as was on be at by this from or an "
    "der die das und ist nicht mit von den ein eine zu auf für sich dem im "
    "le la les et des un une est dans que qui pour pas sur du en au "
    "el los las y del por con para no se lo al como más"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high`` for documents of at least ``from_words`` words."""

    name: str
    numerator: str
    denominator: str
    low: float
    high: float
    from_words: int = MIN_WORDS


RULES = (
    Rule("word_length", "word_chars", "n_words", 1.5, 20.0),
    Rule("symbols", "n_symbols", "n_words", 0.0, 0.25),
    Rule("duplicate_lines", "n_dup_lines", "n_text_lines", 0.0, 0.5),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_text_lines", 0.0, 0.5),
    Rule("letters", "n_letter_words", "n_words", 0.5, 1.0),
    Rule("upper_case", "n_upper", "word_chars", 0.0, 0.6),
    Rule("stop_words", "n_stop_words", "n_words", 0.01, 1.0, 100),
)


def window_hashes(found: Column) -> Column:
    """A hash of each five-word window, in order."""
    return F.when(F.size(found) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(found) - WINDOW),
        lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(WINDOW)]),
    )).otherwise(F.array().cast("array<bigint>"))


def repeated_words(hashes: Column) -> Column:
    """Words in windows found twice or more. Only texts with a repeated window are sorted: equal windows
    meet as neighbours, and what their sorted positions cover is summed."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twins = lambda s: F.transform(
        F.filter(F.transform(s, lambda x, k: F.struct(
            x["i"].alias("i"),
            ((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])).alias("twin"))),
            lambda x: F.coalesce(x["twin"], F.lit(False))),
        lambda x: x["i"])
    covered = lambda p: F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        let(placed, lambda s: let(F.array_sort(twins(s)), covered)))


def verdict(rules: tuple[Rule, ...]) -> Column:
    """One expression for a whole threshold table. A ratio over nothing holds."""
    out = F.lit(True)
    for r in rules:
        ratio = F.col(r.numerator) / F.nullif(F.col(r.denominator), F.lit(0))
        out = out & ((F.col("n_words") < r.from_words) | F.coalesce(ratio.between(r.low, r.high), F.lit(True)))
    return out


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id with all counts, ``base_failed`` and ``kept``."""
    text = F.coalesce("text", F.lit(""))
    long = lambda c: c.cast("long")
    stops = list(dict.fromkeys(STOP_WORDS))  # looked up in a set: as an array they would be compared one by one
    counted = documents(docs).select("doc_id", text.alias("text")).select(
        "doc_id", "text", words(F.col("text")).alias("w"),
        F.filter(F.split("text", "\n", -1), lambda x: F.length(F.trim(x, F.lit(BLANKS))) > 0).alias("l"),
    ).select(
        "doc_id",
        long(F.size("w")).alias("n_words"),
        long(F.length(F.translate("text", BLANKS, ""))).alias("word_chars"),
        long(F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        long(F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        long(let(window_hashes(F.col("w")), repeated_words)).alias("n_repeat_words"),
        long(F.size("l")).alias("n_text_lines"),
        long(F.size(F.filter("l", lambda x: x.endswith("...") | x.endswith("…")))).alias("n_ellipsis_lines"),
        long(F.size(F.filter("w", lambda x: x.rlike("\\p{L}")))).alias("n_letter_words"),
        long(F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")) * -1 + F.length("text")).alias("n_upper"),
        long(F.size(F.filter("w", lambda x: F.lower(F.rtrim(x, F.lit(".,;:!?"))).isin(stops)))).alias("n_stop_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def digest(docs: DataFrame) -> DataFrame:
    return judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = f"""
WITH body AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT r, doc_id, text,
    list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(text, chr(10)),
      lambda x: trim(x, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) <> '') AS l
  FROM body),
win AS (
  SELECT r, unnest(range(0, len(w) - 4)) AS i, unnest(list_transform(range(1, len(w) - 3),
    lambda k: w[k:k + 4])) AS g FROM found WHERE len(w) >= 5),
twins AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
covered AS (
  SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twins) GROUP BY r),
counts AS (
  SELECT doc_id, len(w) AS n_words, length(translate(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
    length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_text_lines,
    len(list_filter(l, lambda x: x LIKE '%...' OR x LIKE '%…')) AS n_ellipsis_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS n_letter_words,
    length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_upper,
    len(list_filter(w, lambda x: list_contains([{", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))}],
      lower(rtrim(x, '.,;:!?'))))) AS n_stop_words
  FROM found LEFT JOIN covered c USING (r)),
failed AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {" AND ".join(
    f"(n_words < {r.from_words} OR coalesce({r.numerator} / nullif({r.denominator}, 0) BETWEEN {r.low} AND {r.high}, true))"
    for r in RULES)} AS kept
FROM failed
"""
