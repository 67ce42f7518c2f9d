"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns in every operator."""

import public_tokenizers
import pytest

from landmart.llm import (
    byte_bpe, language_id, line_dedup, ngram_join, quality_rules, secret_scan, source_mix, token_counts, top_k, toxicity,
)
from tests.llm.samples import CLASH, edge_rows, table

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
LABELS = [(i, 1, i % 2) for i in range(1, 12)] + [(None, 1, 1), (4, None, None)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


DIGESTS = {
    "ngram_join": ngram_join.joined,
    "quality_rules": quality_rules.digest,
    "toxicity": lambda docs: toxicity.digest(docs, labels(docs.sparkSession)),
    "secret_scan": secret_scan.digest,
    "secret_classes": secret_scan.classes,
    "source_mix": source_mix.digest,
    "language_id": language_id.digest,
    "token_counts": lambda docs: token_counts.digest(docs, PATH, PATTERN),
    "line_dedup": line_dedup.digest,
    "byte_bpe": lambda docs: byte_bpe.digest(docs, PATH, PATTERN),
}


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", DIGESTS)
def test_odd_rows_and_clashing_columns(spark, name):
    got = DIGESTS[name](table(spark, edge_rows()))
    ids = sorted((str(r["doc_id"]) for r in got.collect()))
    assert ids == sorted(str(r[0]) for r in edge_rows())
    clashing = [x for x in CLASH if x not in ("text", "lang", "source")]
    assert plain(DIGESTS[name](table(spark, edge_rows(), clashing))) == plain(got)


@pytest.mark.parametrize("name", DIGESTS)
def test_empty_table(spark, name):
    assert DIGESTS[name](table(spark, [])).collect() == []


@pytest.mark.parametrize("name", DIGESTS)
def test_all_null(spark, name):
    assert len(DIGESTS[name](table(spark, [(None, None, None, None)] * 3)).collect()) == 3


def test_row_values(spark):
    docs = table(spark, edge_rows())
    by = lambda df: {r["doc_id"]: r for r in df.collect()}
    join = by(ngram_join.joined(docs))
    assert (join[1]["n_shingles"], join[1]["component_id"]) == (0, 1)
    assert (join[3]["n_shingles"], join[4]["n_shingles"], join[6]["n_shingles"]) == (0, 1, 1)
    assert join[7]["component_id"] == 5 and join[4]["component_id"] == 4
    quality = by(quality_rules.digest(docs))
    assert quality[1]["n_words"] == 0 and quality[1]["base_failed"] and not quality[1]["kept"]
    lang = by(language_id.digest(docs))
    assert lang[1]["lang_pred"] == lang[3]["lang_pred"] == "und" and lang[1]["score"] == 0
    lines = by(line_dedup.digest(docs))
    assert (lines[1]["n_lines"], lines[2]["n_lines"], lines[10]["n_lines"]) == (1, 1, 4)
    bpe = by(byte_bpe.digest(docs, PATH, PATTERN))
    assert bpe[1]["n_tokens"] == 0 and bpe[1]["ids_sha256"] == bpe[2]["ids_sha256"]


def test_no_labels(spark):
    docs = table(spark, edge_rows())
    got = toxicity.digest(docs, labels(spark, [])).collect()
    assert {r["score"] for r in got} == {0.0} and len(got) == len(edge_rows())


def test_vectors(spark):
    rows = [
        (0, [1.0, 0.5]), (20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("inf"), 0.0]), (100, []),
        (120, [3e38, -3e38]), (None, [1.0, 1.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [1.0, 2.0, 3.0]), (3, [-1.0, 0.0]), (0, [1.0, 0.5]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = [tuple(r) for r in top_k.digest(df).orderBy("query_id", "rank").collect()]
    of = lambda q: [r[2] for r in got if r[0] == q]
    assert of(0) == [120, 1, 1, 3] and of(20) == of(40) == of(60) == of(80) == [] and of(100) == []
    assert len(of(120)) == 5 and all(-(2**63) <= r[3] < 2**63 for r in got)
    assert top_k.digest(df.limit(0)).collect() == []
