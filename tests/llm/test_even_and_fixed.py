"""Even bands, letters, fixed choices among repeated rows, and lexicons of any size."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from landmart.llm import common, language_id, source_mix, toxicity
from tests.llm.samples import prose, table


@pytest.mark.parametrize("weights", [[0.5], [0.6], [1.0], [0.5, 0.75, 1.0]])
def test_bands_are_even_whatever_the_weights(spark, weights):
    """A hundred documents a band on average: none has a few times as many."""
    n, bands = 20_000, 200
    rows = spark.range(n).withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("id") % len(weights) + 1).cast("int")))
    keyed = rows.withColumn("at", F.lit(1.0) - F.pow(source_mix.uniform(F.col("id"), F.lit("")), F.lit(1.0) / F.col("w")))
    steps = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(n // len(weights)).alias("n")) for w in weights])
    ranked = keyed.withColumn("rank", source_mix.expected_rank(F.col("at"), steps))
    found = ranked.orderBy("at").select("rank").toPandas()["rank"].to_numpy()
    assert (np.diff(found) >= 0).all()  # the order of the keys
    size = Counter(np.minimum(found / n * bands, bands - 1).astype(int).tolist())
    assert max(size.values()) < 2 * n / bands and len(size) == bands


def test_number_signs_are_no_letters(spark):
    docs = table(spark, [(i, "the house is green and the stone is old " * 3, "en") for i in range(1, 40)]
                 + [(i, "das Haus ist grün und der Stein ist alt " * 3, "de") for i in range(40, 80)]
                 + [(100, "½ ²"), (101, "Ⅷ 12 ٣"), (102, "ª"), (103, "字")])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.digest(docs).collect()}
    assert got[100] == got[101] == ("und", 0.0) and got[102][0] != "und" and got[103][0] != "und"


def repeated(spark, order):
    rng = random.Random(5)
    rows = [(i % 40, prose(rng, 20) + (" bad awful" if i % 2 else ""), rng.choice(["en", "fr", "de"])) for i in range(200)]
    random.Random(order).shuffle(rows)
    return table(spark, rows).repartition(order)


def test_repeated_rows_give_the_same_models_in_any_order(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    one, two = (language_id.train(repeated(spark, k)) for k in (1, 4))
    assert one.languages == two.languages and np.array_equal(one.column, two.column) and np.allclose(one.weights, two.weights)
    probe = table(spark, [(1, "bad awful table"), (2, "river")])
    scores = [[tuple(r) for r in toxicity.scored(probe, toxicity.train(repeated(spark, k), labels)).orderBy("doc_id").collect()] for k in (1, 4)]
    assert scores[0] == scores[1]


def test_a_sample_counts_doc_ids(spark):
    """A table in which each row is there ten times gives as large a sample as one in which it is there once."""
    rows = [(i, f"text {i}", "en") for i in range(500)]
    of = lambda times: {r["doc_id"] for r in common.sample(table(spark, rows * times).select("doc_id", "text", "lang"), "lang", 100).collect()}
    assert of(1) == of(10) and len(of(1)) == 100


def test_a_lexicon_has_as_many_entries_as_the_sample_shows(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(10))
    bad, good = [word() for _ in range(2600)], [word() for _ in range(500)]
    rows = [(" ".join(bad if i % 2 else good), i % 2) for i in range(24)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert all(any(w.startswith(e) for e in lexicon.weights) for w in bad) and len(lexicon.weights) > 2000


def test_a_cluster_without_a_shared_folder_raises(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    with pytest.raises(ValueError, match="checkpoint"):
        common.scratch(type("Session", (), {"conf": Conf()})(), "x")
    assert common.scratch(spark, "x")
