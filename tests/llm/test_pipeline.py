"""The corpus pipeline against plain Python, stage by stage, and the driver's contract."""

import base64
import gc
import hashlib
import math
import random
import re
import time
from collections import defaultdict

import public_tokenizers
import pyarrow as pa
import tiktoken

import corpus_pipeline
from landmart.llm import byte_bpe, source_mix, toxicity
from landmart.llm.common import stored
from tests.llm.test_against_brute_force import brute_components, brute_lines, sets, targets

SMALL = "/root/testdata/sf0.001"


def mixed(docs):
    """Copies of each document: whole epochs, then the smallest exponential keys until the target is reached."""
    size = {i: len([w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]) for i, (t, _) in docs.items()}
    sources, copies = defaultdict(int), {}
    for i, (_, s) in docs.items():
        sources[s] += size[i]

    def key(i):
        text = docs[i][0]
        digest = hashlib.md5(f"{source_mix.SEED}|{i}|{hashlib.md5(text.encode()).hexdigest()}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / source_mix.SCALE
        marks = sum(not (c.isalpha() or c.isspace()) for c in text)
        w = 1 - marks / len(text) * 0.5 if text else 0.5
        return -math.log(u) / w

    for s, target in targets(dict(sources)).items():
        epochs = min(3, int(target / sources[s])) if sources[s] else 0
        rest = round(target - epochs * sources[s])
        # the smallest exponential key is the largest u ** (1 / w); the operator's order is the reverse of that
        for i in sorted((i for i in docs if docs[i][1] == s), key=lambda i: (1 - math.exp(-key(i)), i)):
            part = max(0, min(size[i], rest))
            rest -= size[i]
            copies[i] = epochs + (part > 0 and 2 * part >= size[i])
    return copies


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    toxic = {r["doc_id"] for r in toxicity.digest(docs, labels).filter("predicted = 1").collect()}
    out, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, SMALL), name)
        out[name] = now.collect()
        if name != "byte_bpe":
            assert now.columns == docs.columns and now.dtypes == docs.dtypes
    assert {r["doc_id"] for r in out["toxicity"]} == set(rows) - toxic and len(toxic) < len(rows) / 4

    clean = [(i, rows[i]["text"]) for i in rows if i not in toxic]
    lines = brute_lines(clean)
    got = {r["doc_id"]: r for r in out["line_dedup"]}
    assert {i: hashlib.sha256((r["text"] or "").encode()).hexdigest() for i, r in got.items()} == {i: x[2] for i, x in lines.items()}
    assert all(r["n_chars"] == len(r["text"]) for i, r in got.items() if lines[i][1])

    groups = brute_components(sets([(i, r["text"]) for i, r in got.items()]))
    assert sorted(r["doc_id"] for r in out["ngram_join"]) == sorted(set(groups.values()))

    copies = mixed({r["doc_id"]: (r["text"], r["source"]) for r in out["ngram_join"]})
    assert sorted(r["doc_id"] for r in out["source_mix"]) == sorted(i for i, n in copies.items() for _ in range(n))

    ranks = byte_bpe.Encoder(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN).ranks
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in out["byte_bpe"]:
        text = got[r["doc_id"]]["text"]
        assert r["ids"] == want.encode_ordinary(text) and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert sorted(r["doc_id"] for r in out["byte_bpe"]) == sorted(r["doc_id"] for r in out["source_mix"])
    assert sorted(map(repr, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(repr, out["byte_bpe"]))


def test_odd_documents_pass(spark, tmp_path):
    from tests.llm.samples import edge_rows, table

    for rows, folder in ((edge_rows(), "odd"), ([], "none")):
        table(spark, rows, ["_id", "row", "extra col"]).write.parquet(f"{tmp_path}/{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 1), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{folder}").collect()
        assert bool(got) == bool(rows)


def test_repeated_ids_keep_their_own_groups(spark):
    """Rows of one doc_id with other texts are groups of their own, and a duplicate never stays for another row."""
    from tests.llm.samples import edge_rows, prose, table

    kept = lambda rows: sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(
        spark, table(spark, rows, ["c", "row", "extra col"]).repartition(3), SMALL).collect()), key=repr)
    odd = edge_rows()
    want = {(r[0], r[1]) for r in odd if r[0] is not None and r[0] != 7}
    assert kept(odd) == sorted([*want, *((r[0], r[1]) for r in odd if r[0] is None)], key=repr)
    one, two = (prose(random.Random(k), 50) for k in (1, 2))
    assert kept([(1, one), *[(2, one)] * 5, (2, two), (3, two), (2, None), (2, "")]) == sorted([(1, one), (2, two), (2, "")], key=repr)


def test_workers_keep_no_encoder(spark, tmp_path):
    """Idle Python workers hold nothing of the last stage, whose memory the stages of the next run need."""
    pattern = "(?:own|[^o]|o)"  # tells this test's encoders from others in the same workers
    ranks = tmp_path / "ranks"
    ranks.write_bytes(b"".join(base64.b64encode(bytes([i])) + b" %d\n" % i for i in range(256)))

    def held(batches):
        time.sleep(0.3)  # for all workers to take part
        found = [x for x in gc.get_objects() if type(x).__name__ == "Encoder" and "pattern" in vars(x) and x.pattern.pattern == pattern]
        yield from (pa.RecordBatch.from_arrays([pa.array([len(found)] * b.num_rows)], ["n"]) for b in batches)

    docs = spark.createDataFrame([(i, f"own text {i}") for i in range(16)], "doc_id long, text string").repartition(8)
    got = byte_bpe.with_ids(docs, str(ranks), pattern).collect()
    assert {r["doc_id"]: bytes(r["ids"]).decode() for r in got} == {i: f"own text {i}" for i in range(16)}
    assert {r["n"] for r in spark.range(0, 8, 1, 8).mapInArrow(held, "n long").collect()} == {0}


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert [n for n in range(1, 11) if any(x.startswith(f"op{n}_") for x in names)] == list(range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names) and [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_join", "source_mix", "byte_bpe"]
