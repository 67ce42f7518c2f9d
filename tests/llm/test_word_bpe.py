"""Word BPE against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from landmart.llm import word_bpe
from tests.llm.samples import CLASH, edge_rows, table

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    vocabulary = word_bpe.read_vocabulary(PATH)
    cut, merge = word_bpe.Cutter(vocabulary), word_bpe.Merges(vocabulary)
    return lambda text: [i for w in cut.words(text) for i in merge.encode(w)]


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    text = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_every_usual_letter(library, own):
    """All code points that take the short way, and every 41st of the others."""
    for c in [*range(0x250), *range(0x250, 0xD800, 41), *range(0xE000, 0x110000, 41)]:
        text = f"a{chr(c)}B {chr(c)}{chr(c)}1 '{chr(c)}s Σ{chr(c)}"
        assert own(text) == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_random_texts(library, own):
    rng = random.Random(5)
    letters = "aAbBéÉ çßſİıΣσςàåèÅ가각'’sStTrevmld<|startoftext|> 0123½²\n\t\x1c\x85\xa0 　🙂"
    for k in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        if k % 10 == 0:
            text += rng.choice(["<|startoftext|>", "x<|endoftext|>y"]) + text
        assert own(text) == library.encode(text, add_special_tokens=False).ids, text


def test_long_word(library, own):
    word = "".join(random.Random(1).choice("abcde") for _ in range(60_000))
    assert own(word) == library.encode(word, add_special_tokens=False).ids


def test_given_documents(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in word_bpe.digest(docs, PATH).collect()}
    assert got == {r["doc_id"]: expected(library, r["text"]) for r in docs.collect()}


def test_many_chunks(spark, library, monkeypatch):
    """Each task makes several chunks, and each chunk several packs."""
    monkeypatch.setattr(word_bpe, "CHUNK_LENGTH", 300)
    monkeypatch.setattr(word_bpe, "PACKED", 50)
    docs = table(spark, edge_rows() + [(100 + i, "Hello hello, world's " * i) for i in range(30)]).repartition(3)
    got = sorted(tuple(r) for r in word_bpe.digest(docs.filter("doc_id IS NOT NULL"), PATH).collect())
    assert got == sorted((r["doc_id"], *expected(library, r["text"])) for r in docs.collect() if r["doc_id"] is not None)
    rows = {r["doc_id"]: r for r in word_bpe.encoded(docs.filter("doc_id > 99"), PATH).collect()}
    for i in range(30):
        ids = library.encode("Hello hello, world's " * i, add_special_tokens=False).ids
        assert rows[100 + i]["ids"] == ids and rows[100 + i]["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_decoding_any_ids(spark, library):
    rows = [(1, [320, 49406, 5, 5]), (2, [0]), (3, [49405, 300])]
    got = word_bpe.decoded(spark.createDataFrame(rows, "k int, ids array<int>"), "k", word_bpe.read_vocabulary(PATH)).collect()
    assert {r["k"]: r["decoded"] for r in got} == {k: library.decode(ids, skip_special_tokens=False) for k, ids in rows}


def test_odd_rows(spark, library):
    got = sorted((tuple(r) for r in word_bpe.digest(table(spark, edge_rows()), PATH).collect()), key=repr)
    assert got == sorted(((r[0], *expected(library, r[1])) for r in edge_rows()), key=repr)
    clashing = [x for x in CLASH if x != "text"] + ["chunk", "codes", "ids", "words"]
    assert got == sorted((tuple(r) for r in word_bpe.digest(table(spark, edge_rows(), clashing), PATH).collect()), key=repr)
    assert word_bpe.digest(table(spark, []), PATH).collect() == []
    assert len(word_bpe.digest(table(spark, [(None, None, None, None)] * 3), PATH).collect()) == 3


def test_another_make_raises():
    with pytest.raises(ValueError):
        word_bpe.Cutter(word_bpe.read_vocabulary(PATH).replace('"NFC"', '"NFD"', 1))
