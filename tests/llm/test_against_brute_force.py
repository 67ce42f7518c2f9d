"""Operators against plain Python over whole small tables."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from landmart.llm import byte_bpe, language_id, line_dedup, ngram_join, quality_rules, secret_scan, source_mix, token_counts, top_k, toxicity
from tests.llm.samples import prose, table

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SMALL = "/root/testdata/sf0.01"
BLANK = r"[\x20\x09-\x0D]"


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else w + "x" for w in text.split(" "))


# --- n-gram join


def sets(rows):
    out = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        out[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    return out


def brute_components(found):
    root = {i: i for i in found}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(found)
    for p, a in enumerate(ids):
        for b in ids[p + 1:]:
            if found[a] and found[b] and 100 * len(found[a] & found[b]) >= 75 * len(found[a] | found[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in ids}


def corpus(seed):
    """Copies, chains of near copies, a passage in every third document, documents that are mostly passage."""
    rng = random.Random(seed)
    passage, rows = prose(rng, 60), []
    for _ in range(25):
        text = prose(rng, rng.choice([3, 5, 8, 30, 120, 300]))
        if rng.random() < 0.4:
            text += " " + passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            rows.append(text)
            if rng.random() < 0.6:
                text = edited(rng, text, rng.choice([0.005, 0.02, 0.04]))
    base = prose(rng, 150)
    rows += [edited(rng, base, 0.015) for _ in range(40)]  # a large group of near copies
    rows += [passage + " " + prose(rng, rng.randrange(1, 25)) for _ in range(30)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ngram_join(spark, seed):
    rows = corpus(seed)
    found = sets(rows)
    want = brute_components(found)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.joined(table(spark, rows).repartition(3)).collect()}
    assert got == {i: (len(found[i]), want[i]) for i in found}
    assert len(set(want.values())) < len(rows) - 30


def test_long_lists_change_nothing(spark, monkeypatch):
    rows = corpus(4)
    docs = table(spark, rows)
    want = sorted(map(tuple, ngram_join.joined(docs).collect()))
    some = np.unique(np.concatenate([ngram_join.shingles(t)[::2] for _, t in rows]))
    plain = ngram_join.firsts
    for lists in (np.empty(0, np.uint64), some):
        monkeypatch.setattr(ngram_join, "firsts", lambda d, _, lists=lists: plain(d, lists))
        assert sorted(map(tuple, ngram_join.joined(docs).collect())) == want
        monkeypatch.undo()


@pytest.mark.parametrize("repeated", [False, True])
def test_sets_are_sent_in_rounds(spark, monkeypatch, repeated):
    """Only the sets of a round are on their way at a time, and they are kept as texts until then."""
    rows = corpus(5)
    want = brute_components(sets(rows))
    rows += rows[::3] * repeated
    kept, stored = [], ngram_join.stored

    def noted(df, name, *by, **options):
        kept.append((name, df.columns))
        return stored(df, name, *by, **options)

    monkeypatch.setattr(ngram_join, "stored", noted)
    monkeypatch.setattr(ngram_join, "by_leaders", lambda docs, *_: docs.sparkSession.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(ngram_join, "ROUND", 1)
    monkeypatch.setattr(ngram_join, "ROUNDS", 5)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.joined(table(spark, rows).repartition(3)).collect()}
    assert got == want
    assert not any("set" in columns for _, columns in kept)
    assert sum(name == "links" for name, _ in kept) == 5


def test_blanks_around_words_change_nothing():
    text = b" \n" + b"some words of a text \t\t" * 5000 + b"\n "
    found = ngram_join.word_hashes(text)
    assert (found == ngram_join.word_hashes(b" ".join(text.split()))).all() and len(np.unique(found)) == 5
    assert len(ngram_join.word_hashes(b" \n ")) == 0


def test_shingles_are_made_in_place(monkeypatch):
    """At most three arrays of the text's length are held at a time, not one for each step."""
    words = np.random.default_rng(1).integers(0, 2**64, 100_000, np.uint64)
    monkeypatch.setattr(ngram_join, "word_hashes", lambda text: words)
    tracemalloc.start()
    try:
        found = ngram_join.shingles("x")
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found) == len(words) - 4 and (found[1:] > found[:-1]).all()
    assert most < 32 * len(words)


def test_word_hashes_by_pieces(monkeypatch):
    text = prose(random.Random(1), 400).encode() + b"\n\t" + b"w" * 500 + b" end"
    whole = ngram_join.word_hashes(text)
    assert len(whole) == len(text.split()) and len(np.unique(whole)) == len(set(text.split()))
    monkeypatch.setattr(ngram_join, "PIECE", 64)
    ngram_join.tables.cache_clear()
    pieces = ngram_join.word_hashes(text)
    ngram_join.tables.cache_clear()
    assert len(pieces) == len(whole) and (pieces == whole).sum() == len(whole) - 1


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(300, 300 + i) for i in range(50)]
    got = {r["node"]: r["root"] for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        if a == b:
            continue
        x, y = root.setdefault(a, {a}), root.setdefault(b, {b})
        if x is not y:
            x |= y
            for n in y:
                root[n] = x
    assert got == {n: min(s) for n, s in root.items()}


# --- top-k


def test_top_k(spark, monkeypatch):
    for name, value in (("SHARD", 150), ("BLOCK", 7), ("LEAF", 16)):
        monkeypatch.setattr(top_k, name, value)
    rng = np.random.default_rng(3)
    v = rng.normal(0, 0.2, (700, 8)).astype(np.float32)
    v[100:300] = v[100]  # many ties
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in top_k.digest(df.repartition(3)).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    q = np.floor(64 * v.astype(np.float64)).astype(np.int64)
    for i in range(0, 700, 20):
        score = q @ q[i]
        order = sorted((x for x in range(700) if x != i), key=lambda x: (-score[x], x))[:20]
        assert got[i] == [(x, score[x]) for x in order]
    assert len(got) == 35


@pytest.mark.parametrize("pack", [2, 1024])
def test_shards_that_cannot_reach_are_not_sent(spark, monkeypatch, pack):
    """Clusters in twelve directions: a block meets the shards of its own, not all; the result is exact."""
    for name, value in (("SHARD", 60), ("BLOCK", 10), ("LEAF", 16), ("PACK", pack)):
        monkeypatch.setattr(top_k, name, value)
    rng = np.random.default_rng(6)
    middle = rng.normal(0, 1, (12, 16))
    v = (middle[np.arange(1200) % 12] * 4 + rng.normal(0, 0.05, (1200, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    sent, search = [], top_k.searched
    monkeypatch.setattr(top_k, "searched", lambda pairs, k: sent.append(pairs.select("block", "shard").collect()) or search(pairs, k))
    got = defaultdict(list)
    for r in top_k.digest(df.repartition(3)).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    q = np.floor(64 * v.astype(np.float64)).astype(np.int64)
    for i in range(0, 1200, 20):
        score = q @ q[i]
        assert got[i] == [(x, score[x]) for x in sorted((x for x in range(1200) if x != i), key=lambda x: (-score[x], x))[:20]]
    pairs = [tuple(r) for x in sent for r in x]
    assert len(pairs) == len(set(pairs)) and len(sent) > 1
    blocks, shards = len({b for b, _ in pairs}), max(s for _, s in pairs) + 1
    assert shards >= 12 and len(pairs) < blocks * shards / 2


def test_split_balls_keep_every_row(spark):
    """More rows than a leaf holds: the tree's leaves have each row once, and each ball its rows."""
    rng = np.random.default_rng(8)
    v = np.floor(64 * rng.normal(0, 0.2, (1700, 8))).astype(np.int64)
    tree = top_k.build(np.arange(1700), v)
    assert len(tree.low) > 3 and sorted(tree.ids) == list(range(1700)) and (tree.rows == v[tree.ids]).all()
    for low, high, center, radius in zip(tree.low, tree.high, tree.center, tree.radius):
        assert np.sqrt(((tree.rows[low:high] - center) ** 2).sum(1)).max() <= radius + 1e-6
    df = spark.createDataFrame([(i, [float(y) / 64 for y in x]) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in top_k.digest(df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for i in range(0, 1700, 20):
        score = v @ v[i]
        assert got[i] == [(x, score[x]) for x in sorted((x for x in range(1700) if x != i), key=lambda x: (-score[x], x))[:20]]


def test_large_components_are_exact():
    q = np.array([[2**40, 3], [1, -(2**50)]])
    v = np.array([[2**13, 5], [7, 2**12]])
    assert top_k.products(q, v).tolist() == [[2**53 + 15, 7 * 2**40 + 3 * 2**12], [2**13 - 5 * 2**50, 7 - 2**62]]


# --- quality rules, lines, secrets


def test_stop_words_are_looked_up_in_a_set(spark):
    docs = table(spark, [(1, "The cat, and THE dog... für, thethe und. nothing"), (2, None)])
    plan = quality_rules.judged(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" not in plan and "INSET" in plan
    assert {r["doc_id"]: r["n_stop_words"] for r in quality_rules.judged(docs).collect()} == {1: 5, 2: 0}


def test_quality_counts(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["a", "b", "cc", "#d", "é\n", "\n x"]) for _ in range(rng.randrange(60)))) for i in range(120)]
    for r in quality_rules.judged(table(spark, rows)).collect():
        text = rows[r["doc_id"]][1]
        w = [x for x in re.split(BLANK + "+", text) if x]
        grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        n = Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if re.sub(BLANK, "", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_threshold_table(spark):
    rules = (quality_rules.Rule("symbols", "n_symbols", "n_words", 0.0, 0.1),)
    rows = [(1, "one two three four five six seven eight nine ten"), (2, "one# two# three four five six seven eight nine ten")]
    assert {r["doc_id"]: r["kept"] for r in quality_rules.judged(table(spark, rows), rules).collect()} == {1: True, 2: False}


def brute_lines(rows):
    key = lambda x: re.sub(f"^{BLANK}+|{BLANK}+$", "", x).translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for i, text in rows:
        for x in (text or "").split("\n"):
            if len(key(x)) >= 40:
                holders[key(x)].add(i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def line_rows(seed):
    rng = random.Random(seed)
    shared = [prose(rng, 8) for _ in range(12)] + ["É" + prose(rng, 8)]
    deco = lambda x: rng.choice(["", " ", "\t"]) + rng.choice([x, x.title(), x.upper()]) + rng.choice(["", " \r", "  "])
    return [(i, "\n".join(deco(rng.choice(shared)) if rng.random() < 0.3 else prose(rng, rng.randrange(9)) for _ in range(rng.randrange(12)))) for i in range(70)]


def test_line_dedup(spark):
    rows = line_rows(1)
    got = {r["doc_id"]: tuple(r)[1:] for r in line_dedup.digest(table(spark, rows)).collect()}
    assert got == brute_lines(rows) and sum(x[1] for x in got.values()) > 20


def test_line_runs_by_batches(spark):
    rows = line_rows(2)
    docs = table(spark, rows)
    runs = line_dedup.LineRuns(spark, fanout=2)
    for k in range(5):
        runs.add(docs.filter(f"doc_id % 5 = {k}"))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    got = line_dedup.kept_lines(docs, runs).collect()
    want = brute_lines(rows)
    assert {r["row"]["doc_id"]: (r["n_lines"], r["n_dropped"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in got} == want


@pytest.mark.parametrize("batches", [1, 6, 9])
def test_lines_of_repeated_and_null_ids(spark, batches):
    """Rows of one doc_id are one document, rows without one are told apart by their text; the SQL says the same."""
    four, five, null, more = (f"{c} " * 30 for c in "abcd")
    rows = [(i, f"{four}\nx{i}\n {five.upper()}") for i in (1, 2, 3, 4)] + [(4, f"other\n{four}"), (9, five)]
    rows += [(None, f"{null}\n{k}") for k in range(6)] + [(None, f"{more}\n{k % 3}") for k in range(9)] + [(7, more), (8, more), (7, f"again\n{more}")]
    docs = table(spark, rows)
    got = sorted((tuple(r) for r in line_dedup.in_batches(docs, batches).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=repr)
    by = [(r[0], r[2]) for r in got]
    assert by.count((4, 1)) == 1 and by.count((4, 0)) == 1  # five has five documents, four only four
    assert (9, 0) in by and by.count((7, 1)) == 2 and (8, 0) in by
    assert by.count((None, 1)) == 9 and by.count((None, 0)) == 6  # only rows without an id have `null`
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    hashed = sorted(((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in got), key=repr)
    assert hashed == sorted(con.execute(line_dedup.ORACLE_SQL).fetchall(), key=repr)


ASSIGN = re.compile(r'((?i:password|passwd|secret|token|api_?key))["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)')


def test_secrets(spark):
    rng = random.Random(9)
    parts = ["password=abc", "Secret: 'hunter2xyz'", "token=", "secret=token:abcdefgh", "API_KEY = \"Zz9/+-_.=a\"", "AKIA" + "A1" * 10, "AKIA99",
             "0123456789abcdef01234567", "deadbeef", "é", "🙂", "\n", " ", "x", "apikey:12345", "a" * 30]
    rows = [(i, "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(12)))) for i in range(150)]
    kinds = [("assign", ASSIGN, 6, 2), ("access", re.compile("AKIA[A-Z0-9]+"), 20, 0), ("hex", re.compile("[0-9a-f]+"), 24, 0)]
    for r in secret_scan.digest(table(spark, rows)).collect():
        found = sorted((m.start(), k, f"{n}:{m.start()}:{m.end()}") for k, (n, p, least, g) in enumerate(kinds)
                       for m in p.finditer(rows[r["doc_id"]][1]) if len(m.group(g)) >= least)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[1] == k for x in found) for k in range(3)]
        assert r["base_sha256"] == hashlib.sha256(",".join(x[2] for x in found).encode()).hexdigest()
        assert {x[2] for x in found} <= set(r["spans"].split(","))


def test_ownership(spark):
    own, example = "ghp_Abc123Def456Ghi789Jkl", "EXAMPLE_key_1234567890_zZ"
    rows = [(i, f"use {example} here", "en", f"src{i}") for i in range(6)] + [(10, f"my {own}!", "en", "src1"), (11, f"{own} again", "en", "src1")]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.digest(table(spark, rows)).collect()}
    assert got[10] == f"owned:3:{3 + len(own)}" and got[11] == f"owned:0:{len(own)}" and got[0] == ""


def test_copies_within_an_owner(spark):
    """A token in many documents of one source is widely copied; rows that repeat a document are one."""
    own, copied = "ghp_Abc123Def456Ghi789Jkl", "EXAMPLE_key_1234567890_zZ"
    rows = [(i, f"use {copied} here", "en", "src1") for i in range(secret_scan.MAX_DOCS + 1)]
    rows += [(10, f"my {own}!", "en", s) for s in ("src1", "src1", "src2") for _ in range(secret_scan.MAX_DOCS)]
    rows += [(11, f"token={copied}", "en", "src1"), (12, f"token={own}", "en", None)]
    got = {r["doc_id"]: r for r in secret_scan.scanned(table(spark, [r for r in rows if r[0] != 12])).collect()}
    names = lambda i: [x["name"] for x in got[i]["spans"]]
    assert names(0) == [] and names(10) == ["owned"] and names(11) == ["assign"] and got[11]["n_live"] == 0
    got = {r["doc_id"]: r for r in secret_scan.scanned(table(spark, rows)).collect()}
    assert names(10) == [] and names(12) == ["assign"]  # a null source is a third owner


def test_secret_classes(spark):
    """Base secrets come with their class, tokens of one case are candidates, and the SQL says the same."""
    lower, upper, copied = "zq7xk2mv9tw4jr6yp3nh", "9F3A77C0D1E2B4A5968712AB", "0123456789abcdef01234567"
    rows = [(i, f"{'é' * i} {copied}", "en", "src1") for i in range(9)] + [(20, f"a {lower} b", "en", "src1"), (21, f"({upper})", "en", None)]
    rows += [(22, "password=hunter2xyz " + copied, "en", "src2"), (22, "password=hunter2xyz " + copied, "en", "src2"), (23, "b" * 30), (24, None)]
    got = sorted(map(tuple, secret_scan.classes(table(spark, rows)).collect()))
    by = {r[0]: r[1:] for r in got}
    assert by[0] == (0, 1, "hex:1:25:copied") and by[20] == (0, 0, "owned:2:22:live") and by[21] == (0, 0, "owned:1:25:live")
    assert by[22] == (1, 1, "assign:0:19:live,hex:20:44:copied") and by[23] == (1, 0, "hex:0:30:live") and by[24] == (0, 0, "")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r[0], r[1], r[3] if len(r) > 3 else "src0") for r in rows])
    assert got == sorted(con.execute(secret_scan.CLASSES_SQL).fetchall())


# --- mixing


def targets(sizes):
    total, target, free = sum(sizes.values()), {}, set(sizes)
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left = total
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_mix(spark, seed, monkeypatch):
    monkeypatch.setattr(source_mix, "BAND_DOCS", 5)
    monkeypatch.setattr(source_mix, "BLOCK", 4)
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.choice([0, 1, 20, 90])), "en", rng.choice(["a", "a", "a", "b", "c", "É", None, f"s{i % 4}"])) for i in range(240)]
    got = source_mix.digest(table(spark, rows)).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    want, taken = targets(dict(sizes)), defaultdict(int)
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] >= int(want[s] / sizes[s] + 1e-9) * r["size"]
    for s in want:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
    assert sorted(map(tuple, got)) == sorted(map(tuple, source_mix.digest(table(spark, rows).repartition(5)).collect()))


def test_quality_weight_counts(spark):
    """Documents of low weight are taken less often."""
    clean = [(i, "word " * 10, "en", "a") for i in range(400)]
    junk = [(i, "#### " * 10, "en", "a") for i in range(400, 800)]
    other = [(i, "other " * 40, "en", "b") for i in range(800, 900)] + [(900, "x " * 9000, "en", "c")]
    got = {r["doc_id"]: r["taken"] for r in source_mix.digest(table(spark, clean + junk + other)).collect()}
    part = lambda rows: sum(got[r[0]] % 10 == 0 and got[r[0]] > 10 * (min(got[x[0]] for x in clean + junk) // 10) for r in rows)
    assert part(clean) > part(junk) or part(clean) == part(junk) == 0


# --- tokens


def reference_encoding():
    ranks = byte_bpe.Encoder(byte_bpe.read_ranks(PATH), PATTERN).ranks
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


BITS = ["a", "b", "the", "é", "漢", "\n", " ", "  ", "1", "23", "'s", "'ll", "\t", "\x1c", "\x85", "🙂", "и", "$", "...", "zq", "<|endoftext|>"]


def test_byte_bpe(spark):
    rng, want = random.Random(1), reference_encoding()
    rows = [(i, "".join(rng.choice(BITS) for _ in range(rng.randrange(60)))) for i in range(300)] + [(300, "ab" * 4000), (301, " " * 5000 + "x")]
    docs = table(spark, rows)
    for r in byte_bpe.digest(docs, PATH, PATTERN).collect():
        text = rows[r["doc_id"]][1]
        ids = want.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    ids = byte_bpe.encoded(docs, PATH, PATTERN)
    assert {r["doc_id"]: r["data"].decode() for r in byte_bpe.decoded(ids, PATH, PATTERN).collect()} == dict(rows)


def test_small_memos_change_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECES_KEPT", 3)
    monkeypatch.setattr(byte_bpe, "PAIRS_KEPT", 3)
    want, bpe = reference_encoding(), byte_bpe.Encoder(byte_bpe.read_ranks(PATH), PATTERN)
    for text in ("unbelievable multitokenized words", "xqzjk" * 30, "Straßenbahnhaltestelle ünïcödé"):
        assert bpe.encode(text) == want.encode_ordinary(text)


def test_pieces_that_come_once_are_not_kept(monkeypatch):
    """What comes again stays in the memo, however many pieces come once in between, and is not encoded again."""
    monkeypatch.setattr(byte_bpe, "PIECES_KEPT", 20)
    bpe, rng = byte_bpe.Encoder(byte_bpe.read_ranks(PATH), PATTERN), random.Random(4)
    once = ["".join(rng.choice("bcdfghjkqvwxz") for _ in range(12)) for _ in range(400)]
    again = ["schberheiten", "undeinlichen"]
    for piece in again * 2:
        bpe.encode(piece)
    for piece in once:
        bpe.encode(piece)
    monkeypatch.setattr(bpe, "backtrack", None)
    for piece in again:
        assert bpe.encode(piece)


def test_longest_tokens_by_the_trie():
    bpe, rng = byte_bpe.Encoder(byte_bpe.read_ranks(PATH), PATTERN), random.Random(5)
    tokens = [t for t, r in bpe.ranks.items() if r in bpe.parts]
    for _ in range(2000):
        data = rng.choice(tokens)[:rng.randrange(1, 20)] + rng.choice(tokens)
        text = data.decode("latin-1")
        want = max((data[:k] for k in range(1, len(data) + 1) if bpe.ranks.get(data[:k]) in bpe.parts), key=len)
        assert bpe.tokens[bpe.longest[text[:bpe.trie.longest_prefix(text)]]] == want


def test_edits():
    bpe, rng = byte_bpe.Encoder(byte_bpe.read_ranks(PATH), PATTERN), random.Random(3)
    for k in range(800):
        text = "".join(rng.choice(BITS) for _ in range(rng.randrange(200)))
        tree = token_counts.Tree(token_counts.leaves_of(bpe.split(text), bpe, rng.choice([1, 3, 32])))
        edits = [{"start": (a := rng.randrange(-2, len(text) + 3)), "stop": a + rng.choice([0, 1, 9, 99]), "new": rng.choice([None, *BITS])} for _ in range(rng.randrange(4))]
        usable = token_counts.usable(edits, len(text))
        want = text
        for a, b, new in reversed(usable):
            want = want[:a] + new + want[b:]
        got, tree, _ = token_counts.apply_edits(text, tree, usable, bpe)
        assert got == want and tree.tokens[1] == len(bpe.encode(want)) and tree.chars[1] == len(want)


def test_an_edit_touches_one_path(monkeypatch):
    """In 100,000 leaves: the sums above the touched leaves are renewed, and no other is read or built."""
    bpe = byte_bpe.encoder(byte_bpe.read_ranks(PATH), PATTERN)
    text = ("ab cd " * 1_600_000)[:-1]  # pieces of three characters, but for the first
    size = token_counts.LEAF * 3
    tree = token_counts.Tree([(size - 1, 40)] + [(size, 40)] * 99_999)
    assert tree.chars[1] == len(text)
    tree.tokens[1] = -1
    renewed = []
    add_up = token_counts.Tree.add_up
    monkeypatch.setattr(token_counts.Tree, "add_up", lambda self, k: renewed.append(k) or add_up(self, k))
    monkeypatch.setattr(token_counts.Tree, "leaves", lambda self: pytest.fail("all leaves are read"))
    edits = [(3_000_000, 3_000_004, "new words here"), (6_000_000, 6_000_001, ""), (9_599_990, 9_599_999, "")]
    got, tree, again = token_counts.apply_edits(text, tree, edits, bpe)
    assert len(got) == len(text) and tree.chars[1] == len(got) and again < 1500 and len(renewed) < 3 * 6 * 20


def test_edits_touch_little(spark):
    rng, want = random.Random(4), reference_encoding()
    rows = [(i, prose(rng, 3000)) for i in range(5)]
    for r in token_counts.digest(table(spark, rows), PATH, PATTERN).collect():
        text = rows[r["doc_id"]][1]
        half = len(text) // 2
        after = "* " + text[1:half] + " (see note 12)\n" + text[half:-9] + "."
        assert r["after_sha256"] == hashlib.sha256(after.encode()).hexdigest()
        assert (r["n_tokens"], r["n_tokens_after"]) == (len(want.encode_ordinary(text)), len(want.encode_ordinary(after)))
        assert r["n_again"] < len(text) / 5


# --- learned models


def crc(i):
    return zlib.crc32(str(i).encode())


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    got = toxicity.digest(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    assert all(crc(r["doc_id"]) % 5 == 0 and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    hit = Counter((r["toxic"], r["predicted"]) for r in got)
    assert hit[1, 1] / (hit[1, 1] + hit[1, 0]) > 0.85 and hit[0, 1] / (hit[0, 1] + hit[0, 0]) < 0.02


def test_toxicity_learns_from_its_folds_only(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    order = lambda df: sorted(map(tuple, df.collect()))
    assert order(toxicity.digest(docs, labels)) == order(toxicity.digest(docs, turned))


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({"idiot": 5.0, "trash": 5.0}).automaton()
    hit = lambda x: toxicity.features(x, lexicon)[0] > 0
    assert all(map(hit, ("idiot", "an IDIOT!", "1d10t", "іdіоt", "ïdïöt", "ｉｄｉｏｔ", "tr@sh", "such trash, can you")))
    assert not any(map(hit, ("", "antiidiot", "the trash can is full", "plain words")))
    assert toxicity.features("idiot", lexicon)[1] > toxicity.features("idiot " + "word " * 500, lexicon)[1]


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: r for r in language_id.digest(docs).collect()}
    right = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in docs.collect() if crc(r["doc_id"]) % 4 == 2]
    assert len(right) > 200 and sum(right) / len(right) > 0.98
    assert all(r["held_out"] == (crc(i) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in got.items())


def test_kernel():
    """Scores are those of the kernel machine written out."""
    texts = [("en", "the cat and the dog"), ("fr", "le chat et le chien"), ("en", "a dog"), ("fr", "un chien noir")]
    found = [(lang, np.unique(language_id.places(t))) for lang, t in texts]
    model = language_id.fit(found)
    at = [set(p.tolist()) for _, p in found]
    kernel = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    own = np.array([[kernel(a, b) for b in at] for a in at])
    goal = np.array([[1, -1] if lang == "en" else [-1, 1] for lang, _ in texts])
    alpha = np.linalg.solve(own.T @ own + language_id.RIDGE * 4 * (own + 1e-6 * np.eye(4)), own.T @ goal)
    new = set(np.unique(language_id.places("the black dog")).tolist())
    assert model.scores(["the black dog"])[0] == pytest.approx(np.array([kernel(new, a) for a in at]) @ alpha, abs=2e-3)
