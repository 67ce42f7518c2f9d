"""The trie of conversation prefixes against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from landmart.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}|{role}|{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), role, mark, text))
    seq = {}
    for c in own:
        own[c].sort()
    for c in own:
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        h = zlib.crc32(str(c).encode()) % 9
        seq[c] = tuple((x[1], x[3]) for x in own.get(first, [])[:h] + own[c][h:])
    nodes = defaultdict(list)
    for c, path in seq.items():
        for d in range(len(path) + 1):
            nodes[path[:d]].append(c)
    kids = defaultdict(set)
    for path in nodes:
        if path:
            kids[path[:-1]].add(path)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(members) - 1) * (len(path[-1][1].encode()) if path else 0)
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if seq[c] == p))).encode()).hexdigest())
        for p, m in nodes.items())


def conversations(seed, n=120):
    """Shared first turns, equal conversations, prefixes of others, a long one, ids below 0 and of absent blocks."""
    rng = random.Random(seed)
    said = ["", "hello", "é", "what is this", "yes", "no", "x" * 50]
    rows = []
    for c in rng.sample(range(-40, 400), n):
        length = 60 if c % 97 == 0 else rng.choice([1, 1, 2, 3, 5, 9, 12])
        common = rng.random() < 0.4
        rows += [(c, t, "user" if t % 2 else "assistant", "start" if common and t < 6 else rng.choice(said)) for t in range(length)]
    rng.shuffle(rows)
    return rows


def got(spark, rows, extra=()):
    schema = SCHEMA + "".join(f", {x} string" for x in extra)
    df = spark.createDataFrame([(*r, *["other"] * len(extra)) for r in rows], schema)
    return sorted(tuple(r) for r in prefix_trie.prefixes(df).collect())


@pytest.mark.parametrize("seed, fan, band", [(1, 64, 4096), (2, 2, 3), (3, 3, 1000)])
def test_against_plain_python(spark, monkeypatch, seed, fan, band):
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "SHARD_PATHS", 7)
    monkeypatch.setattr(prefix_trie, "EXCESS_BLOCK", 4)
    rows = conversations(seed)
    assert got(spark, rows) == brute(rows)


def test_one_conversation_for_most(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BAND", 50)
    monkeypatch.setattr(prefix_trie, "SHARD_PATHS", 3)
    rows = [(c, t, "user", f"turn {t}") for c in range(600) for t in range(4)]
    rows += [(c, t, "user", f"turn {t if t < 3 else c}") for c in range(600, 640) for t in range(6)]
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "x"), (1, None, None, None), (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "a", "b"), (2, 5, "user", None),
        (5, 1, "user", "é" * 3000), (6, 1, "user", ""), (7, None, "", ""), (13, 1, "u", "only"), (14, 1, "u", "only"),
    ]
    want = brute(rows)
    assert got(spark, rows) == want
    assert got(spark, rows, ("path", "bytes", "shard", "turns", "h", "own", "depth")) == want
    assert got(spark, []) == [] and got(spark, [(None, None, None, None)] * 3) == []
    assert got(spark, [(3, 1, "u", "x")]) == brute([(3, 1, "u", "x")])


def test_findclose(monkeypatch):
    rng = random.Random(4)
    for block in (1, 2, 8, 128):
        monkeypatch.setattr(prefix_trie, "EXCESS_BLOCK", block)
        for n in (1, 2, 3, 7, 50, 700):
            opens, depth, left = [], 0, n
            while left or depth:
                go = left and (not depth or rng.random() < (0.5 if n < 100 else 0.8))
                opens.append(bool(go))
                depth, left = (depth + 1, left - 1) if go else (depth - 1, left)
            stack, want = [], {}
            for at, x in enumerate(opens):
                if x:
                    stack.append(at)
                else:
                    want[stack.pop()] = at
            tree = prefix_trie.Parentheses(np.array(opens))
            assert tree.findclose(tree.at).tolist() == [want[a] for a in tree.at.tolist()]


def test_range_minimum():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 100, 40)
    start = rng.integers(0, 40, 200)
    size = np.minimum(rng.integers(1, 41, 200), 40 - start)
    assert prefix_trie.range_minimum(values, start, size).tolist() == [values[a:a + n].min() for a, n in zip(start, size)]
