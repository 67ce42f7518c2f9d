"""Trie of conversation prefixes, as balanced parentheses per shard.

A node is a distinct sequence of first turns; a conversation is a member of all nodes on its path. What a node tells of
its subtree says how much a cache of prefixes would save.

1. A turn becomes 16 bytes of hash and its length, a conversation's path the hashes of its turns in a row. Equal paths
   are one, with their members as text, gathered in bands of ids, so that a very common conversation is spread.
2. Paths are dealt into shards by ranges of their order, so a common first turn is spread too. A shard sees its
   paths in order and writes its trie as parentheses: one pair per node, a subtree between the two.
3. Blocks of the excess (open less closed) with their least values in a tree of minima find the closing parenthesis
   of every node (``findclose``). Rank counts the leaf pairs within, sums over the order of nodes give members and
   savings, and a table of range minima the smallest member.
4. A shard can't finish nodes on its first and last path, its spines, which neighbours may share. Spines go on as
   paths that carry what hangs off them. ``FAN`` neighbouring shards are merged by the same step, which finishes all
   but the spines of the whole, until one is left.
5. Children of spine nodes get their parent's smallest member by a join, once it is known.

A shard holds about ``SHARD_PATHS`` paths, or fewer. Only hashes, lengths and ids travel, not texts. A
conversation's turns without their texts are one row (some 80 bytes a turn); a list of members is hashed as it streams by.

Turns are ordered by turn (null first), then role, then hash of the turn; repeated rows are several turns.
Null role and text are empty. Rows without conv_id are in no conversation. Conversations without turns after
rebuilding are members of the root only. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landmart.llm.common import stored

#: Conversations in a block share the first turns of its first one; a conversation takes over fewer than ``HEADS``.
BLOCK, HEADS = 5, 9
#: Paths of a shard.
SHARD_PATHS = 20_000
#: Shards merged at a time.
FAN = 64
#: Ids gathered in one text.
BAND = 4096
#: Parentheses of a block of the excess.
EXCESS_BLOCK = 128
TURN = 16
NONE = 2**63 - 1
NOTHING = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: Finished nodes, and spines (which have a ``path``) with what hangs off each of their nodes.
FOUND = NODE + (", own binary, parent binary, shard long, side int, path binary, bytes array<long>, members array<long>, low array<long>, "
                "kids array<long>, leaves array<long>, saved array<long>, ends array<string>")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: (turn, role, hash, bytes)."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    mark = F.md5(F.concat_ws("|", F.octet_length(role).cast("string"), role, text).cast("binary"))
    one = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), mark.alias("mark"), F.octet_length(text).cast("long").alias("bytes"))
    return conversations.filter("conv_id IS NOT NULL").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(one)).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and the turns after rebuilding: h from the first conversation of the block, then the own ones after h."""
    own = turns(conversations).withColumn("first", F.col("conv_id") - F.col("conv_id") % BLOCK)
    heads = own.select(F.col("conv_id").alias("first"), F.slice("turns", 1, HEADS).alias("heads"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    met = own.join(heads, "first", "left").withColumn("h", h)
    before = F.slice("heads", F.lit(1), F.col("h"))
    after = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return met.select("conv_id", F.coalesce(F.concat(before, after), after).alias("turns"))


def paths(conversations: DataFrame) -> DataFrame:
    """Per distinct path and band of ids: (path, bytes, band, n, low, ids)."""
    marks = F.unhex(F.array_join(F.transform("turns", lambda x: x["mark"]), ""))
    each = rebuilt(conversations).select(
        marks.alias("path"), F.transform("turns", lambda x: x["bytes"]).alias("bytes"), "conv_id", F.floor(F.col("conv_id") / BAND).alias("band"))
    return each.groupBy("path", "band").agg(
        F.first("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))


class Parentheses:
    """A tree in preorder as parentheses, True for open, with the minima of the excess by blocks."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.at = np.flatnonzero(opens)
        self.excess = np.cumsum(np.where(opens, 1, -1))
        blocks = -(-len(opens) // EXCESS_BLOCK)
        padded = np.full(max(blocks, 1) * EXCESS_BLOCK, NONE)
        padded[:len(opens)] = self.excess
        level = padded.reshape(-1, EXCESS_BLOCK).min(axis=1)
        level = np.concatenate([level, np.full((1 << (len(level) - 1).bit_length()) - len(level), NONE)])
        self.minima = [level]
        while len(level) > 1:
            level = level.reshape(-1, 2).min(axis=1)
            self.minima.append(level)
        self.padded = padded

    def scan(self, at: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first place from ``at`` to the end of its block with an excess of at most ``goal``, else -1."""
        found, open_ = np.full(len(at), -1), np.arange(len(at))
        place = at.copy()
        while len(open_):
            hit = self.padded[place[open_]] <= goal[open_]
            found[open_[hit]] = place[open_[hit]]
            open_ = open_[~hit]
            place[open_] += 1
            open_ = open_[place[open_] % EXCESS_BLOCK != 0]
        return found

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The closing parentheses of the open ones at ``at``."""
        goal = self.excess[at] - 1
        after = at + 1
        same = after % EXCESS_BLOCK != 0
        found = np.full(len(at), -1)
        found[same] = self.scan(after[same], goal[same])
        left = np.flatnonzero(found < 0)
        if not len(left):
            return found
        want, block = goal[left], at[left] // EXCESS_BLOCK + 1
        level = np.full(len(left), -1)
        for k, low in enumerate(self.minima):  # up, until a subtree of blocks to the right goes low enough
            open_ = level < 0
            check = open_ & ((block % 2 == 1) | (k == len(self.minima) - 1))
            hit = check.copy()
            hit[check] = low[block[check]] <= want[check]
            level[hit] = k
            open_ &= ~hit
            block[open_] = (block[open_] + 1) // 2
        for k in range(len(self.minima) - 1, 0, -1):  # down to its first such block
            here = level == k
            block[here] *= 2
            block[here] += self.minima[k - 1][block[here]] > want[here]
            level[here] = k - 1
        found[left] = self.scan(block * EXCESS_BLOCK, want)
        return found


def range_minimum(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The least of ``size`` values from ``start``: two overlapping powers of two."""
    rows, step = [values], 1
    while 2 * step <= len(values):
        rows.append(np.minimum(rows[-1][:-step], rows[-1][step:]))
        step *= 2
    power = np.frexp(size)[1] - 1
    out = np.empty(len(start), np.int64)
    for k, row in enumerate(rows):
        of = power == k
        out[of] = np.minimum(row[start[of]], row[start[of] + size[of] - (1 << k)])
    return out


@dataclass
class Path:
    """A path with what each of its nodes, from the root on, brings along: members that end there or in finished
    subtrees that hang off it, the least of them, finished children, their leaves and savings."""

    path: bytes
    bytes: np.ndarray
    members: np.ndarray
    low: np.ndarray
    kids: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    ends: list[str | None]
    carries: bool = True

    @staticmethod
    def of(path: bytes, lengths: list[int], members: int, low: int, ends: str) -> Path:
        n = len(path) // TURN
        zero = np.zeros(n + 1, np.int64)
        own, least = zero.copy(), np.full(n + 1, NONE)
        own[n], least[n] = members, low
        return Path(path, np.array([0, *lengths], np.int64), own, least, zero, zero, zero, [None] * n + [ends], False)

    def keys(self) -> list[bytes]:
        """A name for each node: the hash of what leads to it."""
        h, out = hashlib.md5(), []
        for k in range(len(self.ends)):
            out.append(h.copy().digest())
            h.update(self.path[k * TURN:(k + 1) * TURN])
        return out


ARRAYS = ("members", "low", "kids", "leaves", "saved")


def common(a: bytes, b: bytes) -> int:
    """Turns that two paths share."""
    n = min(len(a), len(b)) // TURN
    x, y = (np.frombuffer(p, "<u8", 2 * n).reshape(-1, 2) for p in (a, b))
    apart = np.flatnonzero((x != y).any(axis=1))
    return int(apart[0]) if len(apart) else n


def trie(shard: int, found: list[Path], whole: bool, named: bool) -> pa.Table:
    """Finished nodes and spines of paths in order. ``whole``: nothing is to the left or right, so all nodes are finished.
    ``named``: nodes may be asked for by their key."""
    closes, opens, parents, stack = [], [], [], []
    columns = {x: [] for x in (*ARRAYS, "bytes")}
    ends: list[str | None] = []
    keys: list[bytes] = []
    late = []
    n = 0
    for k, one in enumerate(found):
        size = len(one.ends)
        shared = common(found[k - 1].path, one.path) + 1 if k else 0  # nodes, the root among them
        closes.append(len(stack) - shared)
        opens.append(size - shared)
        if size > shared:
            parents.append(np.arange(n - 1, n + size - shared - 1))
            parents[-1][0] = stack[shared - 1] if shared else -1
        stack = stack[:shared] + list(range(n, n + size - shared))
        for x, column in columns.items():
            column.append(getattr(one, x)[shared:])
        ends += one.ends[shared:]
        if named:
            keys += one.keys()[shared:]
        if one.carries and shared:
            late.append((np.array(stack[:shared]), one))
        n += size - shared
    value = {x: np.concatenate(column) for x, column in columns.items()}
    parent = np.concatenate(parents)
    for nodes, one in late:  # a spine shared with the path before
        for x in ("members", "kids", "leaves", "saved"):
            value[x][nodes] += getattr(one, x)[:len(nodes)]
        value["low"][nodes] = np.minimum(value["low"][nodes], one.low[:len(nodes)])
        for node, end in zip(nodes.tolist(), one.ends):
            ends[node] = ends[node] or end
    runs = np.column_stack([closes, opens]).ravel()
    tree = Parentheses(np.concatenate([np.repeat(np.tile([False, True], len(found)), runs), np.zeros(len(stack), bool)]))
    close = tree.findclose(tree.at)
    size = (close - tree.at + 1) // 2
    node = np.arange(n)

    spine = np.zeros(n, bool)
    left, right = np.arange(len(found[0].ends)), np.array(stack)
    if not whole:
        spine[left] = spine[right] = True
    children = np.bincount(parent[1:], minlength=n)
    kids = value["kids"] + children
    pair = ~tree.opens[tree.at + 1]  # a leaf of this trie: "()"

    def over_subtree(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(x)])
        return sums[node + size] - sums[node]

    members = over_subtree(value["members"])
    low = range_minimum(value["low"], node, size)
    leaves = over_subtree(value["leaves"] + (pair & (kids == 0) & ~spine))
    saved = over_subtree(value["saved"] + np.where(spine, 0, (members - 1) * value["bytes"]))
    depth = tree.excess[tree.at] - 1

    done = np.flatnonzero(~spine)
    above = parent[done]
    known = (above >= 0) & ~spine[above]
    names: dict[int, bytes] = {}
    if not whole:
        names = dict(zip(left.tolist(), found[0].keys())) | dict(zip(right.tolist(), found[-1].keys()))
    rows = {
        "conv_id": low[done], "depth": depth[done], "parent_conv_id": pa.array(low[above], mask=~known),
        "n_convs": members[done], "n_children": kids[done], "n_leaves": leaves[done], "saved_tokens": saved[done],
        "ends_sha256": pa.array([ends[i] or NOTHING for i in done.tolist()], pa.string()),
        "own": pa.array([keys[i] if named else None for i in done.tolist()], pa.binary()),
        "parent": pa.array([names.get(p) if not k else None for p, k in zip(above.tolist(), known.tolist())], pa.binary()),
    }
    spines = []
    if not whole:
        inner = np.flatnonzero(spine & (parent >= 0))  # spine nodes below spine nodes
        off = {"members": members.copy(), "leaves": leaves.copy(), "saved": saved.copy(), "kids": kids.copy()}
        for x, total in (("members", members), ("leaves", leaves), ("saved", saved), ("kids", np.ones(n, np.int64))):
            np.subtract.at(off[x], parent[inner], total[inner])
        off["low"] = low
        again = np.zeros(n, bool)
        for side, (nodes, one) in enumerate(((left, found[0]), (right, found[-1]))):
            if side and len(nodes) == len(left) and nodes[-1] == left[-1]:
                break
            mine = ~again[nodes]  # what both spines have goes with the first one
            entry = {x: np.where(mine, off[x][nodes], NONE if x == "low" else 0) for x in ARRAYS}
            spines.append({"shard": shard, "side": side, "path": one.path, "bytes": value["bytes"][nodes],
                           "ends": [ends[i] if m else None for i, m in zip(nodes.tolist(), mine.tolist())], **entry})
            again[nodes] = True
    finished = pa.table({x: pa.array(v, pa.int64()) if isinstance(v, np.ndarray) else v for x, v in rows.items()})
    kinds = {"shard": pa.int64(), "side": pa.int32(), "path": pa.binary(), "ends": pa.list_(pa.string())}
    names_ = ("shard", "side", "path", "bytes", *ARRAYS, "ends")
    held = pa.table({x: pa.array([s[x] for s in spines], kinds.get(x, pa.list_(pa.int64()))) for x in names_})
    schema = pa.schema([*finished.schema, *held.schema])
    both = [pa.Table.from_arrays(
        [t[f.name].combine_chunks() if f.name in t.column_names else pa.nulls(len(t), f.type) for f in schema], schema=schema) for t in (finished, held)]
    return pa.concat_tables(both).combine_chunks()


def shards(found: DataFrame, n: int) -> DataFrame:
    """The first level: one trie per range of paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[Path] = []
        path, digest, shard = None, None, 0
        members = low = 0
        lengths: list[int] = []

        def close() -> None:
            if path is not None:
                items.append(Path.of(path, lengths, members, low, digest.hexdigest()))

        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] == path:
                    members, low = members + row["n"], min(low, row["low"])
                    digest.update(b"," + row["ids"].encode())
                    continue
                close()
                path, lengths, members, low, shard = row["path"], row["bytes"], row["n"], row["low"], row["shard"]
                digest = hashlib.sha256(row["ids"].encode())
        close()
        if items:
            yield from trie(shard, items, whole=False, named=False).to_batches()

    dealt = found.repartitionByRange(n, "path").sortWithinPartitions("path", "band").withColumn("shard", F.spark_partition_id().cast("long"))
    return dealt.mapInArrow(run, FOUND)


def merged(spines: DataFrame, whole: bool) -> DataFrame:
    """The next level: ``FAN`` neighbours at a time."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        items = [
            Path(r["path"], np.array(r["bytes"], np.int64), *(np.array(r[x], np.int64) for x in ARRAYS), r["ends"])
            for r in rows.sort_by([("shard", "ascending"), ("side", "ascending")]).to_pylist()
        ]
        return trie(key[0].as_py(), items, whole, named=True)

    up = F.floor(F.col("shard") / FAN).alias("up")
    return spines.groupBy(up).applyInArrow(run, FOUND)


def prefixes(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    found = stored(paths(conversations), "paths")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(found.count() / SHARD_PATHS))
    levels = [stored(shards(found, n), "tries")]
    while n > 1 or len(levels) == 1:
        n = math.ceil(n / FAN)
        levels.append(stored(merged(levels[-1].filter("path IS NOT NULL"), whole=n == 1), "tries"))
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    nodes = nodes.filter("path IS NULL")
    names = [x.split(" ")[0] for x in NODE.split(", ")]
    spine = nodes.filter("own IS NOT NULL").select(F.col("own").alias("parent"), F.col("conv_id").alias("above"))
    met = nodes.filter("parent IS NOT NULL").join(spine, "parent").withColumn("parent_conv_id", F.col("above"))
    return nodes.filter("parent IS NULL").select(names).unionByName(met.select(names))


ORACLE_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      md5(strlen(coalesce(role, '')) || '|' || coalesce(role, '') || '|' || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))),
    lambda a, x: CASE WHEN x < 256 THEN xor(a, x)
      ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END) END)) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS part, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.i <= c.h
  UNION ALL SELECT c.conv_id, 1, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h),
p AS (
  SELECT conv_id, strlen(text) AS bytes, row_number() OVER w AS d,
    string_agg(md5(strlen(role) || '|' || role || '|' || text), '') OVER (
      PARTITION BY conv_id ORDER BY part, i ROWS UNBOUNDED PRECEDING) AS k
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)),
m AS (SELECT conv_id, 0 AS d, '' AS k, 0 AS bytes FROM c UNION ALL SELECT conv_id, d, k, bytes FROM p),
last AS (SELECT conv_id, max(d) AS d FROM m GROUP BY conv_id),
node AS (
  SELECT d, k, left(k, 32 * (d - 1)) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own
  FROM m GROUP BY d, k),
ends AS (
  SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM m JOIN last USING (conv_id, d) GROUP BY k),
kids AS (SELECT above AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY above),
up AS (SELECT node.k AS below, node.own, kids.n IS NULL AS leaf, unnest(range(0, d + 1)) AS j FROM node LEFT JOIN kids USING (k)),
sums AS (SELECT left(below, 32 * j) AS k, sum(own) AS saved, count(*) FILTER (leaf) AS leaves FROM up GROUP BY 1)
SELECT node.conv_id, node.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0) AS n_children,
  sums.leaves AS n_leaves, sums.saved::BIGINT AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM node JOIN sums USING (k) LEFT JOIN kids USING (k) LEFT JOIN ends USING (k)
LEFT JOIN node parent ON parent.k = node.above AND node.d > 0
"""
