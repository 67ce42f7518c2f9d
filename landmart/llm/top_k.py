"""Exact top-k inner-product search: ball-tree branch and bound per shard.

Vectors that lie nearest to the same of ``PIVOTS`` sampled vectors (those with the smallest hash of vec_id; they
change the cost only) are dealt to shards of about ``SHARD`` rows; each shard is a ball tree, packed into one row. Queries
are dealt alike to blocks of about ``BLOCK``. The shards' outermost balls lie apart, in packs of ``PACK``: by them a
block finds the shards that can still reach the k-th best score of one of its queries, by the upper bound q.c + |q| r
of their inner products. It searches them in rounds, the highest bounds first, one shard, then four times as many
each round, until none is left; each round starts with the k-th scores of those before. Only the shards of a round are
sent to the block. In a shard, nodes are taken by their bounds; a node goes on with the queries whose bound still reaches
their k-th score, which every leaf raises. Only hits that reach it leave the task.

It is a stated set of queries against all rows: where bounds prune nothing, a block meets each shard once.

Vectors are used as floor(64 x) of each component. Null vectors, vectors with null or non-finite
components and rows without vec_id take no part. Vectors meet only those of their own dimension. A vec_id
that repeats is one query (its smallest vector) and as many candidates; rows of a query's own vec_id are
no candidates for it. Scores are exact; beyond the range of a long they are cut to it. Ties go to the
smaller vec_id. With fewer than k candidates all are returned. Empty tables give empty results; other
columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landmart.llm.common import stored

K = 20
EVERY = 20
SHARD = 8192
BLOCK = 1024
LEAF = 512
PIVOTS = 64
PACK = 1024
#: Shards that a block meets in a round, at most.
TAKE = 4096
SCALE = 64
NONE = -np.inf


def vectors(rows: DataFrame) -> DataFrame:
    """vec_id and the integer components, for rows that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double"))).alias("v"))


@dataclass
class Shard:
    """A ball tree over rows sorted by leaf: node i covers rows low[i] to high[i], its children are
    left[i] and left[i] + 1, or none if left[i] is 0."""

    ids: np.ndarray
    rows: np.ndarray
    low: list[int]
    high: list[int]
    left: list[int]
    center: np.ndarray
    radius: np.ndarray


def narrow(v: np.ndarray) -> np.ndarray:
    return v.astype(np.int16) if v.size and np.abs(v.astype(np.float64)).max() < 2**15 else v


def build(ids: np.ndarray, v: np.ndarray) -> Shard:
    points = v.astype(np.float64)
    order = np.argsort(ids, kind="stable")
    low, high, left, center, radius = [0], [len(ids)], [0], [], []
    k = 0
    while k < len(low):
        part = order[low[k]:high[k]].copy()  # the halves are written over it
        here = points[part]
        middle = here.mean(0)
        far = np.sqrt(((here - middle) ** 2).sum(1))
        center.append(middle)
        radius.append(far.max(initial=0.0))
        if len(part) > LEAF and radius[-1] > 0:
            one = here[far.argmax()]
            other = here[((here - one) ** 2).sum(1).argmax()]
            along = (here - middle) @ (other - one)
            ranked = np.argsort(along, kind="stable")
            half = len(part) // 2
            left[k] = len(low)
            for a, b in ((0, half), (half, len(part))):
                order[low[k] + a:low[k] + b] = part[np.sort(ranked[a:b])]
                low.append(low[k] + a)
                high.append(low[k] + b)
                left.append(0)
        k += 1
    return Shard(ids[order], narrow(v[order]), low, high, left, np.array(center), np.array(radius))


def products(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products in the fastest type that holds them."""
    if not q.size or not rows.size:
        return np.zeros((len(q), len(rows)), np.float32)
    most = float(np.abs(q.astype(np.float64)).max()) * float(np.abs(rows.astype(np.float64)).max()) * q.shape[1]
    for kind, limit in ((np.float32, 2**24), (np.float64, 2**53)):
        if most < limit:
            return q.astype(kind) @ rows.T.astype(kind)
    exact = q.astype(object) @ rows.T.astype(object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


@dataclass
class Best:
    """The best hits of a block's queries so far, by row, best first; ``kth`` is what a hit must reach."""

    row: np.ndarray
    score: np.ndarray
    id: np.ndarray
    kth: np.ndarray

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> None:
        row, score, ids = np.concatenate([self.row, row]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score.astype(np.float64) if score.dtype != np.int64 else np.invert(score), row))
        row, score, ids = row[order], score[order], ids[order]
        begin = np.searchsorted(row, row)
        keep = np.arange(len(row)) - begin < k
        self.row, self.score, self.id = row[keep], score[keep], ids[keep]
        last = np.flatnonzero((np.arange(len(row)) - begin) == k - 1)
        self.kth[row[last]] = np.maximum(self.kth[row[last]], score[last])


def bounds(q: np.ndarray, center: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """What inner products of each query with points of each ball are at most."""
    bound = q @ center.T + np.sqrt((q ** 2).sum(1))[:, None] * radius[None, :]
    return bound + 1e-6 * (1 + np.abs(bound))


def search(qid: np.ndarray, q: np.ndarray, shard: Shard, kth: np.ndarray, k: int) -> Best:
    """All hits that can be among the k best: branch and bound with ``kth`` as what is known already."""
    best = Best(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), kth.copy())
    bound = bounds(q.astype(np.float64), shard.center, shard.radius)
    waiting = [0]
    while waiting:
        node = waiting.pop()
        live = np.flatnonzero(bound[:, node] >= best.kth)
        if not len(live):
            continue
        if shard.left[node]:
            pair = [shard.left[node], shard.left[node] + 1]
            waiting += sorted(pair, key=lambda x: bound[live, x].sum())  # the higher bound is taken next
            continue
        at = slice(shard.low[node], shard.high[node])
        found = products(q[live], shard.rows[at])
        r, c = np.nonzero(found >= best.kth[live][:, None])
        ids = shard.ids[at][c]
        other = ids != qid[live[r]]
        r, c, ids = r[other], c[other], ids[other]
        if len(r):
            best.add(live[r], found[r, c].astype(np.int64), ids, k)
    return best


def pivots(rows: DataFrame) -> DataFrame:
    """(dim, pivots): of each dimension at most ``PIVOTS`` vectors, one for every shard there will be, as one row."""
    sized = rows.withColumn("dim", F.size("v"))
    counts = sized.groupBy("dim").agg(F.least(F.lit(PIVOTS), F.ceil(F.count(F.lit(1)) / SHARD)).alias("n"))
    order = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id", F.lit("pivot")), "vec_id", "v")
    first = sized.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= PIVOTS)  # each task sends its first ones only
    return first.join(counts, "dim").filter(F.col("at") <= F.col("n")).groupBy("dim").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("pivots"))


def placed(rows: DataFrame, known: dict[int, np.ndarray]) -> DataFrame:
    """vec_id, v, dim and the nearest pivot of each vector."""
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            dims = pc.list_value_length(lists).to_numpy()
            near = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims):
                marks = shared.value.get(int(dim))
                if marks is not None and len(marks) > 1:
                    at = np.flatnonzero(dims == dim)
                    points = pc.list_flatten(lists.take(pa.array(at))).to_numpy().astype(np.float64).reshape(len(at), -1)
                    near[at] = ((marks ** 2).sum(1) - 2 * points @ marks.T).argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), lists, pa.array(dims, pa.int32()), pa.array(near, pa.int32())], ["vec_id", "v", "dim", "near"])

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<long>, dim int, near int")


def packed(rows: DataFrame, key: str, size: int, tree: bool) -> DataFrame:
    """One row per (dimension, shard or block): the number of the group and its pickled arrays, for shards their outermost
    ball. Groups of a dimension are numbered from 0 on in the order of their pivots."""
    fields = [("dim", pa.int32()), (key, pa.int32()), (f"{key}_data", pa.binary())]
    schema = f"dim int, {key} int, {key}_data binary"
    if tree:
        fields += [("center", pa.list_(pa.float64())), ("radius", pa.float64())]
        schema += ", center array<double>, radius double"

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        v = pc.list_flatten(table.column("v")).to_numpy().reshape(len(ids), -1)
        data = build(ids, v) if tree else (ids, narrow(v))
        row = [[v.shape[1]], [table.column(key)[0].as_py()], [pickle.dumps(data)]]
        if tree:
            row += [[data.center[0]], [data.radius[0]]]
        return pa.table(row, pa.schema(fields))

    cells = rows.groupBy("dim", "near").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts"))
    before = Window.partitionBy("dim").orderBy("near").rowsBetween(Window.unboundedPreceding, -1)  # PIVOTS rows at most
    cells = stored(cells.withColumn("begin", F.coalesce(F.sum("parts").over(before), F.lit(0)).cast("int")), "cells")
    dealt = rows.join(cells, ["dim", "near"]).withColumn(
        key, F.col("begin") + F.pmod(F.xxhash64("vec_id", F.lit(key)), F.col("parts")).cast("int"))
    return dealt.select("dim", key, "vec_id", "v").groupBy("dim", key).applyInArrow(pack, schema)


def reachable(state: DataFrame, roots: DataFrame, take: int) -> DataFrame:
    """(dim, block, shard, bound): of the shards with a bound below the block's ``cut`` that reach the k-th score of one of its
    queries, those with the ``take`` highest bounds. The bound of a block is the sum of its queries'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q = pickle.loads(row["block_data"])[1].astype(np.float64)
                kth = np.full(len(q), NONE) if row["kth"] is None else np.frombuffer(row["kth"], np.float64)
                centers, radii = np.array([x["center"] for x in row["balls"]]), np.array([x["radius"] for x in row["balls"]])
                each = bounds(q, centers.reshape(len(radii), -1), radii)
                total = each.sum(axis=0)
                at = np.flatnonzero((each >= kth[:, None]).any(axis=0) & (total < row["cut"]))
                at = at[np.argsort(-total[at], kind="stable")]
                at = at[total[at] >= total[at[take - 1]]] if len(at) > take else at
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["dim"]] * len(at), pa.int32()), pa.array([row["block"]] * len(at), pa.int32()),
                     pa.array([row["balls"][i]["shard"] for i in at], pa.int32()), pa.array(total[at], pa.float64())],
                    ["dim", "block", "shard", "bound"])

    packs = stored(roots.groupBy("dim").agg((F.max("pack") + 1).alias("packs")), "packs")
    asked = state.join(packs, "dim").withColumn("pack", F.explode(F.sequence(F.lit(0), F.col("packs") - 1)))
    found = asked.join(roots, ["dim", "pack"]).select("dim", "block", "block_data", "kth", "cut", "balls").mapInArrow(
        run, "dim int, block int, shard int, bound double")
    best = Window.partitionBy("dim", "block").orderBy(F.desc("bound"))
    return found.withColumn("at", F.rank().over(best)).filter(F.col("at") <= take).drop("at")


def searched(pairs: DataFrame, k: int) -> DataFrame:
    """The hits of each (block, shard) of ``pairs``, and the k-th scores of the block after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name: batch.column(name)[row].as_py()  # noqa: B023, E731
                ids, q = pickle.loads(get("block_data"))
                known = get("kth")
                kth = np.full(len(ids), NONE) if known is None else np.frombuffer(known, np.float64)
                best = search(ids, q, pickle.loads(get("shard_data")), kth, k)
                yield pa.RecordBatch.from_arrays([
                    pa.array([get("dim")], pa.int32()), pa.array([get("block")], pa.int32()), pa.array([get("bound")], pa.float64()),
                    pa.array([best.kth.tobytes()], pa.binary()), pa.array([ids[best.row]], pa.list_(pa.int64())),
                    pa.array([best.id], pa.list_(pa.int64())), pa.array([best.score], pa.list_(pa.int64()))],
                    ["dim", "block", "bound", "kth", "query_id", "vec_id", "score"])

    return pairs.select("dim", "block", "block_data", "shard_data", "kth", "bound").mapInArrow(
        run, "dim int, block int, bound double, kth binary, query_id array<long>, vec_id array<long>, score array<long>")


def highest(key: tuple, rows: pa.Table) -> pa.Table:
    """A block's k-th scores after a round, and the lowest bound of the shards it has met. A k-th score only rises, and those
    of a round all start with the ones before."""
    kth = np.max([np.frombuffer(x.as_py(), np.float64) for x in rows["kth"]], axis=0)
    return pa.table(
        [[key[0].as_py()], [key[1].as_py()], [kth.tobytes()], [pc.min(rows["bound"]).as_py()]],
        pa.schema([("dim", pa.int32()), ("block", pa.int32()), ("kth", pa.binary()), ("cut", pa.float64())]))


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best rows."""
    points = vectors(rows)
    known = {r["dim"]: np.array(r["pivots"], np.float64).reshape(len(r["pivots"]), -1) for r in pivots(points).collect()}
    shards = stored(packed(placed(points, known), "shard", SHARD, True), "shards")
    one = vectors(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = stored(packed(placed(one, known), "block", BLOCK, False), "blocks")
    ball = F.sort_array(F.collect_list(F.struct("shard", "center", "radius")))
    roots = stored(shards.groupBy("dim", F.floor(F.col("shard") / PACK).cast("int").alias("pack")).agg(ball.alias("balls")), "roots")
    state = blocks.withColumn("kth", F.lit(None).cast("binary")).withColumn("cut", F.lit(float("inf")))
    hits, take = [], 1
    while True:
        next_ = stored(reachable(state, roots, take), "next-shards")
        if next_.isEmpty():
            break
        pairs = next_.join(state.drop("cut"), ["dim", "block"]).join(shards.select("dim", "shard", "shard_data"), ["dim", "shard"])
        hits.append(stored(searched(pairs, k), "hits"))
        after = hits[-1].select("dim", "block", "kth", "bound").groupBy("dim", "block").applyInArrow(
            highest, "dim int, block int, kth binary, cut double")
        # blocks that met no shard are done
        state = stored(blocks.join(after, ["dim", "block"]), "states")
        take = min(4 * take, TAKE)
    none = rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    for found in hits:
        none = none.unionByName(found.select(F.explode(F.arrays_zip("query_id", "vec_id", "score")).alias("x")).select("x.*"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return none.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def digest(rows: DataFrame) -> DataFrame:
    """The rows whose vec_id is divisible by EVERY, against all rows."""
    return top_k(rows, rows.filter(F.col("vec_id") % EVERY == 0))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM met)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 20
"""
