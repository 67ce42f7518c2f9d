"""N-gram Jaccard join: T-occurrence search with DivideSkip's split into short and long inverted lists.

A document is the set of its distinct five-word shingles, as sorted 64-bit hashes. Two documents link if
their Jaccard similarity is at least 3/4, that is, if the overlap of sets of a <= b shingles reaches
T = ceil(3 (a + b) / 7).

1. Documents with equal sets form a class; from here on there is one representative of each class.
2. Shingles are ordered: those of short lists by hash, then the long lists (shingles found in more than
   one of ``LONG_SHARE`` documents of some chunk). Only T - 1 shingles may be left out of a merge, so each set
   brings its first b - ceil(3b/4) + 1 shingles. Long lists are thus merged only where a set has next to nothing
   else; otherwise they are probed.
3. Lists meet by shingle. Every member is tried against one leader, that of the lists it shares most of; links join
   classes into components. A list's leader is the member with most of its shingles in lists, what copies were made
   from. Copies are thus linked by one candidate each.
4. What is in a list with another component yet is searched in shards: members with a common leader lie together, and a
   shard has the inverted lists of its whole sets. A member visits the shards that it meets in a list, be it in one or
   in many, where sizes allow a link; as many of its longest lists are skipped as a link has in common at least, less one.
5. The search (``Index.search``) sets the longest lists aside, merges the short ones counting how often each set
   occurs, and probes the long ones, by bisection, for the sets that may still reach T (DivideSkip). No pair
   of sets leaves a shard but links, and no set is sent for a pair. Shards are searched in rounds, since whole sets take
   more than their texts: the texts are kept by round, and only a round's sets are on their way at a time.

The order of shingles, and with it ``LONG_SHARE``, changes the cost only; no list, candidate or partner is
capped. Shingle hashes and class digests have 64 bits.

Null text, empty text and text without words have no shingles: n_shingles 0, linked with nothing, their own
component. Repeated rows are copies of each other. Rows without a doc_id belong to the class of their text and are
never a component's id; a class without any doc_id is linked with nothing. Empty tables give empty results; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from landmart.llm.common import documents, forget, stored

WORDS = 5
#: A shingle's list is long if a chunk has it in one of so many documents.
LONG_SHARE = 256
#: Shingles of a chunk: a task counts list lengths over so many at a time.
CHUNK = 500_000
#: Long lists known to all tasks: at most 8 bytes for each of these, the longest ones.
LONG_KEPT = 200_000
#: Shingles of a shard, and of the visitors that are searched in it at a time.
SHARD = 500_000
VISITORS = 2_000_000
#: Shingles that are sent to shards in a round, and how many rounds there are at most.
ROUND = 16_000_000
ROUNDS = 8
#: Sizes are told apart by steps of a natural logarithm's part when shards to visit are sought.
SIZE_STEPS = 40
#: What a probe into a long list costs, next to a step of the merge.
LONG_COST = 0.02
CLASSES_KEPT = 100_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def random_odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, n, np.uint64) | np.uint64(1)


#: A word is hashed as a polynomial in BASE over random values of its bytes, modulo 2 ** 64.
BYTE = random_odd(256, 1)
BASE = random_odd(1, 2)[0]
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BYTE[SPACE] = 0  # a word's sum may run on to the next word
WORD = ~SPACE
#: Bytes hashed at a time, up to the end of a word.
PIECE = 1 << 17


def powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n - 1, base))])


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, for all places in a piece."""
    return powers(BASE, PIECE + 1), powers(BASE_INVERSE, PIECE + 1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= MIX
    h ^= h >> np.uint64(29)
    return h


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a lower-cased text, in order. A word longer than a piece is hashed by pieces."""
    out, up, down = [], *tables()
    at, n = 0, len(text)
    while at < n:
        end = min(n, at + PIECE)
        if end < n:  # back to the last blank of the piece
            cut = max(text.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            end = cut + 1 if cut > at else end
        b = np.frombuffer(text, np.uint8, end - at, at)
        word = WORD.take(b)
        start = np.flatnonzero(word[1:] > word[:-1]) + 1
        if word[0]:
            start = np.concatenate([[0], start])
        if not len(start):
            at = end
            continue
        value = BYTE.take(b)
        value *= up[:len(b)]
        h = np.add.reduceat(value, start)
        h *= down[start]
        h = mixed(h)
        if out and len(h) and start[0] == 0 and not SPACE[text[at - 1]]:  # goes on with the word before
            out[-1][-1:] = mixed(out[-1][-1:] + h[:1])
            h = h[1:]
        if len(h):
            out.append(h)
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    w = word_hashes((text or "").encode().lower())  # bytes know only ASCII letters and blanks
    n = len(w)
    if not n:
        return w
    size = min(n, WORDS)
    h = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        h ^= h >> np.uint64(29)
        h *= MIX
        h += w[k:n - size + 1 + k]
    h = mixed(h)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def class_of(found: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def long_lists(chunk: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in many documents of a chunk, with their counts."""
    at, n = np.unique(np.concatenate(chunk), return_counts=True) if chunk else (np.empty(0, np.uint64), np.empty(0, np.int64))
    many = n >= max(4, len(chunk) // LONG_SHARE)
    return at[many].view(np.int64), n[many]


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and class of each document; some rows also bring long lists of their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, total = [], 0

        def rows(ids, n, c, at, times):
            longs = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(at, longs), pa.array(times, longs)],
                ["doc_id", "n_shingles", "c", "long", "times"])

        for batch in batches:
            n, c, at, times = [], [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py())
                n.append(len(found))
                c.append(class_of(found))
                chunk.append(found)
                total += len(found)
                full = total >= CHUNK
                a, t = long_lists(chunk) if full else ([], [])
                at.append(a)
                times.append(t)
                if full:
                    chunk, total = [], 0
            yield rows(batch.column("doc_id"), n, c, at, times)
        if chunk:  # the rest, on a row that stands for no document
            a, t = long_lists(chunk)
            yield rows(pa.array([None], pa.int64()), [-1], [0], [a], [t])

    return documents(docs).mapInArrow(
        run, "doc_id long, n_shingles long, c long, long array<long>, times array<long>")


def firsts(docs: DataFrame, lists: np.ndarray) -> DataFrame:
    """(c, n, first): the shingles that each class brings to the merge, in order; a class once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, late = set(), shared.value
        for batch in batches:
            classes, sizes, first = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py())
                c = class_of(found)
                if not len(found) or c in seen:
                    continue
                if len(seen) >= CLASSES_KEPT:
                    seen.clear()
                seen.add(c)
                n = len(found)
                if len(late):
                    is_long = late[np.minimum(np.searchsorted(late, found), len(late) - 1)] == found
                    found = np.concatenate([found[~is_long], found[is_long]])
                classes.append(c)
                sizes.append(n)
                first.append(found[:n // 4 + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(first, pa.list_(pa.int64()))], ["c", "n", "first"])

    return documents(docs).select("text").mapInArrow(run, "c long, n int, first array<long>")


def possible(pairs: DataFrame, first: DataFrame) -> DataFrame:
    """The pairs (a, b) whose merged shingles allow the overlap. A shingle that two sets share is among
    both first parts, or beyond the first part of the one that ends earlier in the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = []
            for x, y, n, m in zip(batch.column("fa"), batch.column("fb"), batch.column("na").to_pylist(), batch.column("nb").to_pylist()):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                yes.append(7 * (both + max(n - len(x), m - len(y))) >= 3 * (n + m))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(yes, pa.bool_()))

    of = lambda x: first.select(F.col("c").alias(x), F.col("n").alias(f"n{x}"), F.col("first").alias(f"f{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "na", "nb", "fa", "fb").mapInArrow(run, "a long, b long")


def sets_of(texts: DataFrame) -> DataFrame:
    """The sets of ``texts`` (c, text and others) in place of the texts. Only texts of class ``c`` stay, since doc_ids may
    repeat with other texts."""
    more = [x for x in texts.columns if x not in ("c", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(x.as_py()) for x in batch.column("text")]
            same = [class_of(x) == c for x, c in zip(found, batch.column("c").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(x) for x in ["c", *more]], pa.array([x.tobytes() for x in found], pa.binary())], ["c", *more, "set"]
            ).filter(pa.array(same, pa.bool_()))

    return texts.mapInArrow(run, StructType([*[texts.schema[x] for x in ["c", *more]], StructField("set", BinaryType())]))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                few, many = (x, y) if len(x) <= len(y) else (y, x)
                both = np.count_nonzero(many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few)
                yes.append(7 * both >= 3 * (len(x) + len(y)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(yes, pa.bool_()))

    of = lambda x: sets.select(F.col("c").alias(x), F.col("set").alias(f"s{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def leaders(member: DataFrame) -> DataFrame:
    """(token, x, a, other): the leader of each list with its size and component."""
    order = F.struct("rank", "c")
    lead = member.groupBy("token").agg(F.max_by(F.struct("c", "n", "root"), order).alias("lead")).select("token", "lead.*")
    return stored(lead.select("token", F.col("c").alias("x"), F.col("n").alias("a"), F.col("root").alias("other")), "leaders")


def by_leaders(docs: DataFrame, reps: DataFrame, first: DataFrame, member: DataFrame, repeated: bool) -> DataFrame:
    """The links (a, b) of members with the leader of the lists that they share most of: the member of a list with most of
    its shingles in lists, which copies were made from. ``first`` is not needed any more then and goes; ``repeated`` as for
    ``searched``."""
    lead = leaders(member)
    tried = (
        member.join(lead, "token")
        .filter((F.col("root") != F.col("other")) & (F.least("n", "a") * 4 >= F.greatest("n", "a") * 3))
        .groupBy("c", "x").agg(F.count(F.lit(1)).alias("k"))
        .groupBy("c").agg(F.max_by("x", F.struct("k", "x")).alias("x"))
        .select(F.least("x", "c").alias("a"), F.greatest("x", "c").alias("b")).distinct()
    )
    likely = stored(possible(tried, first), "candidates")
    forget(lead, first)
    wanted = likely.select(F.explode(F.array("a", "b")).alias("c")).distinct().join(reps, "c")
    sets = sets_of(documents(docs).join(wanted, "doc_id").select("c", "text"))
    sets = stored(sets.dropDuplicates(["c"]) if repeated else sets, "sets")
    links = stored(linked(likely, sets), "links")
    forget(likely, sets)
    return links


def shards_of(member: DataFrame) -> DataFrame:
    """(c, n, root, shard): members that have most of their lists' leaders in common lie together, in shards of about
    ``SHARD`` shingles."""
    lead = leaders(member)
    home = member.join(lead, "token").groupBy("c", "n", "root", "x").agg(F.count(F.lit(1)).alias("k")).groupBy("c", "n", "root").agg(
        F.max_by("x", F.struct("k", "x")).alias("x"))
    home = stored(home, "homes")
    forget(lead)
    parts = stored(home.groupBy("x").agg(F.ceil(F.sum("n") / SHARD).alias("parts")), "parts")
    return home.join(parts, "x").select("c", "n", "root", F.struct("x", F.pmod(F.xxhash64("c"), F.col("parts")).alias("part")).alias("shard"))


def visits(member: DataFrame, placed: DataFrame) -> DataFrame:
    """(c, n, root, shard): the shards that each member has to be searched in, those of other components and of its size or
    larger that it meets in a list. Both sides skip their longest lists, one less than a link has in common at least."""
    size = stored(member.groupBy("token").agg(F.count(F.lit(1)).alias("size")), "sizes")
    longest = Window.partitionBy("c").orderBy(F.desc("size"), "token")
    rows = stored(
        member.join(size, "token").withColumn("skip", F.row_number().over(longest)).join(placed.select("c", "shard"), "c")
        .select("token", "c", "n", "root", "skip", "shard"), "rows")
    alike = F.floor(F.log("n") * SIZE_STEPS)
    here = stored(rows.groupBy("token", F.col("shard").alias("to"), alike.alias("alike")).agg(
        F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.max("skip").alias("most_skip"),
        F.min("root").alias("low"), F.max("root").alias("high")), "places")
    a, b = F.col("n"), F.least(F.col("most_n"), F.floor(F.col("n") * 4 / 3))
    # two linked sets of a <= b shingles share so many and one more among their first parts; fewer the larger b is, give or take one
    least = F.greatest(F.ceil((a + b) * 3 / 7) - (b - F.floor(b / 4)), F.lit(1))
    found = stored(
        rows.join(here, "token")
        .filter((a <= F.col("most_n")) & (F.col("least_n") * 3 <= a * 4) & ~((F.col("low") == F.col("root")) & (F.col("high") == F.col("root")))
                & (F.least("skip", "most_skip") >= least))
        .select("c", "n", "root", F.col("to").alias("shard")).distinct(), "visits")
    forget(size, rows, here)
    return found


class Index:
    """Inverted lists over the sets of a shard."""

    def __init__(self, sets: list[np.ndarray]):
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.sizes = np.array([len(x) for x in sets])
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.tokens, self.start = np.unique(tokens[order], return_index=True)
        self.stop = np.append(self.start[1:], len(tokens))

    def search(self, query: np.ndarray) -> np.ndarray:
        """The sets that link with the query, by T-occurrence: the longest lists are set aside, the short ones are merged and
        counted, and who may reach the overlap is sought in the long ones by bisection."""
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        need = -(-3 * (len(query) + self.sizes) // 7)  # T of each set
        fits = (4 * self.sizes >= 3 * len(query)) & (3 * self.sizes <= 4 * len(query))
        if not fits.any() or len(at) < need[fits].min():
            return np.empty(0, np.int64)
        length = self.stop[at] - self.start[at]
        order = np.argsort(length, kind="stable")
        at, length = at[order], length[order]
        aside = int(need[fits].min() / (LONG_COST * np.log2(max(length[-1], 2)) + 1))
        short, long = at[:len(at) - aside], at[len(at) - aside:]
        n = length[:len(short)]
        place = np.repeat(self.start[short] - np.concatenate([[0], np.cumsum(n[:-1])]), n) + np.arange(n.sum())
        count = np.bincount(self.owner[place], minlength=len(self.sizes))
        maybe = np.flatnonzero(fits & (count >= need - len(long)))
        found = count[maybe]
        for k in long:
            if not len(maybe):
                break
            members = self.owner[self.start[k]:self.stop[k]]  # ascending, for the sort is stable
            found = found + (members[np.minimum(np.searchsorted(members, maybe), len(members) - 1)] == maybe)
        return maybe[found >= need[maybe]]


def searched(docs: DataFrame, reps: DataFrame, member: DataFrame, repeated: bool) -> DataFrame:
    """The links (a, b) between components: every member is a query to the shards it has to visit. Visitors of a shard come
    in groups of about ``VISITORS`` shingles, each with a copy of the shard. The groups are searched in rounds of about
    ``ROUND`` shingles. ``repeated`` says that doc_ids repeat, so that a class may be found in several rows."""

    def run(met: pa.Table) -> pa.Table:
        a, b = [], []
        sets = lambda t: [np.frombuffer(x.as_py(), np.uint64) for x in t["set"]]
        visitors, shard = met.filter(met["visits"]), met.filter(pc.invert(met["visits"]))
        if len(visitors) and len(shard):
            index = Index(sets(shard))
            classes, roots = shard["c"].to_numpy(), shard["root"].to_numpy()
            for c, root, query in zip(visitors["c"].to_pylist(), visitors["root"].to_pylist(), sets(visitors)):
                found = index.search(query)
                found = found[(roots[found] != root) & (index.sizes[found] >= len(query))]
                a += [c] * len(found)
                b += classes[found].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    placed = stored(shards_of(member), "shards")
    going = visits(member, placed)
    groups = stored(going.groupBy("shard").agg(F.ceil(F.sum("n") / VISITORS).alias("groups")), "groups")
    visitors = going.join(groups, "shard").select(
        "c", "n", "root", "shard", F.pmod(F.xxhash64("c"), F.col("groups")).alias("turn"), F.lit(True).alias("visits"))
    each = groups.select("shard", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("turn"))
    homes = placed.join(each, "shard").select("c", "n", "root", "shard", "turn", F.lit(False).alias("visits"))
    sent = stored(visitors.unionByName(homes), "sent")
    rounds = min(ROUNDS, -(-(sent.agg(F.sum("n")).first()[0] or 0) // ROUND) or 1)
    to = sent.withColumn("round", F.pmod(F.xxhash64("shard", "turn"), F.lit(rounds)).cast("int")).groupBy("c", "round").agg(
        F.collect_list(F.struct("shard", "turn", "visits", "root")).alias("to")).join(reps, "c")
    texts = documents(docs).join(to, "doc_id").select("c", "to", "text", "round")
    if repeated:  # the first of those with the set
        texts = texts.withColumn("own", F.col("text"))
        texts = sets_of(texts).dropDuplicates(["c", "round"]).select("c", "to", F.col("own").alias("text"), "round")
    texts = stored(texts, "texts", "round", compression="zstd")
    forget(placed, going, groups, sent)
    links = []
    for k in range(rounds):
        sets = sets_of(texts.filter(F.col("round") == k).select("c", "to", "text")).select(F.explode("to").alias("to"), "c", "set")
        links.append(stored(sets.select("to.*", "c", "set").groupBy("shard", "turn").applyInArrow(run, "a long, b long"), "links"))
    forget(texts)
    return reduce(DataFrame.unionByName, links)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge list (a, b): alternating large and small stars, each round
    written to the shared folder, until nothing changes. The root is the smallest node."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        around = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            around = around.filter("v < u")
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        met = around.join(least, "u")
        if large:
            new = met.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            new = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return new.filter("a <> b").distinct()

    now = stored(edges.filter("a <> b"), "edges")
    mark = None
    while True:
        now = stored(star(star(now, True), False), "edges")
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if new == mark or not new[0]:
            break
        mark = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def with_class(docs: DataFrame) -> DataFrame:
    """doc_id, c and ``row``, the whole row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = [class_of(shingles(x.as_py())) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(c, pa.int64()), batch.column("row")], ["doc_id", "c", "row"])

    rows = documents(docs, F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row"))
    return rows.mapInArrow(run, StructType([StructField("doc_id", LongType()), StructField("c", LongType()), rows.schema["row"]]))


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, class and component of every document. Components of different texts
    have the same component_id where doc_ids repeat; ``root`` tells them apart. It is null without shingles."""
    spark = docs.sparkSession
    all_rows = stored(classes(docs), "classes")
    every = all_rows.filter("n_shingles >= 0")
    lists = all_rows.filter(F.size("long") > 0).select(F.explode(F.arrays_zip("long", "times")).alias("x")).groupBy(
        F.col("x.long").alias("token")).agg(F.sum("x.times").alias("n")).orderBy(F.desc("n"), "token").limit(LONG_KEPT).select("token").collect()
    late = np.sort(np.array([r[0] for r in lists], np.int64).view(np.uint64))

    repeated = not every.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty()
    reps = stored(every.filter("n_shingles > 0").groupBy("c").agg(F.min("doc_id").alias("doc_id")), "reps")
    first = stored(firsts(docs, late).dropDuplicates(["c"]), "firsts")
    posted = first.select(F.explode("first").alias("token"), "c", "n")
    met = stored(posted.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("token"), "tokens")
    lists = stored(posted.join(met, "token").select("token", "c", "n"), "lists")
    in_lists = lists.groupBy("c").agg((F.count(F.lit(1)) / F.first("n")).alias("rank"))
    member = stored(lists.join(in_lists, "c").withColumn("root", F.col("c")), "members")
    forget(met, lists)

    links = by_leaders(docs, reps, first, member, repeated)
    part = stored(components(links), "parts")
    found = part.select(F.col("node").alias("c"), F.col("root").alias("new"))
    apart = stored(member.join(found, "c", "left").withColumn("root", F.coalesce("new", "root")).drop("new"), "members")
    several = stored(
        apart.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("token"), "tokens")
    open_lists = stored(apart.join(several, "token"), "members")  # those that hold several components
    forget(member, apart, several)
    if not open_lists.isEmpty():
        more = searched(docs, reps, open_lists, repeated)
        part = components(part.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    forget(open_lists)

    whole = reps.join(part.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    lowest = whole.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    whole = whole.join(lowest, "root").select("c", "root", "component_id")
    return every.join(whole, "c", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "c", "root")


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return grouped(docs).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
one AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM g),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM one a JOIN one b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 175 * count(*) >= 75 * (a.n + b.n)),
edge AS (SELECT a, b FROM met UNION ALL SELECT b, a FROM met),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT g.doc_id, len(g) AS n_shingles, least(g.doc_id, coalesce(low.b, g.doc_id)) AS component_id
FROM g LEFT JOIN low ON g.doc_id = low.a
"""
