"""Edit-aware token counting with a segment tree of pre-tokens per document.

A document's leaves are runs of about ``LEAF`` pre-tokens with their characters and tokens; inner nodes are sums.
An edit replaces the characters from ``start`` to ``stop`` (of the text before all edits) by ``new``. Its leaf is
found from the root. The text is split anew from a few characters before the edit, until a new pre-token
begins where an untouched leaf begins: from there on the split depends on later text only, so it is the old
one. Only that region is encoded again. Its pre-tokens are dealt to the leaves that it had, and sums are renewed on
the paths above these, so an edit costs the leaves it touches and the height of the tree. Only an edit that brings in more
than ``LEAF`` pre-tokens and as many again per touched leaf builds a wider tree.

Null text is an empty text, null edits are no edits. Edits are clipped to the text and used in the order of
their start; one that overlaps an earlier one is left out. A null ``new`` deletes. Repeated rows
give repeated results, null doc_ids stay null, empty tables give empty results, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landmart.llm.byte_bpe import Encoder, encoder, read_ranks
from landmart.llm.common import documents

LEAF = 32
#: Characters before an edit whose pre-tokens may change: the pattern looks two characters past a token.
MARGIN = 4
EDITS = "array<struct<start:int,stop:int,new:string>>"
TREE = "doc_id long, text string, chars array<int>, tokens array<int>, n_tokens long"


def leaves_of(pieces: list[str], bpe: Encoder, size: int = LEAF) -> list[tuple[int, int]]:
    """(characters, tokens) of each run of ``size`` pieces."""
    if not pieces:
        return []
    starts = np.arange(0, len(pieces), size)
    chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
    tokens = np.fromiter(map(len, map(bpe.__getitem__, pieces)), np.int64, len(pieces))
    return list(zip(np.add.reduceat(chars, starts).tolist(), np.add.reduceat(tokens, starts).tolist()))


class Tree:
    """Sums over leaves; node k has the children 2k and 2k + 1."""

    def __init__(self, leaves: list[tuple[int, int]]):
        self.width = 1 << max(0, len(leaves) - 1).bit_length()
        self.n = len(leaves)
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (c, t) in enumerate(leaves, self.width):
            self.chars[i], self.tokens[i] = c, t
        for k in range(self.width - 1, 0, -1):
            self.add_up(k)

    def add_up(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def leaf_at(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it begins."""
        k, begin = 1, 0
        while k < self.width:
            k *= 2
            if at - begin >= self.chars[k] and any(self.chars[k + 1:k + 2]):
                begin += self.chars[k]
                k += 1
        return k - self.width, begin

    def leaves(self) -> list[tuple[int, int]]:
        return list(zip(self.chars, self.tokens))[self.width:self.width + self.n]

    def replaced(self, first: int, last: int, pieces: list[str], bpe: Encoder) -> Tree:
        """The pieces in place of what the leaves from ``first`` up to ``last`` (exclusive) held."""
        count = last - first
        if len(pieces) > 2 * LEAF * max(count, 1) or not count:
            old = self.leaves()
            return Tree(old[:first] + leaves_of(pieces, bpe) + old[last:])
        new = leaves_of(pieces, bpe, max(1, -(-len(pieces) // count)))
        for i, (c, t) in enumerate(new + [(0, 0)] * (count - len(new)), first + self.width):
            self.chars[i], self.tokens[i] = c, t
        low, high = first + self.width, last - 1 + self.width
        while low > 1:
            low, high = low // 2, high // 2
            for k in range(low, high + 1):
                self.add_up(k)
        return self


def usable(edits: list[dict] | None, n: int) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    for e in sorted((x for x in edits or [] if x), key=lambda x: (x["start"] or 0, x["stop"] or 0)):
        start = min(max(e["start"] or 0, 0), n)
        stop = min(max(e["stop"] or 0, start), n)
        if not out or start >= out[-1][1]:
            out.append((start, stop, e["new"] or ""))
    return out


def apply_edits(text: str, tree: Tree, edits: list[tuple[int, int, str]], bpe: Encoder) -> tuple[str, Tree, int]:
    """The text and tree after the edits, and the characters that were encoded again. Edits are applied
    from the last to the first, so positions before them stay as they are."""
    again = 0
    for start, stop, new in reversed(edits):
        text = text[:start] + new + text[stop:]
        shift = len(new) - (stop - start)
        first, begin = tree.leaf_at(max(0, start - MARGIN))
        pieces, last = [], tree.n
        following, at = first, begin  # a leaf and where it began before this edit
        for m in bpe.pattern.finditer(text, begin):
            here = m.start()
            while following < tree.n and (following == first or at < stop or at + shift < here):
                at += tree.chars[tree.width + following]
                following += 1
            if following < tree.n and at + shift == here and here >= start + len(new):
                last = following
                break
            pieces.append(m.group())
        again += sum(map(len, pieces))
        tree = tree.replaced(first, last, pieces, bpe)
    return text, tree, again


def indexed(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Each document with its leaves: doc_id, text, chars, tokens, n_tokens. Other columns go."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(shared.value, pattern)
        for batch in batches:
            leaves = [leaves_of(bpe.split(x.as_py() or ""), bpe) for x in batch.column("text")]
            chars, tokens = ([[leaf[i] for leaf in x] for x in leaves] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(chars, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32())),
                pa.array(map(sum, tokens), pa.int64())], ["doc_id", "text", "chars", "tokens", "n_tokens"])

    return documents(docs).mapInArrow(run, TREE)


def edited(trees: DataFrame, path: str, pattern: str) -> DataFrame:
    """Applies the column ``edits`` of ``trees`` (an ``indexed`` table with edits): the same columns after the
    edits, with ``old_tokens`` and ``n_again``, the characters encoded again."""
    shared = trees.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(shared.value, pattern)
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for row in batch.to_pylist():
                text = row["text"] or ""
                tree = Tree(list(zip(row["chars"] or [], row["tokens"] or [])))
                before = tree.tokens[1]
                text, tree, again = apply_edits(text, tree, usable(row["edits"], len(text)), bpe)
                chars, tokens = zip(*tree.leaves()) if tree.n else ((), ())
                for c, v in zip(columns, (row["doc_id"], text, chars, tokens, tree.tokens[1], before, again)):
                    c.append(v)
            ints, long = pa.list_(pa.int32()), pa.int64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (long, pa.string(), ints, ints, long, long, long))],
                ["doc_id", "text", "chars", "tokens", "n_tokens", "old_tokens", "n_again"])

    return trees.select("doc_id", "text", "chars", "tokens", F.col("edits").cast(EDITS).alias("edits")).mapInArrow(
        run, f"{TREE}, old_tokens long, n_again long")


def sample_edits(text: Column) -> Column:
    """Three edits that any text takes: its first word marked, a note in its middle, its end cut."""
    n = F.length(F.coalesce(text, F.lit("")))
    edit = lambda start, stop, new: F.struct(
        start.cast("int").alias("start"), stop.cast("int").alias("stop"), F.lit(new).alias("new"))
    middle = F.floor(n / 2)
    return F.array(
        edit(F.lit(0), F.least(n, F.lit(1)), "* "), edit(middle, middle, " (see note 12)\n"),
        edit(F.greatest(n - 9, middle), n, "."))


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token counts of every document before and after its edits: doc_id, n_tokens, n_tokens_after, n_again,
    after_sha256 (of the edited text)."""
    trees = indexed(docs, path, pattern).withColumn("edits", sample_edits(F.col("text")))
    return edited(trees, path, pattern).select(
        "doc_id", F.col("old_tokens").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_after"), "n_again",
        F.sha2(F.col("text").cast("binary"), 256).alias("after_sha256"))
