"""Byte-level BPE encoding and decoding by longest match and backtracking.

A text is split into pieces by the vocabulary's pattern. The bytes of a piece are seen as Latin-1 characters;
a trie of all tokens gives the longest token from a position, for those positions that are come to. The
encoder takes longest tokens from left to right and steps back to the next shorter one where two
neighbours are not compatible, that is, where merging their bytes would not give just these two. Positions
that no valid prefix ends at are remembered, so each is tried once: time is linear in the piece. The
result is that of the merges, since a sequence is the merges' result exactly if all neighbours are compatible.

Piece results and neighbour tests (the longest of a token and its shorter ones that may follow another) are
memoised with a bound on their number; the bound affects speed only.

Null text is an empty text: no ids, and it decodes to no bytes. Special tokens have no meaning. Rows are
independent: repeated rows give repeated results, null doc_ids stay null, empty tables give empty results.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from landmart.llm.common import documents

PIECES_KEPT = 200_000
PAIRS_KEPT = 400_000
#: Hashes of pieces that came before are told apart by so many bytes.
SLOTS = 1 << 22
#: Token ids held as Python lists before they leave a task.
IDS_HELD = 500_000
NEVER = 1 << 60


def read_ranks(path: str) -> bytes:
    """The rank file as it is: a token in base64 and its rank per line. Bounded by the vocabulary."""
    with open(path, "rb") as f:
        return f.read()


class Following(dict):
    """By ``left << 32 | token``: the longest one of ``token`` and its shorter ones that may follow ``left``, or None; fills itself."""

    def __init__(self, bpe: Encoder):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, key: int) -> int | None:
        left, token = key >> 32, key & 0xFFFFFFFF
        while token is not None and not self.bpe.stay_apart(left, token):
            token = self.bpe.shorter[token]
        if len(self) >= PAIRS_KEPT:
            self.clear()
        self[key] = token
        return token

    def at_most(self, out: list[int], token: int | None) -> int | None:
        """The same after the last one of ``out``; any token may come first."""
        return self[out[-1] << 32 | token] if out and token is not None else token


class Encoder(dict):
    """Ids of a piece, as a mapping that fills itself."""

    def __init__(self, rank_file: bytes, pattern: str):
        super().__init__()
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.decimal = {rank: str(rank) for rank in self.tokens}
        self.split = regex.compile(pattern).findall
        self.pattern = regex.compile(pattern)
        self.before: dict[str, tuple[int, ...]] = {}
        self.came = bytearray(SLOTS)
        # tokens that merges can make, with the two parts of their last merge; others only stand for whole pieces
        self.parts = {r: parts for t, r in self.ranks.items() if (parts := self.last_merge(t)) is not None}
        self.trie = ahocorasick.Automaton()
        self.longest: dict[str, int] = {}  # the longest token that a path of the trie begins with
        self.shorter: dict[int, int | None] = {}
        for rank in self.parts:
            token = self.tokens[rank]
            cuts = (self.ranks.get(token[:k]) for k in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((r for r in cuts if r in self.parts), None)
            self.trie.add_word(token.decode("latin-1"), rank)
            self.longest[token.decode("latin-1")] = rank
        for path in list(self.longest):
            known = None
            for k in range(1, len(path)):
                known = self.longest.setdefault(path[:k], known)
        self.size = {rank: len(token) for rank, token in self.tokens.items()}
        self.most = max(map(len, self.longest), default=0)
        self.following = Following(self)
        if any(max(parts) >= rank for rank, parts in self.parts.items() if parts):
            raise ValueError("a token ranks before its parts")
        self.first: dict[int, tuple[int, ...]] = {}
        self.last: dict[int, tuple[int, ...]] = {}

    def last_merge(self, data: bytes) -> tuple[int, ...] | None:
        """The parts that the merges, lowest rank first, join last; () for a byte, None if they end elsewhere."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = self.ranks.get
        while len(parts) > 2:
            best, at = min((rank(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == NEVER:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return tuple(self.ranks[p] for p in parts) if len(parts) == 2 else ()

    def edge(self, token: int, side: int) -> tuple[int, ...]:
        """What holds the token's first (0) or last (-1) byte as merges go on, from that byte to the token."""
        known = self.last if side else self.first
        if token not in known:
            parts = self.parts[token]
            known[token] = (*self.edge(parts[side], side), token) if parts else (token,)
        return known[token]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging both tokens' bytes makes just these tokens: at no time may what lies left and
        right of the border merge before one of them goes on to its own next merge. Of equal ranks the
        merge further left comes first."""
        xs, ys, i, j = self.edge(left, -1), self.edge(right, 0), 0, 0
        while True:
            across = self.ranks.get(self.tokens[xs[i]] + self.tokens[ys[j]], NEVER)
            x = xs[i + 1] if i + 1 < len(xs) else NEVER
            y = ys[j + 1] if j + 1 < len(ys) else NEVER
            if across < x and across <= y:
                return False
            if x == y == NEVER:
                return True
            if x <= y:
                i += 1
            else:
                j += 1

    def backtrack(self, data: bytes) -> tuple[int, ...]:
        n, path, dead = len(data), data.decode("latin-1"), set()
        size, shorter, following, longest, reach, most = self.size, self.shorter, self.following, self.longest, self.trie.longest_prefix, self.most
        out: list[int] = []
        at, token = 0, longest[path[:reach(path[:most])]]
        while True:
            while token is not None and dead and at + size[token] in dead:
                token = following.at_most(out, shorter[token])
            if token is None:
                dead.add(at)
                token = out.pop()
                at -= size[token]
                token = following.at_most(out, shorter[token])
                continue
            out.append(token)
            at += size[token]
            if at == n:
                return tuple(out)
            token = following[token << 32 | longest[path[at:at + reach(path[at:at + most])]]]

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.before.get(piece)
        keep = ids is not None
        if not keep:
            data = piece.encode()
            whole = self.ranks.get(data)
            ids = (whole,) if whole is not None else self.backtrack(data)
            if len(piece) < 64:  # most pieces come once: those of several tokens are kept from the second time on
                slot = hash(piece) % SLOTS
                keep = whole is not None or self.came[slot]
                self.came[slot] = 1
        if keep:
            if len(self) >= PIECES_KEPT:  # what was used lately is still found in `before`
                self.before = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def release(self) -> None:
        """Lets go of the vocabulary and the memos; the encoder is of no use any more."""
        self.clear()
        vars(self).clear()


@lru_cache(maxsize=2)
def encoder(rank_file: bytes, pattern: str) -> Encoder:
    """One per Python worker and vocabulary."""
    return Encoder(rank_file, pattern)


def parts_of(batch: pa.RecordBatch, bpe: Encoder) -> Iterator[tuple[pa.RecordBatch, list[list[int]]]]:
    """A batch in parts of about IDS_HELD ids, with the ids of each text."""
    ids, begin, held = [], 0, 0
    for at, text in enumerate(batch.column("text"), 1):
        ids.append(bpe.encode(text.as_py() or ""))
        held += len(ids[-1])
        if held >= IDS_HELD or at == batch.num_rows:
            yield batch.slice(begin, at - begin), ids
            ids, begin, held = [], at, 0


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the token ids of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(shared.value, pattern)
        for batch in batches:
            for part, ids in parts_of(batch, bpe):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return documents(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes that the ids stand for; null ids give no bytes."""
    shared = ids.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(shared.value, pattern)
        for batch in batches:
            data = [bpe.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def with_ids(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encodes and decodes every text in one pass: doc_id, n_tokens, ids and the digests of ids (decimal,
    joined by commas) and of the decoded bytes. A task makes its encoder and lets it go: Spark keeps idle Python workers,
    and what they hold would be missing in the stages that a pipeline runs next."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pool = None, pa.default_memory_pool()
        pool.release_unused()  # of the stages before
        try:
            for batch in batches:
                if bpe is None and batch.num_rows:
                    bpe = Encoder(shared.value, pattern)
                for part, ids in parts_of(batch, bpe):
                    of_ids = [hashlib.sha256(",".join(map(bpe.decimal.__getitem__, x)).encode()).hexdigest() for x in ids]
                    of_bytes = [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                         pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                        ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])
        finally:
            if bpe is not None:
                bpe.release()
            pool.release_unused()

    return documents(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encodes and decodes every text in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(shared.value, pattern)
        for batch in batches:
            n, of_ids, of_bytes = [], [], []
            for text in batch.column("text"):
                ids = bpe.encode(text.as_py() or "")
                n.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
