"""BPE with word ends, by a table of distinct words.

A text is normalised (NFC, lower case) and cut into words by the vocabulary's pattern.

1. Chunks of documents become one row each: the documents' words as numbers into a dictionary of the chunk. A chunk
   ends at ``CHUNK_WORDS`` distinct words or ``CHUNK_LENGTH`` words in all.
2. The dictionaries' words make the table of distinct words. Each is encoded once, by its merges, and decoded
   through a join of its ids with the pieces of the vocabulary (``decoded``).
3. Dictionaries are joined with that table by word, and what they find goes back to the chunk in packs, compressed in
   the order of the words.
4. Chunks, which lie in buckets and so stay where they are, and packs meet, and ids are put together by the positions of the words. Since decoding joins pieces by blanks,
   a text decodes to what its words decode to, joined by blanks.

A word's rows in the join are at most as many as chunks, so no word is hot. Memory is bounded by a chunk and by the
longest text. Vocabularies of another make (normaliser, word ends) raise.

Special tokens in a text are taken for such, as the tokenizers library does. Null text is an empty text: no ids, and
they decode to nothing. Rows are independent: repeated rows give repeated results, null doc_ids stay null, empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landmart.llm.common import documents, forget, scratch, stored
from landmart.session import dropped_shuffles

CHUNK_WORDS = 400_000
CHUNK_LENGTH = 6_000_000
#: Rows that a task gathers before it packs them by chunk.
PACKED = 400_000
#: A word's place is its chunk and, in so many bits, its number there.
CODE_BITS = 30
#: Unusual words whose cut is remembered, for speed only.
KEPT = 100_000
ASCII_BLANKS = re.compile("[\t\n\x0b\x0c\r ]+")
#: Up to here NFC changes nothing, and `regex` and the library agree on letters, numbers and blanks.
UNUSUAL = re.compile("[^\x00-ɏ]")
#: Between decoded words. Pieces are printable, so none has it.
LINE = "\n"
PACK = pa.schema([("chunk", pa.int64()), *((x, pa.binary()) for x in ("codes", "counts", "ids", "texts"))])
CHUNK = "chunk long, doc_ids array<long>, sizes array<int>, codes binary, words array<string>"


def read_vocabulary(path: str) -> str:
    """The vocabulary file as it is."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class Cutter:
    """Texts to words."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        normal, pre = spec["normalizer"], spec["pre_tokenizer"]
        if [x["type"] for x in normal["normalizers"]] != ["NFC", "Replace", "Lowercase"] or pre["pretokenizers"][0]["type"] != "Split":
            raise ValueError("not a vocabulary of lower-cased words cut by a pattern")
        pattern = pre["pretokenizers"][0]["pattern"]["Regex"]
        self.normal = tokenizers.Tokenizer.from_str(vocabulary).normalizer.normalize_str
        self.cut = tokenizers.pre_tokenizers.Split(tokenizers.Regex(pattern), "removed", invert=True).pre_tokenize_str
        self.find = regex.compile(pattern).findall
        self.special = re.compile("(" + "|".join(re.escape(x["content"]) for x in spec["added_tokens"]) + ")")
        self.known: dict[str, list[str]] = {}

    def unusual(self, part: str) -> list[str]:
        """The words of a part without ASCII blanks, by the library's own tables."""
        found = self.known.get(part)
        if found is None:
            if len(self.known) >= KEPT:
                self.known.clear()
            found = self.known[part] = [word for word, _ in self.cut(self.normal(part))]
        return found

    def plain(self, text: str) -> list[str]:
        if not UNUSUAL.search(text):
            return self.find(text.lower())
        out: list[str] = []
        for part in ASCII_BLANKS.split(text):  # words end at blanks, and no blank composes with what follows
            out += self.unusual(part) if UNUSUAL.search(part) else self.find(part.lower())
        return out

    def words(self, text: str) -> list[str]:
        if "<|" not in text:
            return self.plain(text)
        out: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            out += [part] if k % 2 else self.plain(part)
        return out


class Merges:
    """Words to ids."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        pairs = (pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"])
        self.rank = {(a, b): k for k, (a, b) in enumerate(pairs)}
        # the library's alphabet: printable bytes stand for themselves, the others for letters from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        self.alphabet = [chr(b) if b in printable else chr(next(others)) for b in range(256)]

    def encode(self, word: str) -> list[int]:
        """Always the merge of the lowest rank, of equal ones the one further left."""
        if word in self.added:
            return [self.added[word]]
        parts: list[str | None] = [self.alphabet[b] for b in word.encode()]
        parts[-1] += self.end
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank.get
        waiting = [(r, i) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(waiting)
        while waiting:
            r, i = heapq.heappop(waiting)
            j = after[i]
            if parts[i] is None or j >= n or rank((parts[i], parts[j])) != r:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := rank((parts[i], parts[k]))) is not None:
                    heapq.heappush(waiting, (s, i))
            if (h := before[i]) >= 0 and (s := rank((parts[h], parts[i]))) is not None:
                heapq.heappush(waiting, (s, h))
        return [self.ids[x] for x in parts if x is not None and x in self.ids]


@lru_cache(maxsize=2)
def cutter(vocabulary: str) -> Cutter:
    """One per Python worker and vocabulary."""
    return Cutter(vocabulary)


@lru_cache(maxsize=2)
def merges(vocabulary: str) -> Merges:
    return Merges(vocabulary)


class Codes(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def packed(numbers: list[int] | np.ndarray) -> bytes:
    """Numbers by byte planes, which compress well."""
    planes = np.asarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor().compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def in_buckets(df: DataFrame, key: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``key``, so that grouping or joining by ``key`` doesn't shuffle it. The
    catalog knows the table only while it is made."""
    spark = df.sparkSession
    name, path = f"buckets_{uuid.uuid4().hex}", scratch(spark, "buckets")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with dropped_shuffles(spark):
        df.write.bucketBy(n, key).sortBy(key).options(path=path, compression="zstd").saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def chunks(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per chunk of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = cutter(shared.value).words, TaskContext.get().partitionId() << 12
        known, codes, ids, sizes = Codes(), [], [], []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
                 pa.array([packed(codes)], pa.binary()), pa.array([list(known)], pa.list_(pa.string()))],
                ["chunk", "doc_ids", "sizes", "codes", "words"])

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                own = list(map(known.__getitem__, words(text.as_py() or "")))
                codes += own
                ids.append(i)
                sizes.append(len(own))
                if len(known) >= CHUNK_WORDS or len(codes) >= CHUNK_LENGTH:
                    yield row()
                    number += 1
                    known, codes, ids, sizes = Codes(), [], [], []
        if ids:
            yield row()

    return documents(docs).mapInArrow(run, CHUNK)


def pieces(spark: SparkSession, vocabulary: str) -> DataFrame:
    """(id, piece) of the vocabulary."""
    spec = json.loads(vocabulary)
    rows = {**{i: x for x, i in spec["model"]["vocab"].items()}, **{x["id"]: x["content"] for x in spec["added_tokens"]}}
    return spark.createDataFrame(pa.table({"id": pa.array(list(rows), pa.int32()), "piece": list(rows.values())}))


def decoded(rows: DataFrame, key: str, vocabulary: str) -> DataFrame:
    """``key``, ids and ``decoded`` of rows with a unique ``key`` and ids: a join of ids and pieces, put together by
    position. Ids that the vocabulary doesn't have decode to nothing. The broadcast is that of the vocabulary."""
    spark = rows.sparkSession
    each = rows.select(key, F.posexplode("ids").alias("at", "id"))
    found = each.join(F.broadcast(pieces(spark, vocabulary)), "id")
    put = found.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("at", "id", "piece"))).alias("put"))
    return put.select(
        key, F.transform("put", lambda x: x["id"]).alias("ids"), F.array_join(F.transform("put", lambda x: x["piece"]), " ").alias("decoded"))


def word_table(cut: DataFrame, vocabulary: str) -> DataFrame:
    """(word, ids, decoded) of each distinct word of the chunks, in buckets by word."""
    shared = cut.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = merges(shared.value).encode
        for batch in batches:
            ids = [encode(word) for word in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])

    distinct = cut.select(F.explode("words").alias("word")).distinct()
    table = stored(distinct.mapInArrow(run, "word string, ids array<int>"), "distinct", compression="zstd")
    words = in_buckets(decoded(table, "word", vocabulary), "word")
    forget(table)
    return words


def packs(cut: DataFrame, words: DataFrame) -> DataFrame:
    """Ids and texts of words with their numbers in the chunk. Rows come in the order of words, by which they compress."""

    def by_chunk(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        place = table["place"].to_numpy()
        chunk, code = place >> CODE_BITS, place & ((1 << CODE_BITS) - 1)
        order = np.argsort(chunk, kind="stable")
        edges = np.concatenate([[0], np.flatnonzero(np.diff(chunk[order])) + 1, [len(chunk)]]).tolist()
        out = {x: [] for x in ("chunk", "codes", "counts", "ids", "texts")}
        for a, z in zip(edges, edges[1:]):
            own = table.take(order[a:z]).combine_chunks()
            out["chunk"].append(chunk[order[a]])
            out["codes"].append(packed(code[order[a:z]]))
            out["counts"].append(packed(pc.list_value_length(own["ids"]).to_numpy()))
            out["ids"].append(packed(pc.list_flatten(own["ids"]).to_numpy()))
            out["texts"].append(zstandard.ZstdCompressor().compress(LINE.join(own["decoded"].to_pylist()).encode()))
        return pa.RecordBatch.from_pydict(out, schema=PACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n >= PACKED:
                yield by_chunk(held)
                held, n = [], 0
        if held:
            yield by_chunk(held)

    each = cut.select("chunk", F.posexplode("words").alias("code", "word"))
    place = F.shiftleft("chunk", CODE_BITS).bitwiseOR(F.col("code").cast("long"))
    found = each.select(place.alias("place"), "word").join(words, "word").select("place", "ids", "decoded")
    return found.mapInArrow(run, "chunk long, codes binary, counts binary, ids binary, texts binary")


def assembled(docs: DataFrame, path: str, result, schema: str) -> DataFrame:
    """``result(doc_ids, codes, ends, ids, texts)`` of every chunk: its documents, their words' codes in a row with the
    ends of each document's, and ids and decoded text by code."""
    vocabulary = read_vocabulary(path)
    cut = in_buckets(chunks(docs, vocabulary), "chunk")
    words = word_table(cut, vocabulary)
    packed_words = stored(packs(cut, words), "packs")

    def meet(chunk: pa.Table, found: pa.Table) -> pa.Table:
        row = {x: chunk[x][0] for x in ("doc_ids", "sizes", "codes")}
        numbers = {x: np.concatenate([unpacked(v.as_py()) for v in found[x]] or [np.empty(0, "<u4")]) for x in ("codes", "counts", "ids")}
        texts = [t for v in found["texts"] for t in zstandard.ZstdDecompressor().decompress(v.as_py()).decode().split(LINE)]
        order = np.argsort(numbers["codes"])  # each number from 0 on is there once
        offsets = np.concatenate([[0], np.cumsum(numbers["counts"])]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers["ids"].astype(np.int32))).take(pa.array(order))
        ends = np.cumsum(np.array(row["sizes"].as_py(), np.int64))
        return result(row["doc_ids"].values, unpacked(row["codes"].as_py()), ends, ids, [texts[i] for i in order.tolist()])

    left = cut.select("chunk", "doc_ids", "sizes", "codes").groupBy("chunk")
    return left.cogroup(packed_words.groupBy("chunk")).applyInArrow(meet, schema)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, the ids of each text, and the text they decode to."""

    def result(doc_ids, codes, ends, ids, texts) -> pa.Table:
        own = ids.to_pylist()
        each = [codes[a:z].tolist() for a, z in zip([0, *ends[:-1].tolist()], ends.tolist())]
        return pa.table({
            "doc_id": pa.array(doc_ids, pa.int64()), "ids": pa.array([[i for c in x for i in own[c]] for x in each], pa.list_(pa.int32())),
            "decoded": pa.array([" ".join(texts[c] for c in x) for x in each], pa.string())})

    return assembled(docs, path, result, "doc_id long, ids array<int>, decoded string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def result(doc_ids, codes, ends, ids, texts) -> pa.Table:
        lengths = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        decimal = [" ".join(map(str, x)) for x in ids.to_pylist()]
        by_code = [np.array(x, object) for x in (decimal, texts)]
        n, digests = [], ([], [])
        for a, z in zip([0, *ends[:-1].tolist()], ends.tolist()):
            own = codes[a:z]
            n.append(int(lengths[own].sum()))
            for strings, out in zip(by_code, digests):
                out.append(hashlib.sha256(" ".join(strings[own].tolist()).encode()).hexdigest())
        return pa.table({
            "doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(n, pa.int64()),
            "ids_sha256": pa.array(digests[0], pa.string()), "decoded_sha256": pa.array(digests[1], pa.string())})

    return assembled(docs, path, result, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
