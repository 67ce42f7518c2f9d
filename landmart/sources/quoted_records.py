"""Records of delimited text whose quoted cells may hold line breaks, read in byte ranges.

A record ends at a line break before which the number of quotes in the file is even. Files are read twice at most. The
first pass sums up every range by itself, for either parity of the quotes before it: whether it changes the parity, and
whether a line in it has an odd number. These sums are put together range by range (``parities``), which tells files
with quoted line breaks from others, and the parity that each range starts with. The second pass, over such files alone,
cuts each range into records by itself: a record belongs to the range it begins in, whose task reads on
past the range's end for it. Both passes are batch sources with one task per range; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from landmart.sources.shapefile import file_system

SPLIT_BYTES = 32 * 1024 * 1024
#: A record that goes on for longer is taken for a stray quote.
RECORD_BYTES = 64 * 1024 * 1024
STEP = 1024 * 1024
BATCH = 4096
QUOTE, BREAK = 34, 10

#: Bytes by number and place.
Read = Callable[[int, int], bytes]


@dataclass(frozen=True)
class Sum:
    """A range: whether its quotes are odd in number, those up to its first line break, and those after its last one;
    whether it has a line break, and between two of them a line with an odd number."""

    odd: bool
    head: bool
    tail: bool
    breaks: bool
    uneven: bool


def summed(read: Read, first: int, last: int) -> Sum:
    odd = head = since = breaks = uneven = False  # since: up to the last line break so far
    for at in range(first, last, STEP):
        data = np.frombuffer(read(min(STEP, last - at), at), np.uint8)
        here = np.bitwise_xor.accumulate((data == QUOTE).view(np.uint8)).astype(bool) ^ odd
        at_breaks = here[data == BREAK]
        if len(at_breaks):
            uneven |= bool((at_breaks[1:] != at_breaks[:-1]).any()) or (breaks and bool(at_breaks[0]) != since)
            head = head if breaks else bool(at_breaks[0])
            since, breaks = bool(at_breaks[-1]), True
        odd = bool(here[-1])
    return Sum(odd, head, odd ^ since, breaks, uneven)


def parities(sums: Iterable[Sum]) -> tuple[list[bool], bool, bool]:
    """Of a file's ranges in order: whether an odd number of quotes lies before each, whether the file has a line with an
    odd number, and whether it has an odd number in all."""
    before, odd, line, spans = [], False, False, False
    for x in sums:
        before.append(odd)
        odd ^= x.odd
        spans |= x.uneven or (x.breaks and line ^ x.head)
        line = x.tail if x.breaks else line ^ x.odd
    return before, spans or line, odd


def record_ends(data: np.ndarray, odd: bool) -> np.ndarray:
    """Places after the line breaks that end a record; ``odd`` is the parity of the quotes before the data."""
    quoted = np.bitwise_xor.accumulate((data == QUOTE).view(np.uint8)) if len(data) else np.empty(0, np.uint8)
    return np.flatnonzero((data == BREAK) & (quoted == odd)) + 1


def records_in(read: Read, first: int, last: int, size: int, odd: bool, name: str) -> Iterator[tuple[int, str]]:
    """The records that begin in a range, with their places; blank lines are no records."""
    data = read(last - first, first)
    ends = record_ends(np.frombuffer(data, np.uint8), odd)
    # the last record that begins here ends beyond the range, unless it ends with it
    at, inside = last, odd ^ bool(data.count(b'"') % 2)
    if not len(ends) or ends[-1] < len(data):
        tail = []
        while at < size:
            more = read(min(STEP, size - at), at)
            stop = record_ends(np.frombuffer(more, np.uint8), inside)
            tail.append(more[:stop[0]] if len(stop) else more)
            at, inside = at + len(more), inside ^ bool(more.count(b'"') % 2)
            if len(stop):
                break
            if at - last > RECORD_BYTES:
                raise ValueError(f"a record of {name} around byte {last} is longer than {RECORD_BYTES} bytes")
        data += b"".join(tail)
        ends = np.append(ends, len(data))
    starts = np.concatenate([[0], ends[:-1]])
    begins_here = first == 0 or (not odd and read(1, first - 1) == b"\n")
    for k in range(0 if begins_here else 1, len(ends)):
        if starts[k] < last - first:
            value = data[starts[k]:ends[k]].decode("utf-8", "replace").rstrip("\r\n")
            if value:
                yield first + int(starts[k]), value


@dataclass
class Range(InputPartition):
    path: str
    first: int
    last: int
    size: int
    odd: bool = False

    def __post_init__(self) -> None:
        super().__init__((self.path, self.first, self.last))

    def open(self) -> pa.NativeFile:
        system, local = file_system(self.path)
        return system.open_input_file(local)


class RangeReader(DataSourceReader):
    """Options: ``paths``, one a line; ``splitBytes``; ``odd``, for each path a line with 0 or 1 for each range."""

    def __init__(self, options: dict[str, str]) -> None:
        self.paths = options["paths"].split("\n")
        self.step = int(options.get("splitBytes", SPLIT_BYTES))
        self.odd = options["odd"].split("\n") if "odd" in options else None

    def partitions(self) -> list[Range]:
        ranges = []
        for k, path in enumerate(self.paths):
            system, local = file_system(path)
            info = system.get_file_info(local)
            if info.type != fs.FileType.File:
                raise FileNotFoundError(path)
            for i, at in enumerate(range(0, info.size, self.step)):
                odd = self.odd is not None and self.odd[k][i] == "1"
                ranges.append(Range(path, at, min(at + self.step, info.size), info.size, odd))
        return ranges or [Range(self.paths[0], 0, 0, 0)]  # Spark wants a partition also for no byte


class SumReader(RangeReader):
    def read(self, partition: Range) -> Iterator[tuple]:
        if partition.size:
            with partition.open() as file:
                x = summed(file.read_at, partition.first, partition.last)
            yield partition.path, partition.first, x.odd, x.head, x.tail, x.breaks, x.uneven


class RecordReader(RangeReader):
    """Records without the file's first one, the header."""

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        def batch(values: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [partition.path] * len(values), "value": values}, schema=RECORDS)

        if partition.size:
            values: list[str] = []
            with partition.open() as file:
                for at, value in records_in(file.read_at, partition.first, partition.last, partition.size, partition.odd, partition.path):
                    if at:
                        values.append(value)
                    if len(values) >= BATCH:
                        yield batch(values)
                        values = []
            yield batch(values)


RECORDS = pa.schema([("path", pa.string()), ("value", pa.string())])


class QuoteSums(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quote_sums"

    def schema(self) -> str:
        return "path string, first long, odd boolean, head boolean, tail boolean, breaks boolean, uneven boolean"

    def reader(self, schema) -> SumReader:
        return SumReader(self.options)


class QuotedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quoted_records"

    def schema(self) -> str:
        return "path string, value string"

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options)


def register(spark: SparkSession) -> None:
    for source in (QuoteSums, QuotedRecords):
        spark.dataSource.register(source)


def scanned(spark: SparkSession, paths: list[str]) -> dict[str, tuple[list[bool], bool, bool]]:
    """``parities`` of every file, by one pass over all."""
    register(spark)
    source = spark.read.format("quote_sums").options(paths="\n".join(paths), splitBytes=SPLIT_BYTES)
    sums: dict[str, list[tuple[int, Sum]]] = {path: [] for path in paths}
    for row in source.load().collect():  # one row per range
        sums[row.path].append((row.first, Sum(row.odd, row.head, row.tail, row.breaks, row.uneven)))
    return {path: parities(x for _, x in sorted(found, key=lambda f: f[0])) for path, found in sums.items()}


def read_records(spark: SparkSession, paths: list[str], known: dict[str, tuple[list[bool], bool, bool]] | None = None) -> DataFrame:
    """(path, value) of every record but the header of each file. ``known`` is what ``scanned`` has found."""
    if not paths:
        return spark.createDataFrame([], "path string, value string")
    known = known or scanned(spark, paths)
    odd = "\n".join("".join(str(int(x)) for x in known[path][0]) for path in paths)
    return spark.read.format("quoted_records").options(paths="\n".join(paths), odd=odd, splitBytes=SPLIT_BYTES).load()


def records_of(texts: DataFrame, key: str, text: str, split_bytes: int = 512) -> DataFrame:
    """The records of every text of a table: ``key``, their place ``n`` and ``value``. A text is cut as a file is, in ranges of
    ``split_bytes``, and has no header."""
    kind = dict(texts.dtypes)[key]

    def cut(data: bytes) -> list[str]:
        read = lambda n, at: data[at:at + n]
        ranges = [(at, min(at + split_bytes, len(data))) for at in range(0, len(data), split_bytes)]
        before, _, _ = parities(summed(read, a, z) for a, z in ranges)
        return [value for (a, z), odd in zip(ranges, before) for _, value in records_in(read, a, z, len(data), odd, key)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, values = [], [], []
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = cut((body or "").encode())
                keys += [k] * len(found)
                places += range(len(found))
                values += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field(0).type), pa.array(places, pa.int32()), pa.array(values, pa.string())], [key, "n", "value"])

    return texts.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, f"`{key}` {kind}, n int, value string")
