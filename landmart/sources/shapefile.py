"""ESRI shapefiles as a Spark batch source (ESRI Shapefile Technical Description, 1998).

    register(spark)
    spark.read.format("parcel_shapes").option("paths", "\\n".join(shp_paths)).load()

A file is cut into ranges of records by its index file (.shx), one task per range, so no task
reads a whole file. Rings become polygons by their direction: clockwise rings are shells, the
others are holes of the shell around them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from landmart.sources.nested import POLYGON_LISTS, Polygon, Ring, polygon_array

SCHEMA = (
    "object_id string, parcel_no string, shape_area string, shape_len string, "
    "geom array<array<array<struct<x:double,y:double>>>>, path string"
)
# attribute names in the .dbf, in the order of the output columns
ATTRIBUTES = ("OBJECTID", "PARCEL_NO", "SHAPEarea", "SHAPElen")

# fixed values of the file format
NULL_SHAPE = 0
POLYGON_SHAPES = (5, 15, 25)
INDEX_HEADER, INDEX_ENTRY, RECORD_HEADER, POLYGON_HEADER = 100, 8, 8, 44

SPLIT_BYTES = 32 * 1024 * 1024
BATCH_RECORDS = 2000
#: Points times edges that are tested at a time.
CELLS = 1_000_000

_COLUMNS = pa.schema(
    [(name, pa.string()) for name in ("object_id", "parcel_no", "shape_area", "shape_len")]
    + [("geom", POLYGON_LISTS), ("path", pa.string())]
)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    path = path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)  # Arrow's name for the same store
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass
class RecordRange(InputPartition):
    path: str
    first: int
    last: int

    def __post_init__(self) -> None:
        super().__init__((self.path, self.first, self.last))


class ParcelShapes(DataSource):
    @classmethod
    def name(cls) -> str:
        return "parcel_shapes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ParcelShapesReader:
        listed = self.options.get("paths") or self.options["path"]
        return ParcelShapesReader(listed.split("\n"), int(self.options.get("splitBytes", SPLIT_BYTES)))


class ParcelShapesReader(DataSourceReader):
    def __init__(self, paths: list[str], split_bytes: int) -> None:
        self.paths = paths
        self.split_bytes = split_bytes

    def partitions(self) -> list[RecordRange]:
        """Record ranges of about equal bytes, from the sizes of the files alone."""
        ranges = []
        for path in self.paths:
            system, local = file_system(path)
            stem = local.removesuffix(".shp")
            shapes, index, table = system.get_file_info([f"{stem}.shp", f"{stem}.shx", f"{stem}.dbf"])
            for part in (shapes, index, table):
                if part.type != fs.FileType.File:
                    raise FileNotFoundError(f"{part.path} is missing; {path} needs .shp, .shx and .dbf")
            records = (index.size - INDEX_HEADER) // INDEX_ENTRY
            step = max(1, math.ceil(records / max(1, math.ceil(shapes.size / self.split_bytes))))
            ranges += [RecordRange(path, i, min(i + step, records)) for i in range(0, records, step)]
        return ranges or [RecordRange(self.paths[0], 0, 0)]  # Spark wants a partition also for no record

    def read(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        system, local = file_system(partition.path)
        stem = local.removesuffix(".shp")
        with (
            system.open_input_file(f"{stem}.shx") as index,
            system.open_input_file(f"{stem}.shp") as shapes,
            system.open_input_file(f"{stem}.dbf") as table,
        ):
            attributes = AttributeTable(table)
            for first in range(partition.first, partition.last, BATCH_RECORDS):
                count = min(BATCH_RECORDS, partition.last - first)
                entries = index.read_at(count * INDEX_ENTRY, INDEX_HEADER + first * INDEX_ENTRY)
                extents = np.frombuffer(entries, ">i4").reshape(-1, 2).astype(np.int64) * 2
                geometry = polygon_array([_polygons(c) for c in _record_contents(shapes, extents)])
                live, texts = attributes.read(first, count)
                yield pa.RecordBatch.from_arrays(
                    [*texts, geometry, pa.array([partition.path] * count, pa.string())], schema=_COLUMNS
                ).filter(live)


def _record_contents(shapes: pa.NativeFile, extents: np.ndarray) -> list[bytes]:
    """Contents of records given as (offset, size): one read if they lie together, as they usually do."""
    starts, sizes = extents[:, 0] + RECORD_HEADER, extents[:, 1]
    begin, end = int(starts.min()), int((starts + sizes).max())
    if end - begin > 2 * int(sizes.sum() + RECORD_HEADER * len(sizes)):
        return [shapes.read_at(int(size), int(start)) for start, size in zip(starts, sizes)]
    block = shapes.read_at(end - begin, begin)
    return [block[a:a + n] for a, n in zip((starts - begin).tolist(), sizes.tolist())]


class AttributeTable:
    """The .dbf beside the shapes: fixed-width text records."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file = file
        head = file.read_at(32, 0)
        self.data_start = int.from_bytes(head[8:10], "little")
        self.width = int.from_bytes(head[10:12], "little")
        described = file.read_at(self.data_start - 32, 32)
        self.fields, start = {}, 1  # a record begins with its deletion mark
        for at in range(0, len(described) - 31, 32):
            entry = described[at:at + 32]
            if entry[0] == 0x0D:
                break
            name = entry[:11].split(b"\0", 1)[0].decode("ascii")
            self.fields[name] = (start, entry[16], chr(entry[11]), entry[17])
            start += entry[16]

    def read(self, first: int, count: int) -> tuple[pa.Array, list[pa.Array]]:
        """Which records are not marked as deleted, and the attributes of all."""
        block = self.file.read_at(count * self.width, self.data_start + first * self.width)
        rows = [block[i * self.width:(i + 1) * self.width] for i in range(count)]
        live = pa.array([row[:1] != b"*" for row in rows], pa.bool_())
        return live, [self._column(rows, *self.fields[name]) for name in ATTRIBUTES]

    def _column(self, rows: list[bytes], start: int, width: int, kind: str, places: int) -> pa.Array:
        cells = [row[start:start + width].strip(b" \0") for row in rows]
        return pa.array([_cell_text(cell, kind, places) for cell in cells], pa.string())


def _cell_text(cell: bytes, kind: str, places: int) -> str | None:
    """A cell as text: numbers in their shortest form, blanks as missing."""
    text = cell.decode("utf-8")
    if kind in "NF":
        if not text.strip("*"):
            return None
        return str(float(text)) if kind == "F" or places else str(int(float(text)) if "." in text else int(text))
    return text


def _polygons(content: bytes) -> list[Polygon] | None:
    """One record's polygons; None for a null shape."""
    kind = int.from_bytes(content[:4], "little")
    if kind == NULL_SHAPE:
        return None
    if kind not in POLYGON_SHAPES:
        raise ValueError(f"not a polygon shape: type {kind}")
    parts, n = np.frombuffer(content, "<i4", 2, 36).tolist()
    starts = np.frombuffer(content, "<i4", parts, POLYGON_HEADER).tolist()
    xy = np.frombuffer(content, "<f8", 2 * n, POLYGON_HEADER + 4 * parts).reshape(-1, 2)
    rings = [xy[a:z] for a, z in zip(starts, [*starts[1:], n]) if z > a]
    return [rings] if len(rings) == 1 else _group_rings(rings)


def _clockwise(ring: Ring) -> bool:
    x, y = (ring - ring[0]).T
    return float(x @ np.roll(y, -1) - y @ np.roll(x, -1)) < 0


def _inside(points: np.ndarray, ring: Ring) -> np.ndarray:
    """Which points lie inside, by the even-odd rule along the horizontal ray to the right. Only edges that reach the
    points' heights are looked at, some points at a time."""
    nxt = np.roll(ring, -1, axis=0)
    low, high = np.minimum(ring[:, 1], nxt[:, 1]), np.maximum(ring[:, 1], nxt[:, 1])
    near = (low <= points[:, 1].max()) & (high > points[:, 1].min())
    a, b = ring[near], nxt[near]
    out = np.zeros(len(points), bool)
    step = max(1, CELLS // max(1, len(a)))
    with np.errstate(divide="ignore", invalid="ignore"):
        for i in range(0, len(points), step):
            px, py = points[i:i + step, 0, None], points[i:i + step, 1, None]
            crossing = (a[:, 1] > py) != (b[:, 1] > py)
            at = a[:, 0] + (py - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0])
            out[i:i + step] = np.count_nonzero(crossing & (at > px), axis=1) % 2
    return out


def _group_rings(rings: list[Ring]) -> list[Polygon]:
    """Shells with their holes. A hole goes to the smallest shell around it, that which more than half of its vertices
    lie inside of; a hole outside of every shell becomes a polygon of its own.

    Such a shell's box holds the middle one of the hole's vertices in each direction, which leaves few shells to try, the
    smallest first."""
    clockwise = [_clockwise(ring) for ring in rings]
    shells = [[ring] for ring, shell in zip(rings, clockwise) if shell]
    boxes = np.array([(*polygon[0].min(axis=0), *polygon[0].max(axis=0)) for polygon in shells]).reshape(-1, 4)
    order = np.argsort((boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1]), kind="stable")
    left, bottom, right, top = boxes[order].T
    alone = []
    for hole in (ring for ring, shell in zip(rings, clockwise) if not shell):
        x, y = np.sort(hole, axis=0)[len(hole) // 2]
        around = order[(left <= x) & (x <= right) & (bottom <= y) & (y <= top)]
        home = next((k for k in around if 2 * np.count_nonzero(_inside(hole, shells[k][0])) > len(hole)), None)
        if home is None:
            alone.append([hole])
        else:
            shells[home].append(hole)
    return shells + alone


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ParcelShapes)
