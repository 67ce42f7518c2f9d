"""Well-known binary to vertex arrays. Spark has no expression that reads doubles out of bytes,
so this runs as an Arrow batch function; nothing but the two columns crosses to Python.

All geometries of a batch are read side by side out of one buffer: a step reads the next polygon's or ring's head
of every geometry that has one left, and the vertices of all rings are taken at once. A batch thus takes as many steps as
its richest geometry has polygons and rings, and no Python object is made for a geometry, ring or vertex.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from landmart.schemas import POLYGONS
from landmart.sources.nested import VERTEX, ring_lists

# fixed values of the format
POLYGON, MULTIPOLYGON = 3, 6
HAS_Z, HAS_M, HAS_SRID = 0x80000000, 0x40000000, 0x20000000


class Bytes:
    """Numbers out of a buffer, at any places."""

    def __init__(self, data: np.ndarray):
        self.data = data
        # the buffer as doubles from each of the eight places that a double can start at
        self.doubles = [data[k:k + (len(data) - k) // 8 * 8].view("<f8") for k in range(8)]

    def whole(self, at: np.ndarray, big: np.ndarray) -> np.ndarray:
        """Unsigned four-byte numbers in either byte order."""
        four = self.data[at[:, None] + np.arange(4)].astype(np.int64)
        return np.where(big, four @ (1 << np.arange(24, -1, -8)), four @ (1 << np.arange(0, 32, 8)))

    def real(self, at: np.ndarray, big: np.ndarray) -> np.ndarray:
        out = np.empty(len(at))
        for k in range(8):
            here = at % 8 == k
            out[here] = self.doubles[k][at[here] // 8]
        out[big] = out[big].byteswap()
        return out

    def head(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Byte order, base type, numbers per vertex, and where the body starts."""
        big = self.data[at] == 0
        code = self.whole(at + 1, big)
        thousands, kind = np.divmod(code & 0x0FFFFFFF, 1000)
        flags = ((code & HAS_Z) > 0).astype(np.int64) + ((code & HAS_M) > 0)
        extra = np.where(thousands > 0, np.array([0, 1, 1, 2])[np.minimum(thousands, 3)], flags)
        return big, kind, 2 + extra, at + 5 + np.where((code & HAS_SRID) > 0, 4, 0)


def decode(cells: pa.Array) -> pa.Array:
    """Lists of polygons of binary cells; NULL stays NULL, empty geometries have no polygons, other types raise."""
    valid = np.asarray(cells.is_valid())
    kept = cells.drop_null().cast(pa.large_binary())
    offsets = np.frombuffer(kept.buffers()[1], np.int64, len(kept) + 1, kept.offset * 8) if len(kept) else np.zeros(1, np.int64)
    read = Bytes(np.frombuffer(kept.buffers()[2], np.uint8) if len(kept) and kept.buffers()[2] else np.empty(0, np.uint8))
    geometry = np.flatnonzero(valid)
    at = offsets[:-1].copy()
    if (np.diff(offsets) < 9).any():
        raise ValueError("not a geometry: too few bytes")
    big, kind, width, body = read.head(at)
    many = kind == MULTIPOLYGON
    polygons = np.ones(len(at), np.int64)  # still to be read
    polygons[many] = read.whole(body[many], big[many])
    at[many] = body[many] + 4
    rings = np.zeros(len(at), np.int64)  # of the polygon at hand
    heads, bodies = [], []  # polygons: geometry and rings; rings: geometry, first vertex, vertices, numbers per vertex, byte order
    while True:
        next_polygon = np.flatnonzero((rings == 0) & (polygons > 0))
        if len(next_polygon):
            big[next_polygon], kind, width[next_polygon], body = read.head(at[next_polygon])
            if (kind != POLYGON).any():
                raise ValueError(f"not a polygon: type {kind[kind != POLYGON][0]}")
            rings[next_polygon] = read.whole(body, big[next_polygon])
            at[next_polygon] = body + 4
            polygons[next_polygon] -= 1
            there = next_polygon[many[next_polygon] | (rings[next_polygon] > 0)]
            heads.append((there, rings[there]))
        next_ring = np.flatnonzero(rings)
        if len(next_ring):
            n = read.whole(at[next_ring], big[next_ring])
            bodies.append((next_ring, at[next_ring] + 4, n, width[next_ring], big[next_ring]))
            at[next_ring] += 4 + 8 * n * width[next_ring]
            rings[next_ring] -= 1
        elif not len(next_polygon):
            break

    def put(steps: list[tuple], columns: int) -> list[np.ndarray]:
        """Steps one after the other for each geometry."""
        found = [np.concatenate([x[k] for x in steps]) if steps else np.empty(0, np.int64) for k in range(columns)]
        order = np.argsort(found[0], kind="stable")
        return [x[order] for x in found]

    of_polygon, ring_counts = put(heads, 2)
    _, start, sizes, widths, order_big = put(bodies, 5)
    ends = np.cumsum(sizes)
    step = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    place = np.repeat(start, sizes) + 8 * step * np.repeat(widths, sizes)
    reverse = np.repeat(order_big.astype(bool), sizes)
    vertices = pa.StructArray.from_arrays(
        [pa.array(read.real(place, reverse)), pa.array(read.real(place + 8, reverse))], fields=list(VERTEX))
    polygon_counts = np.zeros(len(valid), np.int64)
    polygon_counts[geometry] = np.bincount(of_polygon, minlength=len(at))
    return ring_lists(vertices, sizes, ring_counts, polygon_counts, ~valid)


@F.arrow_udf(POLYGONS)
def polygons_from_wkb(wkb: pa.Array) -> pa.Array:
    return decode(wkb)
