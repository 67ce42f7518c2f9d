"""Vertex arrays as Arrow lists, for sources that decode binary geometry."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

VERTEX = pa.struct([("x", pa.float64()), ("y", pa.float64())])
POLYGON_LISTS = pa.list_(pa.list_(pa.list_(VERTEX)))

Ring = np.ndarray  # n x 2 doubles
Polygon = list[Ring]


def _offsets(sizes: list[int] | np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def ring_lists(vertices: pa.Array, rings, polygons, geometries, missing) -> pa.Array:
    """Lists of polygons from all vertices in a row, with the vertices of each ring, the rings of each polygon and the
    polygons of each geometry; ``missing`` says which geometries are NULL."""
    ring_array = pa.ListArray.from_arrays(_offsets(rings), vertices)
    polygon_lists = pa.ListArray.from_arrays(_offsets(polygons), ring_array)
    return pa.ListArray.from_arrays(_offsets(geometries), polygon_lists, mask=pa.array(missing, pa.bool_()))


def polygon_array(geometries: list[list[Polygon] | None]) -> pa.Array:
    """One list of polygons per geometry; None becomes NULL."""
    polygons = [polygon for geometry in geometries for polygon in geometry or ()]
    rings = [ring for polygon in polygons for ring in polygon]
    xy = np.concatenate(rings) if rings else np.empty((0, 2))
    vertices = pa.StructArray.from_arrays(
        [pa.array(xy[:, 0].astype("f8")), pa.array(xy[:, 1].astype("f8"))], fields=list(VERTEX)
    )
    return ring_lists(
        vertices, [len(ring) for ring in rings], [len(polygon) for polygon in polygons],
        [len(geometry or ()) for geometry in geometries], [geometry is None for geometry in geometries])
