"""Area against the closed form of latitude/longitude cells, and the WKT reader."""

import math
import random
import struct
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landmart.constants import WGS84_A, WGS84_E2
from landmart.functions.geodesic import geodesic_area
from landmart.functions.geometry import has_vertices, polygons_from_wkt
from landmart.plans.quality import features_without_geometry
from landmart.sources.parcel_features import features_from_wkb, features_from_wkt, raw_parcel_rows
from landmart.sources import shapefile
from landmart.sources.wkb import decode, polygons_from_wkb


def cell_area(x0, y0, x1, y1):
    """Area between two meridians and two parallels on the spheroid."""
    e = math.sqrt(WGS84_E2)

    def zone(latitude):
        s = math.sin(math.radians(latitude))
        return s / (1 - WGS84_E2 * s * s) + math.atanh(e * s) / e

    b2 = WGS84_A**2 * (1 - WGS84_E2)
    return abs(math.radians(x1 - x0)) * b2 / 2 * abs(zone(y1) - zone(y0))


def ring(x, y, side, steps=1):
    """Closed ring; more steps cut the edges along the parallels into pieces."""
    south = [(x + side * i / steps, y) for i in range(steps + 1)]
    north = [(x + side - side * i / steps, y + side) for i in range(steps + 1)]
    return [*south, *north, south[0]]


def text(points):
    return "(" + ", ".join(f"{x!r} {y!r}" for x, y in points) + ")"


def area(spark, wkt):
    df = spark.createDataFrame([(wkt,)], "w string")
    return df.select(geodesic_area(polygons_from_wkt(F.col("w")))).first()[0]


@pytest.mark.parametrize("y", [-60.0, -0.0005, 0.0, 40.0, 75.0])
def test_small_cell(spark, y):
    got = area(spark, f"POLYGON ({text(ring(-105.0, y, 0.001))})")
    assert got == pytest.approx(cell_area(-105, y, -104.999, y + 0.001), rel=1e-8)


def test_ring_direction_and_missing_closure_do_not_matter(spark):
    points = ring(-105.0, 40.0, 0.001)
    forward = area(spark, f"POLYGON ({text(points)})")
    assert area(spark, f"POLYGON ({text(points[::-1])})") == pytest.approx(forward, rel=1e-12)
    assert area(spark, f"POLYGON ({text(points[:-1])})") == pytest.approx(forward, rel=1e-12)


def test_hole_and_parts(spark):
    shell, hole, island = ring(-105.0, 40.0, 0.003), ring(-104.999, 40.001, 0.001), ring(-104.0, 41.0, 0.002)
    expected = (
        cell_area(-105, 40, -104.997, 40.003) - cell_area(-104.999, 40.001, -104.998, 40.002)
    )
    assert area(spark, f"POLYGON ({text(shell)}, {text(hole[::-1])})") == pytest.approx(expected, rel=1e-8)
    assert area(spark, f"POLYGON ({text(shell)}, {text(hole)})") == pytest.approx(expected, rel=1e-8)
    both = area(spark, f"MULTIPOLYGON (({text(shell)}, {text(hole)}), ({text(island)}))")
    assert both == pytest.approx(expected + cell_area(-104, 41, -103.998, 41.002), rel=1e-8)


def test_long_edges(spark):
    """Edges are great circles of the authalic sphere; cut finely, they follow the parallels."""
    exact = cell_area(-105, 40, -104, 41)
    assert area(spark, f"POLYGON ({text(ring(-105.0, 40.0, 1.0, steps=500))})") == pytest.approx(exact, rel=1e-9)
    assert area(spark, f"POLYGON ({text(ring(-105.0, 40.0, 1.0))})") == pytest.approx(exact, rel=1e-4)


def test_antimeridian(spark):
    across = "POLYGON ((179.9995 10, -179.9995 10, -179.9995 10.001, 179.9995 10.001, 179.9995 10))"
    assert area(spark, across) == pytest.approx(cell_area(0, 10, 0.001, 10.001), rel=1e-8)


@pytest.mark.parametrize("steps", [3, 4, 36])
def test_ring_around_a_pole_raises(spark, steps):
    points = [(-180 + 360 * i / steps, 80.0) for i in range(steps + 1)]
    for around in (points, points[::-1], [(x, -y) for x, y in points], points[:-1]):
        with pytest.raises(Exception, match="pole"):
            area(spark, f"POLYGON ({text(around)})")


def test_empty_rings_have_no_area(spark):
    schema = "g array<array<array<struct<x:double,y:double>>>>"
    cell = ring(-105.0, 40.0, 0.001)
    df = spark.createDataFrame([([[]],), ([[[]]],), ([[cell, []]],), ([],), (None,)], schema)
    got = [r[0] for r in df.select(geodesic_area(F.col("g"))).collect()]
    assert got[:2] == [0.0, 0.0] and got[2] == pytest.approx(cell_area(-105, 40, -104.999, 40.001), rel=1e-8) and got[3:] == [0.0, None]
    assert [r[0] for r in df.select(has_vertices(F.col("g"))).collect()] == [False, False, True, False, False]


@pytest.mark.parametrize("wkt, rings", [
    ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), EMPTY)", [1]), ("MULTIPOLYGON (EMPTY, ((0 0, 1 0, 1 1, 0 0)))", [1]),
    ("multipolygon(empty,((0 0,1 0,1 1,0 0)),empty,((0 0,1 0,1 1,0 0)))", [1, 1]), ("MULTIPOLYGON (EMPTY, EMPTY)", []),
    ("POLYGON ((0 0, 1 0, 1 1, 0 0), EMPTY)", [1]), ("MULTIPOLYGON Z EMPTY", []), ("MULTIPOLYGON (EMPTY)", []), ("POLYGON EMPTY", []),
])
def test_empty_members(spark, wkt, rings):
    polygons = spark.createDataFrame([(wkt,)], "w string").select(polygons_from_wkt(F.col("w"))).first()[0]
    assert [len(p) for p in polygons] == rings and all(len(r) == 4 for p in polygons for r in p)


@pytest.mark.parametrize("wkt", [
    "POLYGON((0 0,1 0,1 1,0 0))", "polygon (( 0  0 , 1 0,1 1 , 0 0 ))", "SRID=4326;POLYGON ((0 0, 1 0, 1 1, 0 0))",
    "MULTIPOLYGON(((0 0,1 0,1 1,0 0)))", "MULTIPOLYGON ( ( ( 0 0, 1 0, 1 1, 0 0 ) ) )",
    "POLYGON\n((0\t0,\r\n 1 0,\n1 1\n,0 0\n)\n)\n", "POLYGON Z ((0 0 7, 1 0 7, 1 1 7, 0 0 7))", "POLYGON ((0e0 0.0, 1E0 -0, 1 1.0e+0, 0 0))",
])
def test_wkt_spellings(spark, wkt):
    df = spark.createDataFrame([(wkt,)], "w string")
    polygons = df.select(polygons_from_wkt(F.col("w"))).first()[0]
    assert [[[(v.x, v.y) for v in r] for r in p] for p in polygons] == [[[(0, 0), (1, 0), (1, 1), (0, 0)]]]


def test_wkt_nesting(spark):
    wkt = "MULTIPOLYGON (((0 0, 9 0, 9 9, 0 0), (1 1, 2 1, 2 2, 1 1)), ((20 0, 21 0, 21 1, 20 0)))"
    df = spark.createDataFrame([(wkt,)], "w string")
    polygons = df.select(polygons_from_wkt(F.col("w"))).first()[0]
    assert [[len(r) for r in p] for p in polygons] == [[4, 4], [4]]


def test_empty_missing_and_foreign_geometry(spark):
    df = spark.createDataFrame([("POLYGON EMPTY",), (None,)], "w string")
    shapes = df.select(polygons_from_wkt(F.col("w")).alias("g"))
    assert [r[0] for r in shapes.select(has_vertices(F.col("g"))).collect()] == [False, False]
    for wkt in ("POINT (1 2)", "nonsense", "POLYGON ((a b, 1 2, 3 4, a b))"):
        with pytest.raises(Exception):
            area(spark, wkt)


def test_features_to_raw_rows(spark):
    cell = f"POLYGON ({text(ring(-105.0, 40.0, 0.001))})"
    rows = [
        ("1", "P1", "5", "2", cell, "20210526"), ("2", "", "5", "2", cell, "20210526"),
        ("3", None, "5", "2", cell, "20210526"), ("4", "P4", "5", "2", None, "20210526"),
        ("5", "P5", "5", "2", "POLYGON EMPTY", "20210526"), ("1", "P1", "5", "2", cell, "20210526"),
    ]
    columns = "object_id string, parcel_no string, shape_area string, shape_len string, wkt string, file_index string"
    features = features_from_wkt(spark.createDataFrame(rows, columns))
    kept = raw_parcel_rows(features).collect()
    assert [(r.object_id, r.parcel_id) for r in kept] == [("1", "P1"), ("1", "P1")]  # duplicates stay
    assert kept[0].area_m2 == pytest.approx(cell_area(-105, 40, -104.999, 40.001), rel=1e-8)
    assert [tuple(r) for r in features_without_geometry(features).collect()] == [("20210526", 2)]


def wkb(polygons, order="<", multi=True, srid=False, z=False):
    """Well-known binary by hand."""
    def head(kind, with_srid):
        code = kind | (0x20000000 if with_srid else 0) | (0x80000000 if z else 0)
        mark = struct.pack(order + "BI", order == "<", code)
        return mark + (struct.pack(order + "I", 4326) if with_srid else b"")

    def one(polygon, with_srid):
        body = head(3, with_srid) + struct.pack(order + "I", len(polygon))
        for points in polygon:
            body += struct.pack(order + "I", len(points))
            body += b"".join(struct.pack(order + ("3d" if z else "2d"), *p, *([9.0] if z else [])) for p in points)
        return body

    if not multi:
        return one(polygons[0], srid)
    parts = b"".join(one(polygon, False) for polygon in polygons)
    return head(6, srid) + struct.pack(order + "I", len(polygons)) + parts


@pytest.mark.parametrize("variant", [
    {}, {"order": ">"}, {"srid": True}, {"z": True}, {"multi": False}, {"multi": False, "srid": True, "order": ">"},
])
def test_wkb_equals_wkt(spark, variant):
    polygons = [[ring(-105.0, 40.0, 0.003), ring(-104.999, 40.001, 0.001)]]
    wkt = f"POLYGON ({', '.join(text(r) for r in polygons[0])})"
    if variant.get("multi", True):
        polygons.append([ring(-104.0, 41.0, 0.002)])
        wkt = f"MULTIPOLYGON (({', '.join(text(r) for r in polygons[0])}), ({text(polygons[1][0])}))"
    df = spark.createDataFrame([(wkb(polygons, **variant), wkt), (None, None)], "b binary, t string")
    rows = df.select(polygons_from_wkb("b").alias("b"), polygons_from_wkt(F.col("t")).alias("t")).collect()
    assert rows[0].b == rows[0].t and rows[1].b is None


def test_geometry_is_decoded_once(spark):
    df = spark.createDataFrame([("1",) * 5 + ("POLYGON EMPTY", b"")], "object_id string, parcel_no string, "
                               "shape_area string, shape_len string, file_index string, wkt string, wkb binary")
    for rows, python in ((features_from_wkb(df), 1), (features_from_wkt(df), 0)):
        text = raw_parcel_rows(rows)._jdf.queryExecution().executedPlan().toString()
        assert text.count("ArrowEvalPython") == python and "CollectMetrics" in text


def packed_polygon(rings, order, numbers, srid, iso):
    kind = 3 + ({2: 0, 3: 1000, 4: 3000}[numbers] if iso else 0)
    if not iso:
        kind |= {2: 0, 3: 0x80000000, 4: 0xC0000000}[numbers]
    out = struct.pack(order + "BI", order == "<", kind | (0x20000000 if srid else 0)) + (struct.pack(order + "I", 4326) if srid else b"")
    out += struct.pack(order + "I", len(rings))
    for points in rings:
        out += struct.pack(order + "I", len(points)) + b"".join(struct.pack(order + "d" * numbers, *v, *[9.0] * (numbers - 2)) for v in points)
    return out


def random_geometries(seed, n):
    """Cells of all make-ups, and what they hold."""
    rng = random.Random(seed)
    some = lambda: [[(rng.random(), rng.random()) for _ in range(rng.randrange(6))] for _ in range(rng.randrange(4))]
    for _ in range(n):
        order, numbers, iso, chance = rng.choice("<>"), rng.choice([2, 2, 3, 4]), rng.random() < 0.5, rng.random()
        if chance < 0.1:
            yield None, None
        elif chance < 0.5:
            rings = some()
            yield packed_polygon(rings, order, numbers, rng.random() < 0.3, iso), [rings] if rings else []
        else:
            polygons = [some() for _ in range(rng.randrange(4))]
            body = b"".join(packed_polygon(p, rng.choice("<>"), numbers, False, iso) for p in polygons)
            yield struct.pack(order + "BII", order == "<", 6, len(polygons)) + body, polygons


def test_wkb_of_all_make_ups_in_one_buffer():
    cells, want = zip(*random_geometries(1, 1500))
    plain = lambda a: [g and [[[(v["x"], v["y"]) for v in r] for r in p] for p in g] for g in a.to_pylist()]
    assert plain(decode(pa.array(cells, pa.binary()))) == list(want)
    assert plain(decode(pa.array([b"zz", *cells], pa.binary()).slice(1, 300))) == list(want[:300])
    assert plain(decode(pa.array([], pa.binary()))) == [] and plain(decode(pa.array([None], pa.binary()))) == [None]
    for bad in (b"", b"\1\1\0\0\0" + bytes(16), struct.pack("<BII", 1, 6, 1) + struct.pack("<BII", 1, 2, 0)):
        with pytest.raises(ValueError):
            decode(pa.array([cells[0], bad], pa.binary()))


def brute_groups(rings):
    """Every hole's vertices one by one against every shell."""
    def inside(point, points):
        (px, py), after = point, np.roll(points, -1, axis=0)
        crossing = (points[:, 1] > py) != (after[:, 1] > py)
        a, b = points[crossing], after[crossing]
        at = a[:, 0] + (py - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0])
        return np.count_nonzero(at > px) % 2

    shells = [[x] for x in rings if shapefile._clockwise(x)]
    found = list(shells)
    for hole in (x for x in rings if not shapefile._clockwise(x)):
        around = [p for p in shells if 2 * sum(inside(v, p[0]) for v in hole) > len(hole)]
        if around:
            min(around, key=lambda p: np.ptp(p[0], axis=0).prod()).append(hole)
        else:
            found.append([hole])
    return found


@pytest.mark.parametrize("seed", range(30))
def test_rings_are_grouped_as_one_by_one(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(shapefile, "CELLS", 7 if seed % 2 else 1_000_000)
    rings = [
        np.round(rng.random(2) * 6 + rng.random((rng.integers(3, 9), 2)) * rng.choice([0.5, 2, 6]), rng.integers(0, 4))
        for _ in range(rng.integers(1, 25))
    ]
    got, want = shapefile._group_rings(rings), brute_groups(rings)
    assert [[x.tolist() for x in p] for p in got] == [[x.tolist() for x in p] for p in want]


def test_many_rings_take_seconds():
    square = lambda x, y, side: np.array([(x, y), (x, y + side), (x + side, y + side), (x + side, y), (x, y)], float)
    rings = [r for i in range(100) for j in range(50) for r in (square(i * 10, j * 10, 8), square(i * 10 + 2, j * 10 + 2, 3)[::-1])]
    random.Random(1).shuffle(rings)
    start = time.perf_counter()
    groups = shapefile._group_rings(rings)
    assert len(groups) == 5000 and {len(p) for p in groups} == {2} and time.perf_counter() - start < 10
