"""Area on the WGS84 spheroid as a native column expression.

Latitudes are mapped to authalic latitudes, which keeps areas, so a ring's area is that of a
spherical polygon on the authalic sphere (Snyder, Map Projections: A Working Manual, 1987).
Every edge adds its spherical excess against the equator; the sum over a closed ring is the
enclosed area. A ring around a pole goes once around in longitude and encloses no such area: it raises.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from landmart.constants import WGS84_A, WGS84_E2

_E = math.sqrt(WGS84_E2)
_Q_POLE = 1.0 - (1.0 - WGS84_E2) / (2.0 * _E) * math.log((1.0 - _E) / (1.0 + _E))
AUTHALIC_RADIUS_SQUARED = WGS84_A * WGS84_A * _Q_POLE / 2.0


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for all its uses in ``body``."""
    return F.transform(F.array(value), body)[0]


def _sin_authalic(s: Column) -> Column:
    """Sine of the authalic latitude from the sine of the latitude."""
    q = s / (1.0 - WGS84_E2 * s * s) + F.atanh(_E * s) / _E
    return q * ((1.0 - WGS84_E2) / _Q_POLE)


def _to_sphere(vertex: Column) -> Column:
    """Longitude in radians, and the tangent of half the authalic latitude."""
    sine = _let(F.sin(F.radians(vertex["y"])), _sin_authalic)
    tangent = _let(sine, lambda s: s / (1.0 + F.sqrt(1.0 - s * s)))
    return F.struct(F.radians(vertex["x"]).alias("lon"), tangent.alias("t"))


def _excess(a: Column, b: Column) -> Column:
    width = F.tan((b["lon"] - a["lon"]) / 2.0)
    return 2.0 * F.atan2(width * (a["t"] + b["t"]), 1.0 + a["t"] * b["t"])


def _turn(a: Column, b: Column) -> Column:
    """The step in longitude, taken the short way."""
    step = b["lon"] - a["lon"]
    return step - F.rint(step / (2 * math.pi)) * (2 * math.pi)


def _full_turn(ring: Column) -> Column:
    """Whether the ring goes once around in longitude."""
    lon = lambda vertex: F.radians(vertex["x"])
    turned = F.aggregate(
        ring,
        F.struct(lon(F.get(ring, F.size(ring) - 1)).alias("lon"), F.lit(0.0).alias("turn")),
        lambda acc, v: F.struct(lon(v).alias("lon"), (acc["turn"] + _turn(acc, F.struct(lon(v).alias("lon")))).alias("turn")),
        lambda acc: F.abs(acc["turn"]) >= math.pi,
    )
    # a ring within half a circle can't, and its extent is cheap
    return F.when(F.array_max(ring["x"]) - F.array_min(ring["x"]) < 180, F.lit(False)).otherwise(turned)


def _ring_area(ring: Column) -> Column:
    """Absolute area of one ring; an unclosed ring is closed from its last vertex, an empty one has none."""
    last = _to_sphere(F.get(ring, F.size(ring) - 1))
    total = F.aggregate(
        F.transform(ring, _to_sphere),
        F.struct(last["lon"].alias("lon"), last["t"].alias("t"), F.lit(0.0).alias("total")),
        lambda acc, p: F.struct(
            p["lon"].alias("lon"), p["t"].alias("t"), (acc["total"] + _excess(acc, p)).alias("total")
        ),
        lambda acc: acc["total"],
    )
    pole = F.raise_error(F.lit("a ring around a pole has no area here")).cast("double")
    return F.when(F.size(ring) == 0, 0.0).when(_full_turn(ring), pole).otherwise(F.abs(total) * AUTHALIC_RADIUS_SQUARED)


def _polygon_area(polygon: Column) -> Column:
    """Shell minus holes."""
    signed = F.transform(
        polygon, lambda ring, i: F.when(i == 0, 1.0).otherwise(-1.0) * _ring_area(ring)
    )
    return F.aggregate(signed, F.lit(0.0), lambda acc, area: acc + area)


def geodesic_area(polygons: Column) -> Column:
    """Square metres, summed over the polygons; NULL for NULL."""
    return F.aggregate(
        F.transform(polygons, _polygon_area), F.lit(0.0), lambda acc, area: acc + area
    )
