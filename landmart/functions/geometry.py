"""Well-known text to vertex arrays, with built-in string functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landmart.schemas import POLYGONS

POLYGON_TEXT = r"^\s*(?i:SRID=\d+;)?\s*(?i:MULTIPOLYGON|POLYGON)\s*(?i:Z|M|ZM)?\s*\("
# EMPTY itself, or nothing but EMPTY members
EMPTY_TEXT = (
    r"(?i)^\s*(?:SRID=\d+;)?\s*[A-Z]+(?:\s+(?:Z|M|ZM))?\s*(?:\sEMPTY|\(\s*EMPTY(?:\s*,\s*EMPTY)*\s*\))\s*$"
)
MEMBERS_EMPTY = r"(?i)\(.*EMPTY"


def _vertex(text: Column) -> Column:
    """The first two of the blank-separated numbers."""
    numbers = F.trim(text)
    x = F.substring_index(numbers, " ", 1)
    rest = F.ltrim(F.substr(numbers, F.length(x) + 1))
    return F.struct(
        x.cast("double").alias("x"), F.substring_index(rest, " ", 1).cast("double").alias("y")
    )


def _blanks_only(text: Column) -> Column:
    """Other white space becomes blanks; most text has none and is passed on as it is."""
    other = text.contains("\t") | text.contains("\n") | text.contains("\r")
    return F.when(other, F.translate(text, "\t\n\r", "   ")).otherwise(text)


def polygons_from_wkt(wkt: Column) -> Column:
    """Vertex arrays of a POLYGON or MULTIPOLYGON: polygons -> rings -> (x, y).

    NULL stays NULL, EMPTY gives no polygons, any other geometry type raises.
    """
    # members without a vertex add nothing
    empty = r"(?i)\s*,\s*EMPTY\b|\bEMPTY\s*,"
    full = F.when(wkt.rlike(MEMBERS_EMPTY), F.regexp_replace(wkt, empty, "")).otherwise(wkt)
    # without the brackets around everything; plain trimming at the end is cheaper than a pattern
    body = F.rtrim(F.regexp_replace(_blanks_only(full), r"^[^(]*[ (]*", ""), F.lit(" )"))
    polygons = F.transform(
        F.split(body, r"\) *\) *, *\( *\("),
        lambda polygon: F.transform(
            F.split(polygon, r"\) *, *\("),
            lambda ring: F.transform(F.split(ring, ","), _vertex),
        ),
    )
    return (
        F.when(wkt.rlike(EMPTY_TEXT), F.array().cast(POLYGONS))
        .when(wkt.rlike(POLYGON_TEXT), polygons)
        .when(wkt.isNotNull(), F.raise_error(F.concat(F.lit("not a polygon: "), F.substring(wkt, 1, 60))))
    )


def has_vertices(polygons: Column) -> Column:
    """False for NULL and for geometries without a single vertex."""
    return F.coalesce(
        F.exists(polygons, lambda polygon: F.exists(polygon, lambda ring: F.size(ring) > 0)),
        F.lit(False),
    )
