"""Parcel features of any origin to the raw layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from landmart.functions.geodesic import geodesic_area
from landmart.functions.geometry import has_vertices, polygons_from_wkt
from landmart.schemas import RAW_PARCELS, conform
from landmart.sources.wkb import polygons_from_wkb


def features_from_wkt(df: DataFrame) -> DataFrame:
    """Features whose geometry is a ``wkt`` text column."""
    return df.withColumn("geom", polygons_from_wkt(F.col("wkt"))).drop("wkt")


def features_from_wkb(df: DataFrame) -> DataFrame:
    """Features whose geometry is a ``wkb`` binary column."""
    return df.withColumn("geom", polygons_from_wkb(F.col("wkb"))).drop("wkb")


def raw_parcel_rows(features: DataFrame, skipped: Observation | None = None) -> DataFrame:
    """Drop features without geometry (counted as ``records_skipped``) and without a parcel id.

    Duplicates stay: features of one parcel add up.
    """
    # the count also keeps the filter above the step that makes `geom`, so that it is made once
    features = features.observe(
        skipped or "features", F.count_if(~has_vertices(F.col("geom"))).alias("records_skipped")
    )
    kept = features.filter(has_vertices(F.col("geom")) & (F.col("parcel_no") != ""))
    return conform(
        kept.withColumnRenamed("parcel_no", "parcel_id").withColumn("area_m2", geodesic_area(F.col("geom"))),
        RAW_PARCELS,
    )
