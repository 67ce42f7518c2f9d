"""Reports on the known data issues. All group before they join, so no key is hot in a join.

Each report can be had by itself. ``parcel_profile`` makes all of them from one pass over owners and features: stored once,
every report is a filter on it (``REPORTS``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landmart.functions.geometry import has_vertices

PARCEL = ("file_index", "parcel_id")


def multi_feature_parcels(parcels: DataFrame) -> DataFrame:
    """Parcels drawn as several features."""
    return parcels.groupBy(*PARCEL).agg(F.count(F.lit(1)).alias("features")).filter("features > 1")


def features_without_geometry(features: DataFrame) -> DataFrame:
    """Landed features without a vertex, counted per snapshot."""
    return features.filter(~has_vertices(F.col("geom"))).groupBy("file_index").agg(
        F.count(F.lit(1)).alias("features")
    )


def unknown_parcels(owners: DataFrame, parcels: DataFrame) -> DataFrame:
    """Parcel ids in ownership without a parcel in the same snapshot, with their owner rows."""
    claimed = owners.groupBy(*PARCEL).agg(F.count(F.lit(1)).alias("owner_rows"))
    return claimed.join(parcels.select(*PARCEL).distinct(), list(PARCEL), "left_anti")


def unowned_parcels(owners: DataFrame, parcels: DataFrame) -> DataFrame:
    """Parcels that no ownership row of the same snapshot names."""
    drawn = parcels.select(*PARCEL).distinct()
    return drawn.join(owners.select(*PARCEL).distinct(), list(PARCEL), "left_anti")


def overallocated_parcels(owners: DataFrame) -> DataFrame:
    """Real parcels whose owners' distinct stakes add up to more than the whole. An owner's stake counts once,
    also if the parcel is listed under several account types."""
    stakes = owners.filter("is_real_property").select(*PARCEL, "owner_name", "pct_own").distinct()
    return stakes.groupBy(*PARCEL).agg(F.sum("pct_own").alias("total_stake")).filter("total_stake > 1")


def multi_type_parcels(owners: DataFrame) -> DataFrame:
    """Real parcels under several account types."""
    return (
        owners.filter("is_real_property")
        .groupBy(*PARCEL)
        .agg(F.count_distinct("account_type").alias("account_types"))
        .filter("account_types > 1")
    )


def parcel_profile(owners: DataFrame, features: DataFrame, drawn: Column) -> DataFrame:
    """One row per snapshot and parcel that owners or features name: features and those not ``drawn``, ownership rows, real
    account types and the sum of distinct real stakes.

    Ownership is grouped by distinct stakes first. Their account types are few, so what a parcel gathers of them is small
    however many owners it has.
    """
    real = F.col("is_real_property")
    stakes = owners.groupBy(*PARCEL, "is_real_property", "owner_name", "pct_own").agg(
        F.count(F.lit(1)).alias("rows"), F.collect_set(F.when(real, F.col("account_type"))).alias("types"))
    held = stakes.groupBy(*PARCEL).agg(
        F.sum("rows").alias("owner_rows"),
        F.size(F.array_distinct(F.flatten(F.collect_set("types")))).alias("account_types"),
        F.sum(F.when(real, F.col("pct_own"))).alias("total_stake"),
    )
    shown = features.groupBy(*PARCEL).agg(
        F.count(F.lit(1)).alias("features"), F.count_if(~drawn).alias("not_drawn"))
    return shown.join(held, list(PARCEL), "full").fillna({"features": 0, "not_drawn": 0, "owner_rows": 0, "account_types": 0})


REPORTS = {
    "multi_feature": "features > 1",
    "no_geometry": "not_drawn > 0",
    "unknown": "owner_rows > 0 AND features = 0",
    "unowned": "owner_rows = 0",
    "overallocated": "total_stake > 1",
    "multi_type": "account_types > 1",
}


def report_sizes(profile: DataFrame) -> DataFrame:
    """(file_index, report, parcels): how many parcels of a snapshot each report names."""
    named = F.array(*[F.when(F.expr(found), name) for name, found in REPORTS.items()])
    each = profile.select("file_index", F.explode(F.array_compact(named)).alias("report"))
    return each.groupBy("file_index", "report").agg(F.count(F.lit(1)).alias("parcels"))
