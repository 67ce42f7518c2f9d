"""Ownership joined with land area, and its roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landmart.constants import RESIDENTIAL_TYPES
from landmart.functions.attributes import in_types
from landmart.functions.measures import mean_stake, thousandths
from landmart.operators.ownership import distinct_ownership


def holdings(owners: DataFrame, areas: DataFrame) -> DataFrame:
    """Distinct ownership rows with the area of their parcel in the same snapshot, of which ``areas`` has one
    row each.

    Owners of unknown parcels and parcels without owners drop out (inner join). Only a flag of
    the account type and the stake in thousandths go on into the join's shuffle.
    """
    residential = F.col("is_real_property") & in_types(F.col("account_type"), RESIDENTIAL_TYPES)
    held = distinct_ownership(owners).select(
        "file_index", "parcel_id", "owner_name", "is_real_property",
        residential.alias("is_residential"), thousandths(F.col("pct_own")).alias("stake"),
    )
    return held.join(areas, ["parcel_id", "file_index"])


def holdings_per_parcel(held: DataFrame) -> DataFrame:
    """One row per owner, parcel and snapshot: which kinds are held, and stakes by kind.

    Grouping on the join keys and the owner needs no shuffle after the join. Flags per parcel
    turn the later distinct parcel counts into plain sums.
    """
    real, building, residential = F.col("is_real_property"), ~F.col("is_real_property"), F.col("is_residential")

    def held_as(kind):
        return F.max(F.when(kind, 1).otherwise(0))

    def stakes(kind):
        return F.when(kind, F.col("stake"))

    return held.groupBy("file_index", "parcel_id", "owner_name").agg(
        F.max("area_m2").alias("area_m2"),
        held_as(real).alias("real"),
        held_as(building).alias("building"),
        held_as(residential).alias("residential"),
        F.sum(stakes(real)).alias("real_stake"),
        F.count(stakes(real)).alias("real_stakes"),
        F.sum(stakes(building)).alias("building_stake"),
        F.count(stakes(building)).alias("building_stakes"),
        F.sum(stakes(residential)).alias("residential_stake"),
    )


def holdings_per_owner(per_parcel: DataFrame) -> DataFrame:
    """One row per owner and snapshot. Joint owners at full stake each get the full area.

    Real area and real stake stay NULL for owners without real property; the residential and
    building figures are 0 instead. A missing stake adds no area.
    """
    area = F.col("area_m2")
    return per_parcel.groupBy("file_index", "owner_name").agg(
        F.sum("real").alias("real_parcels"),
        F.sum("building").alias("building_parcels"),
        F.sum("residential").alias("residential_parcels"),
        (F.sum(area * F.col("real_stake")) / 1000).alias("real_m2"),
        F.coalesce(F.sum(area * F.col("residential_stake")) / 1000, F.lit(0)).alias("residential_m2"),
        mean_stake(F.sum("real_stake"), F.sum("real_stakes")).alias("real_mean_stake"),
        F.coalesce(
            mean_stake(F.sum("building_stake"), F.sum("building_stakes")), F.lit(0)
        ).alias("building_mean_stake"),
    )


def land_per_type(owners: DataFrame, areas: DataFrame) -> DataFrame:
    """One row per account type and snapshot over real property with a known parcel.

    A parcel under several types counts in full under each, and an owner of several parcels
    counts once per parcel.
    """
    real = owners.filter("is_real_property").select("file_index", "parcel_id", "account_type", "owner_name")
    # once distinct, an owner's name only matters as present or not
    named = real.distinct().select(
        "file_index", "parcel_id", "account_type", F.col("owner_name").isNotNull().cast("int").alias("named")
    )
    per_parcel = (
        named.join(areas, ["parcel_id", "file_index"])
        .groupBy("file_index", "parcel_id", "account_type")
        .agg(F.sum("named").alias("owners"), F.max("area_m2").alias("area_m2"))
    )
    return per_parcel.groupBy("file_index", "account_type").agg(
        F.count("parcel_id").alias("parcels"),
        F.sum("owners").alias("owners"),
        F.sum("area_m2").alias("area_m2"),
    )
