"""The two reporting marts, computed from the raw tables: all days, or the days that follow ``before``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landmart.constants import COMMERCIAL_TYPES, RESIDENTIAL_TYPES
from landmart.functions.attributes import in_types, report_date
from landmart.functions.measures import acres, area_change, count_change, ratio
from landmart.operators.areas import area_per_parcel
from landmart.operators.holdings import holdings, holdings_per_owner, holdings_per_parcel, land_per_type
from landmart.schemas import EXACT_AREA, LAND_TYPE_DAILY_SUMMARY, OWNER_DAILY_SUMMARY, conform


def owner_daily_summary(
    owners: DataFrame, parcels: DataFrame, areas: DataFrame | None = None, before: DataFrame | None = None,
) -> DataFrame:
    """Holdings per owner and day, with the change against the owner's previous snapshot.

    ``areas`` (one row per parcel and snapshot) saves summing the features of ``parcels``. ``before`` has the last
    row (owner_name, report_date, total_real_property_owned, exact_m2) of each owner before the days of ``owners``.
    """
    return conform(owner_days(owners, parcels, areas, before), OWNER_DAILY_SUMMARY)


def owner_days(
    owners: DataFrame, parcels: DataFrame, areas: DataFrame | None, before: DataFrame | None, kept: DataFrame | None = None,
) -> DataFrame:
    """The owner mart's rows with the area as computed. ``kept`` has rows of other days as this returned them, of which only
    what goes by an earlier day is computed again."""
    area = "total_real_property_land_area_owned_m2"
    per_owner = holdings_per_owner(holdings_per_parcel(holdings(owners, area_per_parcel(parcels) if areas is None else areas)))
    # one row per owner and snapshot here, so a window partition holds at most one row per snapshot
    previous = Window.partitionBy("owner_name").orderBy("report_date")
    summary = per_owner.select(
        report_date(F.col("file_index")).alias("report_date"),
        "owner_name",
        F.col("real_parcels").alias("total_real_property_owned"),
        F.col("building_parcels").alias("total_building_property_owned"),
        F.col("real_m2").alias("total_real_property_land_area_owned_m2"),
        acres(F.col("real_m2")).alias("total_real_property_land_area_owned_acres"),
        F.col("residential_parcels").alias("total_residential_parcels_owned"),
        F.col("residential_m2").alias("total_residential_land_area_owned_m2"),
        acres(F.col("residential_m2")).alias("total_residential_land_area_owned_acres"),
        F.col("real_mean_stake").alias("avg_real_property_investment_stake"),
        F.col("building_mean_stake").alias("avg_building_property_investment_stake"),
    )
    return _after(before, _with(kept, summary, area, OWNER_DAILY_SUMMARY), area, lambda days: days.withColumns({
        "real_property_gain_loss": count_change(F.col("total_real_property_owned"), previous),
        "pct_land_area_gain_loss": area_change(F.col(area), previous),
    }))


def _with(kept: DataFrame | None, days: DataFrame, area: str, layout: T.StructType) -> DataFrame:
    """The days together with those of ``kept``, as they are written but for the area."""
    if kept is None:
        return days
    columns = [f for f in layout.fields if f.name in days.columns and f.name != area]
    exact = T.StructField(area, EXACT_AREA.dataType)
    return conform(days, T.StructType([*columns, exact])).unionByName(
        kept.drop(area).withColumnRenamed(EXACT_AREA.name, area).select(*[f.name for f in columns], area))


def _after(before: DataFrame | None, days: DataFrame, area: str, changes: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``changes`` of the days, for which the rows of ``before`` are the earliest ones."""
    if before is None:
        changed = changes(days)
    else:
        known = before.withColumnRenamed(EXACT_AREA.name, area).drop("part").withColumn("earlier", F.lit(True))
        changed = changes(days.unionByName(known, allowMissingColumns=True)).filter("earlier IS NULL").drop("earlier")
    return changed.withColumn(EXACT_AREA.name, F.col(area).cast("double"))


def land_type_daily_summary(
    owners: DataFrame, parcels: DataFrame, areas: DataFrame | None = None, before: DataFrame | None = None,
) -> DataFrame:
    """Land use per account type and day, with share of the day's total and change. ``before`` as for owners, with
    account_type and total_parcels."""
    return conform(land_type_days(owners, parcels, areas, before), LAND_TYPE_DAILY_SUMMARY)


def land_type_days(
    owners: DataFrame, parcels: DataFrame, areas: DataFrame | None, before: DataFrame | None, kept: DataFrame | None = None,
) -> DataFrame:
    """The land type mart's rows with the area as computed. ``kept`` as for owners."""
    per_type = land_per_type(owners, area_per_parcel(parcels) if areas is None else areas)
    day = Window.partitionBy("report_date")
    previous = Window.partitionBy("account_type").orderBy("report_date")
    kind = F.col("account_type")
    summary = per_type.select(
        report_date(F.col("file_index")).alias("report_date"),
        "account_type",
        in_types(kind, RESIDENTIAL_TYPES).alias("is_residential"),
        in_types(kind, COMMERCIAL_TYPES).alias("is_commercial"),
        F.col("parcels").alias("total_parcels"),
        F.col("owners").alias("total_owners"),
        F.col("area_m2").alias("land_area_m2"),
        acres(F.col("area_m2")).alias("land_area_acres"),
    )
    return _after(before, _with(kept, summary, "land_area_m2", LAND_TYPE_DAILY_SUMMARY), "land_area_m2", lambda days: days.withColumns({
        "pct_total_land_area": ratio(F.col("land_area_m2"), F.sum("land_area_m2").over(day)),
        "total_parcel_gain_loss": count_change(F.col("total_parcels"), previous),
        "pct_land_area_gain_loss": area_change(F.col("land_area_m2"), previous),
    }))
