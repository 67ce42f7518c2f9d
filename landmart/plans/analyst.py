"""The three analyst questions, each from the raw tables and from a mart.

The raw and the mart form of a question differ on purpose where the published definitions do:
the raw forms read a missing stake as full ownership, and match parcels or owners of any snapshot.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landmart.constants import RESIDENTIAL_TYPES
from landmart.functions.attributes import in_types
from landmart.functions.measures import acres
from landmart.operators.areas import one_row_per, parcel_area
from landmart.operators.ownership import type_mask


def _snapshot(df: DataFrame, file_index: str) -> DataFrame:
    return df.filter(F.col("file_index") == file_index)


def _largest_first(df: DataFrame, measure: str, top: int | None) -> DataFrame:
    """Descending with missing values first, ties by name; ``top`` keeps the leading rows."""
    ordered = df.orderBy(F.desc_nulls_first(measure), F.asc_nulls_first("owner_name"))
    return ordered if top is None else ordered.limit(top)


def _residential(owners: DataFrame) -> DataFrame:
    return owners.filter(F.col("is_real_property") & in_types(F.col("account_type"), RESIDENTIAL_TYPES))


def residential_acres_raw(owners: DataFrame, parcels: DataFrame, file_index: str) -> DataFrame:
    """Total residential acres of a snapshot; a parcel counts once per residential type it has.

    The types of a parcel are a bit set, so one grouping by parcel serves both the distinct
    (parcel, type) pairs and the join.
    """
    types = (
        _residential(_snapshot(owners, file_index))
        .groupBy("parcel_id")
        .agg(F.bit_count(type_mask(F.col("account_type"), RESIDENTIAL_TYPES)).alias("types"))
    )
    areas = parcel_area(_snapshot(parcels, file_index), "parcel_id")
    return areas.join(types, "parcel_id").agg(
        acres(F.sum(F.col("area_m2") * F.col("types"))).alias("total_residential_land_acres")
    )


def residential_acres_mart(land_types: DataFrame, report_date: date) -> DataFrame:
    return land_types.filter((F.col("report_date") == F.lit(report_date)) & F.col("is_residential")).agg(
        F.sum("land_area_acres").alias("total_land_area")
    )


def owners_by_residential_raw(
    owners: DataFrame,
    parcels: DataFrame,
    file_index: str,
    owner_snapshot: str | None = None,
    top: int | None = None,
) -> DataFrame:
    """Owners by residential acres held. Ownership is read from every snapshot unless
    ``owner_snapshot`` names one, while areas come from ``file_index`` only."""
    if owner_snapshot is not None:
        owners = _snapshot(owners, owner_snapshot)
    stakes = (
        _residential(owners)
        .select("owner_name", "parcel_id", F.coalesce("pct_own", F.lit(1)).alias("stake"))
        .distinct()
    )
    areas = one_row_per(_snapshot(parcels, file_index), "parcel_id", area_m2=F.sum("area_m2"))
    held = stakes.join(areas, "parcel_id").groupBy("owner_name").agg(
        acres(F.sum(F.col("area_m2") * F.col("stake"))).alias("total_owned_residential")
    )
    return _largest_first(held, "total_owned_residential", top)


def owners_by_residential_mart(
    owner_days: DataFrame, report_date: date, top: int | None = None
) -> DataFrame:
    day = owner_days.filter(F.col("report_date") == F.lit(report_date))
    measure = "total_residential_land_area_owned_acres"
    return _largest_first(day.select("owner_name", measure), measure, top)


def owners_by_property_count_raw(
    owners: DataFrame, parcels: DataFrame, file_index: str, top: int | None = None
) -> DataFrame:
    """Owners by number of real parcels in a snapshot; the parcel may be known from any snapshot."""
    held = (
        _snapshot(owners, file_index).filter("is_real_property").select("owner_name", "parcel_id").distinct()
    )
    known = one_row_per(parcels, "parcel_id")
    counted = (
        held.join(known, "parcel_id", "left_semi")
        .groupBy("owner_name")
        .agg(F.count("parcel_id").alias("total_properties"))
    )
    return _largest_first(counted, "total_properties", top)


def owners_by_property_count_mart(
    owner_days: DataFrame, report_date: date, top: int | None = None
) -> DataFrame:
    day = owner_days.filter(F.col("report_date") == F.lit(report_date))
    measure = "total_real_property_owned"
    return _largest_first(day.select("owner_name", measure), measure, top)
