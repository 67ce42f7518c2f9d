"""Table layouts, in column order, and the projection that enforces them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAKE = T.DecimalType(10, 3)
MEASURE = T.DecimalType(38, 10)

VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
# polygons -> rings (shell first, then holes) -> vertices in lon/lat degrees
POLYGONS = T.ArrayType(T.ArrayType(T.ArrayType(VERTEX)))


def _layout(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


# The ownership file: 34 columns matched by position, header text ignored.
OWNER_FILE_COLUMNS = (
    "created_date", "strap", "folio", "status_cd", "building_num", "street_num", "street",
    "street_prefix", "street_suffix", "street_unit", "city", "sub_code", "sub_description",
    "section", "township", "range", "block", "lot", "owner_name", "mail_to", "mailingAddr1",
    "mailingAddr2", "mailingCity", "mailingState", "mailingZip", "mailingCountry", "role_cd",
    "pct_own", "taxArea", "nh", "mill_levy", "legalDscr", "waterFee", "account_type",
)
OWNER_FILE_SCHEMA = _layout(
    *((c, T.TimestampType() if c == "created_date" else T.StringType()) for c in OWNER_FILE_COLUMNS)
)

RAW_OWNERS = _layout(
    ("account_id", T.StringType()),
    ("parcel_id", T.StringType()),
    ("lot", T.StringType()),
    ("is_real_property", T.BooleanType()),
    ("status_cd", T.StringType()),
    ("address", T.StringType()),
    ("address_unit", T.StringType()),
    ("city", T.StringType()),
    ("owner_name", T.StringType()),
    ("pct_own", STAKE),
    ("account_type", T.StringType()),
    ("created_at", T.TimestampType()),
    ("file_index", T.StringType()),
)

# area_m2 is computed once at load, so no later query touches the geometry.
RAW_PARCELS = _layout(
    ("object_id", T.StringType()),
    ("parcel_id", T.StringType()),
    ("shape_area", T.StringType()),
    ("shape_len", T.StringType()),
    ("geom", POLYGONS),
    ("area_m2", T.DoubleType()),
    ("file_index", T.StringType()),
)

# one row per parcel of a snapshot: the sum over its features
PARCEL_AREAS = _layout(
    ("parcel_id", T.StringType()),
    ("area_m2", T.DoubleType()),
    ("file_index", T.StringType()),
)

OWNER_DAILY_SUMMARY = _layout(
    ("report_date", T.DateType()),
    ("owner_name", T.StringType()),
    ("total_real_property_owned", T.IntegerType()),
    ("total_building_property_owned", T.IntegerType()),
    ("total_real_property_land_area_owned_m2", MEASURE),
    ("total_real_property_land_area_owned_acres", MEASURE),
    ("total_residential_parcels_owned", T.IntegerType()),
    ("total_residential_land_area_owned_m2", MEASURE),
    ("total_residential_land_area_owned_acres", MEASURE),
    ("avg_real_property_investment_stake", MEASURE),
    ("avg_building_property_investment_stake", MEASURE),
    ("real_property_gain_loss", T.IntegerType()),
    ("pct_land_area_gain_loss", MEASURE),
)

LAND_TYPE_DAILY_SUMMARY = _layout(
    ("report_date", T.DateType()),
    ("account_type", T.StringType()),
    ("is_residential", T.BooleanType()),
    ("is_commercial", T.BooleanType()),
    ("total_parcels", T.IntegerType()),
    ("total_owners", T.IntegerType()),
    ("land_area_m2", MEASURE),
    ("land_area_acres", MEASURE),
    ("pct_total_land_area", MEASURE),
    ("total_parcel_gain_loss", T.IntegerType()),
    ("pct_land_area_gain_loss", MEASURE),
)

#: With the marts' rows: the area as computed, which the next day's change goes by.
EXACT_AREA = T.StructField("exact_m2", T.DoubleType())

# the last row of every owner or type so far; part is the last snapshot
OWNER_LAST = _layout(
    ("report_date", T.DateType()),
    ("owner_name", T.StringType()),
    ("total_real_property_owned", T.IntegerType()),
    ("exact_m2", T.DoubleType()),
    ("part", T.StringType()),
)
LAND_TYPE_LAST = _layout(
    ("report_date", T.DateType()),
    ("account_type", T.StringType()),
    ("total_parcels", T.IntegerType()),
    ("exact_m2", T.DoubleType()),
    ("part", T.StringType()),
)

TABLES_BY_NAME = {
    "raw.owners": RAW_OWNERS, "raw.parcels": RAW_PARCELS, "raw.parcel_areas": PARCEL_AREAS,
    "marts.owner_daily_summary": OWNER_DAILY_SUMMARY, "marts.land_type_daily_summary": LAND_TYPE_DAILY_SUMMARY,
    "marts.owner_last": OWNER_LAST, "marts.land_type_last": LAND_TYPE_LAST,
}


def conform(df: DataFrame, layout: T.StructType) -> DataFrame:
    """Project to the layout's columns, order and types; overflow raises under ANSI."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.fields])
