"""Every registered query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import bindings as b
from checks import loads
from landmart.constants import COMMERCIAL_TYPES, RESIDENTIAL_TYPES
from landmart.functions.attributes import assemble_address, in_types, is_real_account, report_date, stake
from landmart.functions.geodesic import geodesic_area
from landmart.functions.geometry import polygons_from_wkt
from landmart.functions.measures import acres
from landmart.operators.areas import area_per_parcel, parcel_area
from landmart.operators.holdings import holdings, holdings_per_owner, holdings_per_parcel
from landmart.operators.ownership import distinct_ownership, parcel_account_type
from landmart.operators.snapshots import pending_snapshots, select_snapshots
from landmart.plans import analyst, marts, quality
from landmart.session import configure
from landmart.sources import owner_csv, parcel_features
from landmart.sources.quoted_records import records_of

Query = Callable[[SparkSession, str], DataFrame]
SNAPSHOT_DAY = datetime.strptime(b.SNAPSHOT, "%Y%m%d").date()


# Both sides round to the marts' ten places; areas to four, where the given tables are exact.
PLACES = {"m2": 4, "other": 10}


def _places(name: str) -> int:
    return PLACES["m2"] if name.endswith("m2") else PLACES["other"]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals and doubles as rounded doubles, as the SQL side returns them."""
    fractional = (T.DecimalType, T.DoubleType)
    return df.select([
        F.round(F.col(f.name).cast("double"), _places(f.name)).alias(f.name)
        if isinstance(f.dataType, fractional) else F.col(f.name)
        for f in df.schema.fields
    ])


def _raw(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return b.owners(spark, d), b.parcels(spark, d)


def _owner_days(spark: SparkSession, d: str) -> DataFrame:
    return marts.owner_daily_summary(*_raw(spark, d))


def _type_days(spark: SparkSession, d: str) -> DataFrame:
    return marts.land_type_daily_summary(*_raw(spark, d))


def _per_owner(spark: SparkSession, d: str) -> DataFrame:
    owners, parcels = _raw(spark, d)
    return holdings_per_owner(holdings_per_parcel(holdings(owners, area_per_parcel(parcels))))


def owner_conditional_counts(spark, d):
    return _per_owner(spark, d).select(
        "file_index", "owner_name", "real_parcels", "building_parcels", "residential_parcels"
    )


def owner_weighted_area(spark, d):
    return _per_owner(spark, d).select(
        "file_index", "owner_name", "real_m2", acres(F.col("real_m2")).alias("real_acres"),
        "residential_m2", acres(F.col("residential_m2")).alias("residential_acres"),
    )


def owner_avg_stake(spark, d):
    return _per_owner(spark, d).select("file_index", "owner_name", "real_mean_stake", "building_mean_stake")


def owner_lag_delta(spark, d):
    return _owner_days(spark, d).select(
        "report_date", "owner_name", "total_real_property_owned", "real_property_gain_loss"
    )


def owner_area_change(spark, d):
    return _owner_days(spark, d).select(
        "report_date", "owner_name", "total_real_property_land_area_owned_m2", "pct_land_area_gain_loss"
    )


def type_share_of_day(spark, d):
    return _type_days(spark, d).select("report_date", "account_type", "land_area_m2", "pct_total_land_area")


def type_lag_delta(spark, d):
    return _type_days(spark, d).select(
        "report_date", "account_type", "total_parcels", "total_parcel_gain_loss"
    )


def type_area_change(spark, d):
    return _type_days(spark, d).select(
        "report_date", "account_type", "land_area_m2", "pct_land_area_gain_loss"
    )


def address_assembly(spark, d):
    kind = F.col("p_type")
    return b.table(spark, d, "part").select(
        "p_partkey",
        assemble_address(
            F.col("p_size").cast("string"), F.when(kind == "PROMO", F.col("p_brand")),
            F.col("p_name"), F.when(kind != "SMALL", kind),
        ).alias("address"),
    )


def account_prefix_flag(spark, d):
    account = F.concat("l_returnflag", F.col("l_orderkey").cast("string"))
    return b.table(spark, d, "lineitem").select(
        account.alias("account_id"), is_real_account(account).alias("is_real_property")
    )


def stake_cast(spark, d):
    text = F.concat(
        F.lit(" "), F.col("l_linenumber").cast("string"), F.lit("."), F.col("l_partkey").cast("string")
    )
    return b.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", stake(text).cast("double").alias("pct_own")
    )


def type_flags(spark, d):
    kind = F.when(F.col("p_size") > 1, b.account_type(F.col("p_type")))
    return b.table(spark, d, "part").select(
        "p_partkey",
        kind.alias("account_type"),
        in_types(kind, RESIDENTIAL_TYPES).alias("is_residential"),
        in_types(kind, COMMERCIAL_TYPES).alias("is_commercial"),
    )


def snapshot_date_parse(spark, d):
    return b.parcels(spark, d).select("file_index").distinct().select(
        "file_index", report_date(F.col("file_index")).alias("report_date")
    )


def snapshot_pending(spark, d):
    requested = select_snapshots(b.parcels(spark, d), "all")
    loaded = b.table(spark, d, "orders").select(
        b.month_id(F.col("o_orderdate")).alias("file_index")
    )
    return pending_snapshots(requested, loaded)


def blank_key_filter(spark, d):
    parcel_no = F.when(F.col("l_returnflag") == "A", "").when(
        F.col("l_returnflag") == "N", F.col("l_partkey").cast("string")
    )
    lines = b.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", parcel_no.alias("parcel_id"))
    return lines.filter(F.col("parcel_id") != "")


def _shapes(spark, d):
    return b.parcel_shapes(spark, d).withColumn("geom", polygons_from_wkt(F.col("wkt")))


def shape_vertices(spark, d):
    rings = F.flatten("geom")
    return _shapes(spark, d).select(
        "parcel_id", F.size("geom").alias("polygons"), F.size(rings).alias("rings"),
        F.size(F.flatten(rings)).alias("vertices"),
    )


def wkb_vertices(spark, d):
    geom = parcel_features.features_from_wkb(b.parcel_wkb(spark, d))
    rings = F.flatten("geom")
    total = lambda axis: F.aggregate(F.flatten(rings), F.lit(0.0), lambda acc, v: acc + v[axis])
    return geom.select(
        "parcel_id", F.size("geom").alias("polygons"), F.size(rings).alias("rings"), F.size(F.flatten(rings)).alias("vertices"),
        total("x").alias("sum_x"), total("y").alias("sum_y"))


def geodesic_areas(spark, d):
    area = F.round(geodesic_area(F.col("geom")), 2)
    return _shapes(spark, d).select("parcel_id", area.alias("area_m2"))


def _drawn(spark, d):
    """Orders play drawn parcels: the customer is the parcel, the order's month the snapshot."""
    return b.table(spark, d, "orders").select(
        b.month_id(F.col("o_orderdate")).alias("file_index"),
        F.col("o_custkey").cast("string").alias("parcel_id"),
    )


def raw_owner_rows(spark, d):
    return comparable(owner_csv.raw_owner_rows(b.staged_owner_file(spark, d)))


def raw_parcel_rows(spark, d):
    features = parcel_features.features_from_wkt(b.landed_features(spark, d))
    return parcel_features.raw_parcel_rows(features).select(
        "object_id", "parcel_id", "shape_area", "file_index", F.round("area_m2", 2).alias("area_m2")
    )


def csv_records(spark, d):
    """Documents as delimited text, with every q for a quote."""
    text = F.translate("text", "q", '"')
    return records_of(b.table(spark, d, "documents").select("doc_id", text.alias("text")), "doc_id", "text").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("records"), F.max(F.length("value")).alias("longest"))


def dq_no_geometry(spark, d):
    return quality.features_without_geometry(parcel_features.features_from_wkt(b.landed_features(spark, d)))


QUERIES: dict[str, Query] = {
    "owner_daily_summary": lambda s, d: comparable(_owner_days(s, d)),
    "land_type_daily_summary": lambda s, d: comparable(_type_days(s, d)),
    "parcel_area": lambda s, d: comparable(parcel_area(b.parcels(s, d))),
    "ownership_distinct": lambda s, d: comparable(distinct_ownership(b.owners(s, d))),
    "parcel_account_type": lambda s, d: parcel_account_type(b.owners(s, d)),
    "owner_conditional_counts": owner_conditional_counts,
    "owner_weighted_area": lambda s, d: comparable(owner_weighted_area(s, d)),
    "owner_avg_stake": lambda s, d: comparable(owner_avg_stake(s, d)),
    "owner_lag_delta": owner_lag_delta,
    "owner_area_change": lambda s, d: comparable(owner_area_change(s, d)),
    "type_share_of_day": lambda s, d: comparable(type_share_of_day(s, d)),
    "type_lag_delta": type_lag_delta,
    "type_area_change": lambda s, d: comparable(type_area_change(s, d)),
    "residential_acres_raw": lambda s, d: comparable(
        analyst.residential_acres_raw(*_raw(s, d), b.SNAPSHOT)
    ),
    "residential_acres_mart": lambda s, d: comparable(
        analyst.residential_acres_mart(_type_days(s, d), SNAPSHOT_DAY)
    ),
    "owners_by_residential_raw": lambda s, d: comparable(
        analyst.owners_by_residential_raw(*_raw(s, d), b.SNAPSHOT)
    ),
    "owners_by_residential_one_snapshot": lambda s, d: comparable(
        analyst.owners_by_residential_raw(*_raw(s, d), b.SNAPSHOT, owner_snapshot=b.SNAPSHOT)
    ),
    "owners_by_residential_mart": lambda s, d: comparable(
        analyst.owners_by_residential_mart(_owner_days(s, d), SNAPSHOT_DAY)
    ),
    "owners_by_property_count_raw": lambda s, d: analyst.owners_by_property_count_raw(
        *_raw(s, d), b.SNAPSHOT
    ),
    "owners_by_property_count_mart": lambda s, d: analyst.owners_by_property_count_mart(
        _owner_days(s, d), SNAPSHOT_DAY
    ),
    "top_owner": lambda s, d: analyst.owners_by_property_count_raw(*_raw(s, d), b.SNAPSHOT, top=1),
    "address_assembly": address_assembly,
    "account_prefix_flag": account_prefix_flag,
    "stake_cast": stake_cast,
    "type_flags": type_flags,
    "snapshot_date_parse": snapshot_date_parse,
    "snapshot_select": lambda s, d: select_snapshots(b.parcels(s, d), "latest"),
    "snapshot_by_date": lambda s, d: select_snapshots(b.parcels(s, d), SNAPSHOT_DAY.isoformat()),
    "snapshot_pending": snapshot_pending,
    "blank_key_filter": blank_key_filter,
    "raw_owner_rows": raw_owner_rows,
    "csv_records": csv_records,
    "raw_parcel_rows": raw_parcel_rows,
    "shape_vertices": shape_vertices,
    "wkb_vertices": wkb_vertices,
    "geodesic_area": geodesic_areas,
    "dq_multi_feature": lambda s, d: quality.multi_feature_parcels(b.parcels(s, d)),
    "dq_no_geometry": dq_no_geometry,
    "dq_unknown_parcel": lambda s, d: quality.unknown_parcels(b.owners(s, d), _drawn(s, d)),
    "dq_unowned_parcel": lambda s, d: quality.unowned_parcels(b.owners(s, d), _drawn(s, d)),
    "dq_overallocated": lambda s, d: comparable(quality.overallocated_parcels(b.tenfold_owners(s, d))),
    "dq_multi_type": lambda s, d: quality.multi_type_parcels(b.owners_by_brand(s, d)),
    "dq_profile": lambda s, d: loads.parcel_profile(s, d),
    "owner_mart_after_replacement": lambda s, d: comparable(loads.marts_after_replacement(s, d, "marts.owner_daily_summary")),
    "type_mart_after_replacement": lambda s, d: comparable(loads.marts_after_replacement(s, d, "marts.land_type_daily_summary")),
    "landed_owner_rows": lambda s, d: comparable(loads.landed_owner_rows(s, d)),
}


def queries() -> dict[str, Query]:
    def configured(query: Query) -> Query:
        return lambda spark, sf_dir: query(configure(spark), sf_dir)

    return {name: configured(query) for name, query in QUERIES.items()}
