"""One test per rule that is easy to get wrong; tiny literal inputs."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from landmart.functions.attributes import assemble_address, in_types, is_real_account, report_date, stake
from landmart.constants import ACRES_PER_M2, COMMERCIAL_TYPES, RESIDENTIAL_TYPES
from landmart.operators.areas import parcel_area
from landmart.operators.ownership import distinct_ownership, parcel_account_type
from landmart.operators.snapshots import parse_snapshot_date
from landmart.plans import analyst, marts, quality
from landmart.schemas import LAND_TYPE_DAILY_SUMMARY, OWNER_DAILY_SUMMARY

OWNERS = (
    "account_id string, parcel_id string, is_real_property boolean, owner_name string, "
    "pct_own decimal(10,3), account_type string, file_index string"
)
PARCELS = "parcel_id string, area_m2 double, file_index string"
D1, D2, D3 = "20210524", "20210525", "20210527"


def owners(spark, *rows):
    """(owner, parcel, account, stake, type, snapshot)"""
    return spark.createDataFrame(
        [(a, p, (a or "").startswith("R"), o, None if s is None else Decimal(s), t, d) for o, p, a, s, t, d in rows],
        OWNERS,
    )


def parcels(spark, *rows):
    return spark.createDataFrame([(p, float(m) if m is not None else None, d) for p, m, d in rows], PARCELS)


def by_owner(df):
    return {(r.owner_name, r.report_date): r for r in df.collect()}


def test_layouts(spark):
    o, p = owners(spark, ("A", "1", "R1", "1", "X", D1)), parcels(spark, ("1", 5, D1))
    for df, layout in (
        (marts.owner_daily_summary(o, p), OWNER_DAILY_SUMMARY),
        (marts.land_type_daily_summary(o, p), LAND_TYPE_DAILY_SUMMARY),
    ):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in layout]


def test_real_account_prefix(spark):
    df = spark.createDataFrame([("R0001",), ("r0001",), ("M0001",), (None,)], "a string")
    assert [r[0] for r in df.select(is_real_account(F.col("a"))).collect()] == [True, False, False, False]


@pytest.mark.parametrize("parts, text", [
    ((None, None, None, None), "  "),
    (("12", None, "MAIN", None), "12 MAIN "),
    (("12", "N", "MAIN", "ST"), "12 N MAIN ST"),
    ((None, "", "MAIN", "ST"), "  MAIN ST"),
])
def test_address_keeps_blanks(spark, parts, text):
    df = spark.createDataFrame([parts], "n string, p string, s string, x string")
    assert df.select(assemble_address(F.col("n"), F.col("p"), F.col("s"), F.col("x"))).first()[0] == text


def test_stake_rounds_half_up_and_raises(spark):
    good = spark.createDataFrame([("0.3335",), (" 0.5 ",), (None,)], "t string")
    assert [r[0] for r in good.select(stake(F.col("t"))).collect()] == [Decimal("0.334"), Decimal("0.500"), None]
    for text in ("abc", "", "NaN"):
        with pytest.raises(Exception):
            spark.createDataFrame([(text,)], "t string").select(stake(F.col("t"))).collect()


def test_report_date(spark):
    df = spark.createDataFrame([("20210526",)], "d string")
    assert df.select(report_date(F.col("d"))).first()[0] == date(2021, 5, 26)
    with pytest.raises(Exception):
        spark.createDataFrame([("2021526",)], "d string").select(report_date(F.col("d"))).collect()


def test_type_flags(spark):
    df = spark.createDataFrame([("MIXED USE",), ("BED & BREAK",), ("RESIDENTIAL",), ("EXEMPT",), (None,)], "t string")
    flags = df.select(in_types(F.col("t"), RESIDENTIAL_TYPES), in_types(F.col("t"), COMMERCIAL_TYPES)).collect()
    assert [tuple(r) for r in flags] == [(True, True), (False, True), (True, False), (False, False), (False, False)]


def test_ownership_ignores_the_account(spark):
    o = owners(
        spark, ("A", "1", "R1", "1", "X", D1), ("A", "1", "R2", "1", "X", D1), ("A", "1", "R2", "0.5", "X", D1)
    )
    assert distinct_ownership(o).count() == 2


def test_features_of_a_parcel_add_up_with_duplicates(spark):
    p = parcels(spark, ("1", 5, D1), ("1", 5, D1), ("1", 7, D2), ("2", 1, D1))
    got = {(r.parcel_id, r.file_index): r.area_m2 for r in parcel_area(p).collect()}
    assert got == {("1", D1): 10.0, ("1", D2): 7.0, ("2", D1): 1.0}


def test_joint_owners_get_full_credit_and_missing_stake_adds_nothing(spark):
    o = owners(
        spark,
        ("A", "1", "R1", "1", "RESIDENTIAL", D1), ("B", "1", "R1", "1", "RESIDENTIAL", D1),
        ("C", "1", "R1", None, "RESIDENTIAL", D1),
        ("D", "1", "R1", "1", "EXEMPT", D1), ("D", "1", "R2", "0.5", "EXEMPT", D1),
    )
    got = by_owner(marts.owner_daily_summary(o, parcels(spark, ("1", 100, D1))))
    day = date(2021, 5, 24)
    for name in "AB":
        assert got[name, day].total_residential_land_area_owned_m2 == 100
    assert got["A", day].total_real_property_land_area_owned_acres == Decimal("0.0247110000")
    c = got["C", day]
    assert c.total_real_property_owned == 1 and c.total_real_property_land_area_owned_m2 is None
    assert c.total_residential_land_area_owned_m2 == 0 and c.avg_real_property_investment_stake is None
    d = got["D", day]
    assert d.total_real_property_owned == 1 and d.total_real_property_land_area_owned_m2 == 150
    assert d.avg_real_property_investment_stake == Decimal("0.75")
    assert d.total_residential_parcels_owned == 0


def test_owner_of_buildings_only(spark):
    o = owners(
        spark, ("A", "1", "M1", "0.4", "RESIDENTIAL", D1), ("A", "9", "M2", "1", "RESIDENTIAL", D1),
        ("B", "9", "R2", "1", "RESIDENTIAL", D1),
    )
    got = by_owner(marts.owner_daily_summary(o, parcels(spark, ("1", 100, D1), ("2", 1, D1))))
    assert len(got) == 1  # owners of unknown parcels vanish, also with buildings
    a = got["A", date(2021, 5, 24)]
    assert (a.total_real_property_owned, a.total_building_property_owned) == (0, 1)
    assert a.total_real_property_land_area_owned_m2 is None and a.total_residential_land_area_owned_m2 == 0
    assert a.avg_real_property_investment_stake is None
    assert a.avg_building_property_investment_stake == Decimal("0.4")
    assert a.real_property_gain_loss == 0 and a.pct_land_area_gain_loss is None


def test_mean_stake_has_ten_places(spark):
    o = owners(spark, *[("A", str(i), "R1", "0.5" if i else "-0.15", "X", D1) for i in range(7)])
    p = parcels(spark, *[(str(i), 1, D1) for i in range(7)])
    row = marts.owner_daily_summary(o, p).first()
    assert row.avg_real_property_investment_stake == Decimal("0.4071428571")


def test_changes_follow_rows_not_days(spark):
    o = owners(
        spark,
        ("A", "1", "R1", "1", "X", D1), ("A", "1", "R1", "1", "X", D3), ("A", "2", "R2", "1", "X", D3),
        ("Z", "3", "R1", "1", "X", D1), ("Z", "3", "R1", "1", "X", D2), ("B", "2", "R1", "1", "X", D2),
    )
    p = parcels(
        spark, ("1", 100, D1), ("2", 50, D2), ("1", 100, D3), ("2", 100, D3), ("3", 0, D1), ("3", 10, D2)
    )
    got = by_owner(marts.owner_daily_summary(o, p))
    d1, d2, d3 = date(2021, 5, 24), date(2021, 5, 25), date(2021, 5, 27)
    assert ("A", d2) not in got
    assert got["A", d1].pct_land_area_gain_loss == 1 and got["A", d1].real_property_gain_loss == 1
    assert got["A", d3].real_property_gain_loss == 1
    assert got["A", d3].pct_land_area_gain_loss == Decimal("0.5")
    assert got["Z", d1].pct_land_area_gain_loss is None
    assert got["Z", d2].pct_land_area_gain_loss == 1


def test_missing_names_and_types_form_groups(spark):
    o = owners(
        spark,
        (None, "1", "R1", "1", None, D1), (None, "2", "R1", "1", None, D1), (None, "1", "R1", "1", None, D2),
    )
    p = parcels(spark, ("1", 10, D1), ("2", 10, D1), ("1", 10, D2))
    got = by_owner(marts.owner_daily_summary(o, p))
    assert got[None, date(2021, 5, 25)].real_property_gain_loss == -1
    kinds = {r.report_date: r for r in marts.land_type_daily_summary(o, p).collect()}
    first = kinds[date(2021, 5, 24)]
    assert (first.account_type, first.is_residential, first.is_commercial) == (None, False, False)
    assert (first.total_parcels, first.total_owners) == (2, 0)
    assert kinds[date(2021, 5, 25)].total_parcel_gain_loss == -1


def test_land_types_count_a_parcel_under_each_type(spark):
    o = owners(
        spark,
        ("A", "1", "R1", "1", "RESIDENTIAL", D1), ("B", "1", "R1", "1", "RESIDENTIAL", D1),
        ("A", "1", "R2", "1", "EXEMPT", D1), ("A", "2", "R3", "1", "RESIDENTIAL", D1),
        ("A", "2", "R4", "0.5", "RESIDENTIAL", D1), ("A", "3", "M1", "1", "RESIDENTIAL", D1),
    )
    p = parcels(spark, ("1", 60, D1), ("2", 30, D1), ("3", 500, D1), ("4", 7, D1))
    got = {r.account_type: r for r in marts.land_type_daily_summary(o, p).collect()}
    home = got["RESIDENTIAL"]
    assert (home.total_parcels, home.total_owners, home.land_area_m2) == (2, 3, 90)
    assert home.pct_total_land_area == Decimal("0.6") and got["EXEMPT"].pct_total_land_area == Decimal("0.4")
    assert sum(r.pct_total_land_area for r in got.values()) == 1


def test_question_one_raw_equals_mart(spark):
    o = owners(
        spark,
        ("A", "1", "R1", "1", "RESIDENTIAL", D1), ("B", "1", "R2", "1", "MIXED USE", D1),
        ("A", "2", "R3", "1", "EXEMPT", D1), ("A", "2", "M3", "1", "RESIDENTIAL", D1),
        ("A", "2", "R3", "1", "RESIDENTIAL", D2),
    )
    p = parcels(spark, ("1", 60, D1), ("1", 40, D1), ("2", 30, D1), ("2", 30, D2))
    raw = analyst.residential_acres_raw(o, p, D1).first()[0]
    mart = analyst.residential_acres_mart(marts.land_type_daily_summary(o, p), date(2021, 5, 24)).first()[0]
    assert raw == pytest.approx(200 * ACRES_PER_M2) and float(mart) == pytest.approx(raw)


def test_question_two_raw_reads_every_snapshot_and_missing_stakes(spark):
    o = owners(
        spark,
        ("A", "1", "R1", "0.5", "RESIDENTIAL", D1), ("A", "1", "R1", "0.25", "RESIDENTIAL", D2),
        ("B", "1", "R1", None, "APARTMENT", D1), ("B", "1", "R1", "1", "RESIDENTIAL", D1),
    )
    p = parcels(spark, ("1", 100, D1), ("1", 900, D2))
    everything = analyst.owners_by_residential_raw(o, p, D1).collect()
    assert [(r.owner_name, round(r.total_owned_residential / ACRES_PER_M2, 6)) for r in everything] == [
        ("B", 100.0), ("A", 75.0)
    ]
    one = analyst.owners_by_residential_raw(o, p, D1, owner_snapshot=D1).collect()
    assert [round(r.total_owned_residential / ACRES_PER_M2, 6) for r in one] == [100.0, 50.0]


def test_question_three_matches_parcels_of_any_snapshot(spark):
    o = owners(
        spark, ("A", "1", "R1", "1", "X", D1), ("A", "2", "R1", "1", "X", D1), ("A", "3", "R1", "1", "X", D1),
        ("B", "1", "R1", "1", "X", D1), ("B", "1", "M1", "1", "X", D1),
    )
    p = parcels(spark, ("1", 1, D1), ("1", 1, D2), ("2", 1, D2))
    got = [tuple(r) for r in analyst.owners_by_property_count_raw(o, p, D1).collect()]
    assert got == [("A", 2), ("B", 1)]
    mart = analyst.owners_by_property_count_mart(marts.owner_daily_summary(o, p), date(2021, 5, 24), top=1)
    assert [tuple(r) for r in mart.collect()] == [("A", 1)]


def test_missing_measures_sort_first(spark):
    o = owners(spark, ("A", "1", "R1", "1", "RESIDENTIAL", D1), ("B", "2", "R1", "1", "RESIDENTIAL", D1))
    p = parcels(spark, ("1", 10, D1), ("2", None, D1))
    assert [r[0] for r in analyst.owners_by_residential_raw(o, p, D1).collect()] == ["B", "A"]


def test_parcel_account_type_ignores_missing_names(spark):
    o = owners(
        spark, ("A", "1", "R1", "1", "X", D1), (None, "1", "R1", "1", "X", D1), ("B", "1", "M1", "1", "X", D1)
    )
    assert [r.owners for r in parcel_account_type(o).collect()] == [1]


def test_quality_reports(spark):
    o = owners(
        spark,
        ("A", "1", "R1", "1", "X", D1), ("B", "1", "R1", "0.5", "Y", D1), ("B", None, "R1", "1", "Y", D1),
        ("C", "8", "R1", "1", "X", D1), ("C", "2", "R1", "1", "X", D2), ("D", "9", "R1", "1", "RESIDENTIAL", D2),
        ("D", "9", "R2", "1", "NATURAL RESRC", D2),  # one owner holding all of a parcel of two types
    )
    p = parcels(spark, ("1", 1, D1), ("1", 2, D1), ("2", 1, D1), ("2", 1, D2), ("9", 1, D2))
    assert [tuple(r) for r in quality.multi_feature_parcels(p).collect()] == [(D1, "1", 2)]
    unknown = {(r.file_index, r.parcel_id): r.owner_rows for r in quality.unknown_parcels(o, p).collect()}
    assert unknown == {(D1, "8"): 1, (D1, None): 1}
    assert [tuple(r) for r in quality.unowned_parcels(o, p).collect()] == [(D1, "2")]
    assert [(r.parcel_id, r.total_stake) for r in quality.overallocated_parcels(o).collect()] == [("1", Decimal("1.5"))]
    assert [(r.parcel_id, r.account_types) for r in quality.multi_type_parcels(o).orderBy("parcel_id").collect()] == [("1", 2), ("9", 2)]


def test_snapshot_dates():
    assert parse_snapshot_date("2021-05-26") == "20210526"
    for text in ("2021-5-26", "20210526", "2021-02-30", "latest", ""):
        with pytest.raises(ValueError):
            parse_snapshot_date(text)
