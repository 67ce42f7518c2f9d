"""Marts and analyst questions on random rows full of gaps and duplicates, against plain SQL."""

import random
from decimal import Decimal

import duckdb
import pytest

from checks import oracle, registry
from checks.bindings import SNAPSHOT
from checks.compare import rows
from landmart.plans import analyst, marts

OWNERS = (
    "account_id string, parcel_id string, is_real_property boolean, owner_name string, "
    "pct_own decimal(10,3), account_type string, file_index string"
)
PARCELS = "parcel_id string, area_m2 decimal(12,2), file_index string"
TYPES = ["RESIDENTIAL", "APARTMENT", "MIXED USE", "COMMERCIAL", "BED & BREAK", "EXEMPT", None]
DAYS = ["19980228", SNAPSHOT, "19980302", "19980305"]
STAKES = [None, "0", "0.25", "0.333", "0.5", "1", "1"]

QUERIES = {
    "owner_daily_summary": marts.owner_daily_summary,
    "land_type_daily_summary": marts.land_type_daily_summary,
    "residential_acres_raw": lambda o, p: analyst.residential_acres_raw(o, p, SNAPSHOT),
    "owners_by_residential_raw": lambda o, p: analyst.owners_by_residential_raw(o, p, SNAPSHOT),
    "owners_by_property_count_raw": lambda o, p: analyst.owners_by_property_count_raw(o, p, SNAPSHOT),
}


def random_rows(seed):
    rng = random.Random(seed)
    ids = [None, ""] + [str(i) for i in range(8)]
    owners = [
        (
            "1", rng.choice(ids), rng.random() < 0.7, rng.choice([None, "A", "B", "C", "D"]),
            rng.choice(STAKES), rng.choice(TYPES), rng.choice(DAYS),
        )
        for _ in range(rng.choice([0, 5, 400]))
    ]
    parcels = [
        (rng.choice(ids), rng.choice(["0", "0", "1", "2.5", "40", "3000"]), rng.choice(DAYS))
        for _ in range(rng.choice([3, 60]))
    ]
    return owners, parcels


def expected(name, owners, parcels):
    con = duckdb.connect()
    con.execute(
        "CREATE TABLE owners (account_id VARCHAR, parcel_id VARCHAR, is_real_property BOOLEAN, owner_name VARCHAR, "
        "pct_own DECIMAL(10,3), account_type VARCHAR, file_index VARCHAR)"
    )
    con.execute("CREATE TABLE parcels (parcel_id VARCHAR, area_m2 DECIMAL(12,2), file_index VARCHAR)")
    for table, content in (("owners", owners), ("parcels", parcels)):
        if content:
            con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(content[0]))})", content)
    sql = oracle.ORACLE[name].replace(oracle.RAW + ",", "WITH").replace(oracle.RAW, "")
    result = con.execute(sql)
    return rows([c[0] for c in result.description], result.fetchall())


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("name", QUERIES)
def test_against_sql(spark, name, seed):
    owners, parcels = random_rows(seed)
    typed = [(a, p, r, o, None if s is None else Decimal(s), t, d) for a, p, r, o, s, t, d in owners]
    o = spark.createDataFrame(typed, OWNERS)
    p = spark.createDataFrame([(i, Decimal(m), d) for i, m, d in parcels], PARCELS)
    df = registry.comparable(QUERIES[name](o, p))
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == expected(name, owners, parcels)
