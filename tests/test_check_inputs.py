"""Inputs that the registered queries build from the given tables."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

from checks import bindings, loads
from checks.registry import queries


def given(spark, folder):
    """Parts, suppliers and lines; some lines differ by the date within a year alone, some come twice."""
    parts = [(k, f"part {k}", f"Brand#{k}", ("MEDIUM", "SMALL", "PROMO", "ECONOMY", None)[k % 5], k % 11 + 1) for k in range(1, 41)]
    lines = [
        (k, k % 40 + 1, k % 3 + 1, k % 4, "RNA"[k % 3], "OF"[k % 2], k % 5 / 100, datetime(1992 + k % 2, 1 + k // 60 % 12, 5))
        for k in range(360) for _ in range(1 + (k % 50 == 0))]
    for name, rows, schema in (
        ("part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        ("supplier", [(k, f"Supplier {k}") for k in range(1, 4)], "s_suppkey long, s_name string"),
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, "
         "l_discount double, l_shipdate timestamp"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_a_large_year_lands_in_several_files(spark, tmp_path, monkeypatch):
    folder = given(spark, tmp_path / "tables")
    found = {}
    for size in (1_000_000, 20):
        monkeypatch.setattr(loads, "FILE_ROWS", size)
        base = tmp_path / f"run-{size}"
        monkeypatch.setattr(loads, "_folder", lambda spark, name, base=base: f"{base}/{name}")
        rows = sorted(map(str, queries()["landed_owner_rows"](spark, folder).collect()))
        found[size] = rows, len(list((base / "landing").glob("*/Owner_Address.csv")))
    assert found[1_000_000][0] == found[20][0] and len(found[20][0]) == len(set(found[20][0]))
    assert found[1_000_000][1] == 2 and found[20][1] > 12


def test_files_land_and_are_loaded_in_rounds(spark, tmp_path, monkeypatch):
    """A round's files go when the next ones land; the rows are those of one round."""
    folder = given(spark, tmp_path / "tables")
    found, landed, run = {}, [], loads.jobs.run
    monkeypatch.setattr(loads, "FILE_ROWS", 20)

    def noted(spark, landing, warehouse, snapshots, **more):
        landed.append(sorted(x.name for x in Path(landing).glob("[0-9]*")))
        return run(spark, landing, warehouse, snapshots, **more)

    monkeypatch.setattr(loads.jobs, "run", noted)
    for size in (1_000_000, 50):
        monkeypatch.setattr(loads, "ROUND_ROWS", size)
        landed.clear()
        base = tmp_path / f"run-{size}"
        monkeypatch.setattr(loads, "_folder", lambda spark, name, base=base: f"{base}/{name}")
        rows = sorted(map(str, queries()["landed_owner_rows"](spark, folder).collect()))
        found[size] = rows, [list(x) for x in landed]
    assert found[1_000_000][0] == found[50][0]
    (whole, _), parts = found[1_000_000][1], found[50][1][:-1]
    assert len(parts) >= 5 and sum(parts, []) == whole and max(map(len, parts)) <= 4


def test_years_are_dealt_to_rounds(monkeypatch):
    monkeypatch.setattr(loads, "FILE_ROWS", 10)
    monkeypatch.setattr(loads, "ROUND_ROWS", 40)
    dealt = loads._rounds({"1993": 55, "1992": 15, "1994": 5})
    assert dealt == [{"1992": range(0, 2), "1993": range(0, 3)}, {"1993": range(3, 6), "1994": range(0, 1)}]
    assert loads._rounds({}) == []
    assert len(loads._rounds({str(1900 + k): 1000 for k in range(100)})) <= loads.ROUNDS + 1


def test_numbers_of_a_geometry_are_made_once(spark, tmp_path):
    folder = given(spark, tmp_path / "tables")
    made = bindings.parcel_wkb(spark, folder)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bin(") <= 11 and plan.count("hex(") < 40
    by = {r.parcel_id: bytes(r.wkb) for r in made.collect()}
    assert by["5"][:13].hex() == "0000000003" "00000002" "00000005"  # big end first: a polygon, two rings, five vertices
