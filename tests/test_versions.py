"""Versions of raw tables and marts: failures at any point, switches at once, and rebuilds from a day on."""

import random

import pytest
from pyspark.sql import functions as F

from landmart.plans import jobs, marts, tables
from landmart.plans.tables import MART_TABLES, TABLES, create_tables, drop_tables, versions
from landmart.sources.parcel_features import features_from_wkt
from tests.test_load_jobs import owner, parcels_of, places, put_owners, put_parcels, square  # noqa: F401

CELL = "POLYGON ((-105 40, -104.999 40, -104.999 40.001, -105 40.001, -105 40))"


def features(spark, *rows):
    columns = "object_id string, parcel_no string, shape_area string, shape_len string, wkt string, file_index string"
    return features_from_wkt(spark.createDataFrame([("1", p, "1", "1", w, d) for p, w, d in rows], columns))


def state(spark):
    """What readers see of parcels and areas."""
    return [sorted(tuple(r) for r in spark.table(f"raw.{x}").select("parcel_id", "file_index", "area_m2").collect()) for x in ("parcels", "parcel_areas")]


def boom(*_, **__):
    raise OSError("killed")


def test_a_bad_shape_leaves_parcels_and_areas(spark, places):  # noqa: F811
    create_tables(spark, places[1])
    jobs.load_features(spark, features(spark, ("P1", CELL, "20210525")))
    before = state(spark)
    with pytest.raises(Exception):
        jobs.load_features(spark, features(spark, ("P2", CELL, "20210525"), ("P3", "POINT (1 2)", "20210525")), overwrite=True)
    assert state(spark) == before and len(before[1]) == 1


@pytest.mark.parametrize("step", ["read_version", "commit", "_append", "_show", "_add_partitions"])
def test_a_failure_at_any_step_leaves_parcels_and_areas(spark, places, monkeypatch, step):  # noqa: F811
    """Killed while areas are summed, before the commit, at its file, and after it, before the switch."""
    create_tables(spark, places[1])
    jobs.load_features(spark, features(spark, ("P1", CELL, "20210525"), ("P1", CELL, "20210526")))
    before = state(spark)
    new = features(spark, ("P2", CELL, "20210525"), ("P2", CELL, "20210525"), ("P3", CELL, "20210527"))
    with monkeypatch.context() as m:
        m.setattr(jobs if hasattr(jobs, step) else tables, step, boom)
        with pytest.raises(OSError):
            jobs.load_features(spark, new, overwrite=True)
    assert state(spark) == before
    create_tables(spark, places[1])  # the next run
    if step == "_show":  # the commit was final
        assert parcels_of(spark, "20210525") == ["P2", "P2"] and [r[0] for r in state(spark)[1]] == ["P1", "P2", "P3"]
    else:
        assert state(spark) == before
        jobs.load_features(spark, new, overwrite=True)
    assert parcels_of(spark, "20210526") == ["P1"] and parcels_of(spark, "20210527") == ["P3"]


def test_no_data_is_renamed_and_old_files_go_later(spark, places, tmp_path):  # noqa: F811
    create_tables(spark, places[1])
    files = lambda: {p for p in (tmp_path / "warehouse" / "raw" / "parcels").rglob("*.parquet")}
    jobs.load_features(spark, features(spark, ("P1", CELL, "20210525")))
    first = files()
    reader = spark.table("raw.parcels").select("parcel_id")
    reader.collect()
    jobs.load_features(spark, features(spark, ("P2", CELL, "20210525")), overwrite=True)
    assert first < files()  # still there for those who read them
    jobs.load_features(spark, features(spark, ("P3", CELL, "20210526")))
    assert not first & files() and len(files()) == 2
    assert [r[0] for r in state(spark)[0]] == ["P2", "P3"]


def test_all_partitions_change_in_few_statements(spark, places, monkeypatch):  # noqa: F811
    create_tables(spark, places[1])
    days = [f"202105{d:02}" for d in range(1, 29)]
    jobs.load_features(spark, features(spark, *[("P1", CELL, d) for d in days]))
    said = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: said.append(text) or sql(self, text, *a, **b))
    jobs.load_features(spark, features(spark, *[("P2", CELL, d) for d in days[:20]]), overwrite=True)
    assert sum(x.startswith(("ALTER", "CREATE", "INSERT")) for x in said) <= 5
    assert {r[0] for r in state(spark)[0] if r[1] in days[:20]} == {"P2"}


def test_odd_snapshot_names(spark, places):  # noqa: F811
    create_tables(spark, places[1])
    odd = ["a'b", "c\\d", "e/f=g", "h %20"]
    jobs.load_features(spark, features(spark, *[("P1", CELL, x) for x in odd]))
    assert sorted(r[1] for r in state(spark)[1]) == sorted(odd)
    drop_tables(spark)
    create_tables(spark, places[1])
    assert sorted(r[1] for r in state(spark)[0]) == sorted(odd)


def in_full(spark):
    raw = [spark.table(f"raw.{x}") for x in ("owners", "parcels", "parcel_areas")]
    return {"marts.owner_daily_summary": marts.owner_daily_summary(*raw), "marts.land_type_daily_summary": marts.land_type_daily_summary(*raw)}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put_day(landing, rng, day):
    names = rng.sample(["ANN", "BOB", "CY", "DEE", "EVE"], rng.randrange(0, 5))
    kinds = ["RESIDENTIAL", "COMMERCIAL", "EXEMPT"]
    put_owners(landing, day, *[owner(n, f"P{rng.randrange(3)}", rng.choice(["R1", "R2", "M1"]), rng.choice(["1", "0.3", ""]), rng.choice(kinds)) for n in names for _ in range(2)])
    put_parcels(landing, day, *[((k, f"P{k}", 1, 1), [square(-105 + k, 40, 0.001 * rng.randrange(1, 4))]) for k in range(3) if rng.random() < 0.8])


@pytest.mark.parametrize("seed", [1, 2])
def test_rebuilds_from_a_day_on_equal_full_ones(spark, places, seed):  # noqa: F811
    """Snapshots in any order, replaced and emptied ones."""
    landing, warehouse = places
    rng = random.Random(seed)
    days = [f"2021052{k}" for k in range(5)]
    create_tables(spark, warehouse)
    for turn in range(4):
        for day in rng.sample(days, rng.choice([1, 1, 2])):
            put_day(landing, rng, day)
            jobs.run(spark, landing, warehouse, f"2021-05-{day[6:]}", overwrite=True)
        jobs.rebuild(spark)
        for name, full in in_full(spark).items():
            assert rows(spark.table(name)) == rows(full), (turn, name)
        assert jobs.rebuild(spark) is None  # nothing to do
    before = {name: rows(spark.table(name)) for name in MART_TABLES}
    assert jobs.rebuild(spark, full=True) == min(versions(spark)[tables.SOURCES])
    assert {name: rows(spark.table(name)) for name in MART_TABLES} == before


def loaded(spark, places, n):  # noqa: F811
    landing, warehouse = places
    for k in range(n):
        put_owners(landing, f"2021052{k}", owner("ANN"), owner("BOB", "P2"))
        put_parcels(landing, f"2021052{k}", ((1, "P1", 1, 1), [square(-105, 40)]), ((2, "P2", 1, 1), [square(-105, 41, 0.001 * (k + 1))]))
    jobs.run(spark, landing, warehouse, "all", rebuild_marts=True)


def test_a_new_day_reads_no_older_day(spark, places):  # noqa: F811
    loaded(spark, places, 4)
    before = versions(spark)["marts.owner_daily_summary"]
    put_owners(places[0], "20210524", owner("ANN"))
    put_parcels(places[0], "20210524", ((1, "P1", 1, 1), [square(-105, 40)]))
    jobs.run(spark, places[0], places[1], "all")
    for name in MART_TABLES:
        days = jobs.days_from(spark, name, "20210524", jobs.rows_before(spark, name, "20210524"))
        files = {f.split("/version=")[0].rsplit("/", 1)[1] + f.split("file_index=")[1][:8] for f in days.inputFiles() if "file_index=" in f}
        assert {x[-8:] for x in files} == {"20210524"}
        assert not [f for f in days.inputFiles() if "report_date=" in f]
    assert jobs.rebuild(spark) == "20210524"
    after = versions(spark)["marts.owner_daily_summary"]
    assert {d: v for d, v in after.items() if d < "2021-05-24"} == before and "2021-05-24" in after


def test_a_replaced_day_leaves_earlier_ones(spark, places):  # noqa: F811
    loaded(spark, places, 5)
    before = versions(spark)["marts.land_type_daily_summary"]
    put_owners(places[0], "20210522", owner("EVE"))
    jobs.run(spark, places[0], places[1], "2021-05-22", overwrite=True)
    assert jobs.rebuild(spark) == "20210522"
    after = versions(spark)["marts.land_type_daily_summary"]
    assert {d for d in after if after[d] == before[d]} == {"2021-05-20", "2021-05-21"}
    for name, full in in_full(spark).items():
        assert rows(spark.table(name)) == rows(full)


def test_only_changed_days_are_computed_again(spark, places, monkeypatch):  # noqa: F811
    """Of the other days from the first changed one on, the mart has the holdings; their change is computed anew."""
    loaded(spark, places, 5)
    for day, who in (("20210521", owner("ANN", "P2", "R1", "0.3")), ("20210523", owner("EVE", "P2"))):
        put_owners(places[0], day, who)
        jobs.run(spark, places[0], places[1], f"2021-05-{day[6:]}", overwrite=True)
    old = {name: rows(spark.table(name)) for name in MART_TABLES}
    read, write = {}, jobs.write_version
    with monkeypatch.context() as m:
        m.setattr(jobs, "write_version", lambda df, name, *a, **b: read.update({name: df.inputFiles()}) or write(df, name, *a, **b))
        assert jobs.rebuild(spark) == "20210521"
    for name, full in in_full(spark).items():
        assert {f.split("file_index=")[1][:8] for f in read[name] if "file_index=" in f} == {"20210521", "20210523"}
        # the last rows before the first changed day, and the days that stay
        assert {f.split("report_date=")[1][:10] for f in read[name] if "report_date=" in f} == {f"2021-05-2{k}" for k in (0, 2, 4)}
        found = rows(spark.table(name))
        assert found == rows(full)
        # the day after a changed one has another change
        day = [[r for r in x if str(r[0]) == "2021-05-22"] for x in (old[name], found)]
        assert len(day[0]) == len(day[1]) and day[0] != day[1]
    assert jobs.rebuild(spark, full=True) == "20210520"
    for name, full in in_full(spark).items():
        assert rows(spark.table(name)) == rows(full)


@pytest.mark.parametrize("step", ["_append", "_show"])
def test_both_marts_switch_together(spark, places, monkeypatch, step):  # noqa: F811
    loaded(spark, places, 2)
    before = [rows(spark.table(x)) for x in MART_TABLES]
    put_owners(places[0], "20210521", owner("EVE", "P1", "R1", "0.5"))
    jobs.run(spark, places[0], places[1], "2021-05-21", overwrite=True)
    with monkeypatch.context() as m:
        m.setattr(tables, step, boom)
        with pytest.raises(OSError):
            jobs.rebuild(spark)
    assert [rows(spark.table(x)) for x in MART_TABLES] == before
    create_tables(spark, places[1])
    jobs.rebuild(spark)
    assert [rows(spark.table(x)) for x in MART_TABLES] == [rows(x) for x in in_full(spark).values()] != before


def test_tables_read_by_name_have_the_published_columns(spark, places):  # noqa: F811
    create_tables(spark, places[1])
    for name, layout in TABLES.items():
        assert spark.table(name).columns == layout.names and [f.dataType for f in spark.table(name).schema] == [f.dataType for f in layout]


def test_last_rows_are_one_per_key(spark, places):  # noqa: F811
    loaded(spark, places, 3)
    put_owners(places[0], "20210523", owner("ANN"))
    jobs.run(spark, places[0], places[1], "2021-05-23", rebuild_marts=True)
    last = spark.table("marts.owner_last")
    assert sorted((r.owner_name, str(r.report_date)) for r in last.collect()) == [("ANN", "2021-05-22"), ("BOB", "2021-05-22")]
    assert last.filter(F.col("part") != "20210523").isEmpty()
