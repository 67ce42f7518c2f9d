"""The ownership file's dialect, also when a file is cut into tiny splits."""

import csv
import io
import random
from datetime import datetime
from decimal import Decimal

import pytest

from landmart.schemas import OWNER_FILE_COLUMNS
from landmart.sources import owner_csv, quoted_records
from landmart.sources.owner_csv import raw_owner_rows, read_owner_files
from landmart.sources.quoted_records import read_records
from tests.test_load_jobs import HEADER, line, put_owners


def read(spark, root, *days):
    return read_owner_files(spark, [f"{root}/{day}/Owner_Address.csv" for day in days])


def test_empty_cells_and_quotes(spark, tmp_path):
    put_owners(tmp_path, "20210526", line(
        created_date="2021-05-26 01:02:03", strap="R1", owner_name='"A ""B"", C"', city='""', lot="",
    ))
    row = read(spark, tmp_path, "20210526").first()
    assert (row.strap, row.owner_name, row.city, row.lot) == ("R1", 'A "B", C', "", None)
    assert row.created_date == datetime(2021, 5, 26, 1, 2, 3) and row.file_index == "20210526"


@pytest.mark.parametrize("spanning", [False, True])
@pytest.mark.parametrize("bad", [line(strap="x") + ",extra", "a,b,c", line(created_date="soon")])
def test_malformed_rows_raise(spark, tmp_path, bad, spanning):
    put_owners(tmp_path, "20210526", line(owner_name='"A\nB"' if spanning else "A"), bad)
    with pytest.raises(Exception):
        raw_owner_rows(read(spark, tmp_path, "20210526")).collect()


@pytest.mark.parametrize("spanning", [False, True])
def test_date_out_of_range_raises(spark, tmp_path, spanning):
    """A row must not go because of a column that nothing uses."""
    put_owners(tmp_path, "20210526", line(owner_name='"A\nB"' if spanning else "A"), line(created_date="0000-01-01"))
    with pytest.raises(Exception):
        raw_owner_rows(read(spark, tmp_path, "20210526")).collect()


def test_unterminated_quote_raises(spark, tmp_path):
    put_owners(tmp_path, "20210526", line(owner_name='"A'))
    with pytest.raises(ValueError, match="unterminated"):
        read(spark, tmp_path, "20210526")


@pytest.mark.parametrize("split", [1, 7, 700])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_quoted_line_breaks_across_splits(spark, tmp_path, newline, split, monkeypatch):
    """Random text, read in splits far smaller than a record, equals what the csv module reads."""
    rng = random.Random(7)
    pieces = ["a", "b c", ",", '""', "\n", "\r\n", "x" * 30, "é", "'", "1"]
    rows = [
        line(strap=f"R{i}", owner_name='"' + "".join(rng.choices(pieces, k=rng.randrange(8))) + '"', city=str(i))
        for i in range(200 if split > 100 else 3)
    ] + [line(strap="R", city="c", owner_name='"A\nB"')]
    put_owners(tmp_path, "20210526", *rows, newline=newline)
    put_owners(tmp_path, "20210527", line(strap="R1", owner_name="plain"))
    parsed = csv.reader(io.StringIO(newline.join([HEADER, *rows]) + newline, newline=""))
    at = OWNER_FILE_COLUMNS.index
    expected = sorted((r[at("strap")], r[at("owner_name")], r[at("city")]) for r in list(parsed)[1:])
    monkeypatch.setattr(quoted_records, "SPLIT_BYTES", split)
    df = read(spark, tmp_path, "20210526", "20210527")
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    got = df.select("strap", "owner_name", "city", "file_index").collect()
    assert sorted(tuple(r)[:3] for r in got if r.file_index == "20210526") == expected
    assert [r.owner_name for r in got if r.file_index == "20210527"] == ["plain"]


def test_one_pass_over_the_ranges(spark, tmp_path):
    """The plan reads no text but that of the ranges, and matches nothing between scans."""
    put_owners(tmp_path, "20210526", line(owner_name='"A\nB"'), line(owner_name="C"))
    text = read(spark, tmp_path, "20210526")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in text and "Join" not in text and "Window" not in text and text.count("BatchScan") == 1


def test_both_ways_read_a_plain_file_alike(spark, tmp_path):
    put_owners(tmp_path, "20210526", line(strap="R1", city='""'), "", line(strap="R2", owner_name='"a, ""b"""'), newline="\r\n")
    path = [f"{tmp_path}/20210526/Owner_Address.csv"]
    order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert order(owner_csv._read_plain(spark, path)) == order(owner_csv._parsed(read_records(spark, path)))


def test_record_without_an_end_raises(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted_records, "RECORD_BYTES", 50)
    monkeypatch.setattr(quoted_records, "STEP", 20)
    put_owners(tmp_path, "20210526", line(owner_name='"' + "x\n" * 200 + '"'))
    data = (tmp_path / "20210526" / "Owner_Address.csv").read_bytes()
    with pytest.raises(ValueError, match="longer than"):
        list(quoted_records.records_in(lambda n, at: data[at:at + n], 0, 400, len(data), False, "file"))


def test_sums_of_ranges_tell_what_the_whole_tells(monkeypatch):
    """Parity before each range, spanning lines and open quotes, against the text as a whole, for any cut."""
    rng = random.Random(11)
    for _ in range(2000):
        data = "".join(rng.choices(['"', "\n", "a", "é"], [2, 2, 3, 1], k=rng.randrange(0, 30))).encode()
        step = rng.choice([1, 2, 3, 5, 100])
        monkeypatch.setattr(quoted_records, "STEP", rng.choice([1, 2, 4, 50]))
        read = lambda n, at: data[at:at + n]  # noqa: B023,E731
        cuts = range(0, len(data), step)
        before, spans, odd = quoted_records.parities(quoted_records.summed(read, a, min(a + step, len(data))) for a in cuts)
        assert before == [data[:a].count(b'"') % 2 == 1 for a in cuts]
        assert spans == any(x.count(b'"') % 2 for x in data.split(b"\n")) and odd == (data.count(b'"') % 2 == 1)


def test_one_range_per_task_and_two_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted_records, "SPLIT_BYTES", 64)
    put_owners(tmp_path, "20210526", *[line(strap=f"R{i}", owner_name='"A\nB"') for i in range(40)])
    path = f"{tmp_path}/20210526/Owner_Address.csv"
    size = (tmp_path / "20210526" / "Owner_Address.csv").stat().st_size
    assert read_records(spark, [path]).rdd.getNumPartitions() == -(-size // 64)
    opened = []
    monkeypatch.setattr(quoted_records, "scanned", lambda *a, f=quoted_records.scanned: opened.append(a) or f(*a))
    monkeypatch.setattr(owner_csv, "scanned", quoted_records.scanned)
    assert read(spark, tmp_path, "20210526").count() == 40 and len(opened) == 1


def test_raw_rows(spark, tmp_path):
    twin = dict(
        strap="R1", folio="P1", lot="7", street_num="12", street_prefix="N", street="MAIN", street_suffix="ST",
        street_unit="4", city="X", owner_name="ANN", pct_own="0.3335", account_type="RESIDENTIAL", status_cd="A",
    )
    put_owners(
        tmp_path, "20210526", line(**twin, mail_to="one"), line(**twin, mail_to="two"),
        line(**{**twin, "pct_own": "0.3336"}), line(**{**twin, "pct_own": "0.4"}),
    )
    rows = raw_owner_rows(read(spark, tmp_path, "20210526")).orderBy("pct_own").collect()
    assert [r.pct_own for r in rows] == [Decimal("0.334"), Decimal("0.400")]
    first = rows[0].asDict()
    del first["pct_own"]
    assert first == dict(
        account_id="R1", parcel_id="P1", lot="7", is_real_property=True, status_cd="A", address="12 N MAIN ST",
        address_unit="4", city="X", owner_name="ANN", account_type="RESIDENTIAL", file_index="20210526",
    )
