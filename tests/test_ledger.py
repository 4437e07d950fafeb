"""What has landed against what was planned; records that are not of their header's form."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from skyground.plans import ledger, requests
from skyground.schemas import RAW_DETECTIONS
from skyground.sources import feeds, landed

D = date(2024, 3, 1)


def day(n):
    return D + timedelta(days=n)


def planned(spark, *spans):
    rows = [(r, p, day(a), day(b)) for r, p, a, b in spans]
    days = spark.createDataFrame(rows, "region string, product string, first_day date, last_day date")
    return requests.date_chunks(days, "first_day", "last_day")


def found(df):
    return sorted((r.region, r["product"], (r.first_day - D).days, (r.last_day - D).days, r.days)
                  for r in df.collect())


def put_file(root, region, product, start, days, text="x\n"):
    folder = root / f"region={region}" / f"product={product}" / f"chunk_start={start}" / f"chunk_days={days}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"f{len(list(folder.iterdir()))}.csv").write_text(text)


def test_files_are_listed_by_their_paths(spark, tmp_path):
    put_file(tmp_path, "A%20B", "p", day(0), 5)
    put_file(tmp_path, "A%20B", "p", day(0), 5)
    put_file(tmp_path, "A%20B", "p", day(5), 5, "")  # a pull that left nothing but a name
    put_file(tmp_path, "C", "p", "no-day", 5)
    put_file(tmp_path, "C", "p", day(5), "many")
    (tmp_path / "stray.csv").write_text("x\n")
    rows = ledger.file_ledger(spark, str(tmp_path)).collect()
    assert [(r.region, r["product"], r.chunk_start, r.chunk_days, r.files, r.size) for r in rows] == [
        ("A B", "p", day(0), 5, 2, 4)]


def test_missing_days_as_ranges(spark, tmp_path):
    """A failed chunk in the middle, an empty answer, days that only rows have, a product that never came."""
    plan = planned(spark, ("A", "p", 0, 22), ("B", "p", 0, 4), ("B", "q", 0, 11))
    put_file(tmp_path, "A", "p", day(0), 5)
    put_file(tmp_path, "A", "p", day(15), 5, "only,a,header\n")
    put_file(tmp_path, "B", "p", day(0), 5)
    put_file(tmp_path, "B", "q", day(0), 5, "")
    rows = spark.createDataFrame(
        [("A", "p", day(7))] * 3 + [("A", "p", day(8)), ("A", "p", day(99)), ("A", "p", None)],
        "region string, product string, d date")
    files, own = ledger.file_ledger(spark, str(tmp_path)), ledger.row_ledger(rows, "d")
    assert sorted((r.day, r.rows) for r in own.collect()) == [
        (day(7), 3), (day(8), 1), (day(99), 1)]
    gaps = ledger.missing_ranges(plan, files, own)
    assert found(gaps) == [("A", "p", 5, 6, 2), ("A", "p", 9, 14, 6), ("A", "p", 20, 22, 3),
                           ("B", "q", 0, 11, 12)]
    again = ledger.requests_for(gaps)
    assert sorted((r.region, (r.chunk_start - D).days, r.chunk_days) for r in again.collect()) == [
        ("A", 5, 2), ("A", 9, 5), ("A", 14, 1), ("A", 20, 3), ("B", 0, 5), ("B", 5, 5), ("B", 10, 2)]
    # when these have landed, nothing is missing
    assert ledger.missing_ranges(plan, files, own, again).count() == 0


def test_nothing_landed_and_nothing_planned(spark, tmp_path):
    plan = planned(spark, ("A", "p", 0, 6))
    assert found(ledger.missing_ranges(plan)) == [("A", "p", 0, 6, 7)]
    assert ledger.missing_ranges(plan.limit(0), ledger.days_of(plan)).count() == 0
    assert ledger.file_ledger(spark, str(tmp_path)).count() == 0


def test_overlapping_chunks_are_one_range(spark):
    chunks = spark.createDataFrame(
        [("A", "p", day(0), 5), ("A", "p", day(3), 5), ("A", "p", day(8), 0), ("A", "p", day(10), 1)],
        "region string, product string, chunk_start date, chunk_days int")
    assert found(ledger.missing_ranges(chunks)) == [("A", "p", 0, 7, 8), ("A", "p", 10, 10, 1)]


# Records

HEADER = "latitude,longitude,acq_date,acq_time,frp,satellite,confidence"
GOOD = "45.0,30.0,2024-01-05,130,2.5,N,n"


def test_malformed_records_are_told(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEADER, GOOD, GOOD + ",more", "45.0,30.0", GOOD]) + "\n")
    rows = landed.read_detection_files(spark, str(tmp_path), malformed=True)
    assert rows.columns == [*RAW_DETECTIONS.names, *landed.MALFORMED]
    bad = [r for r in rows.collect() if r.malformed is not None]
    assert sorted(r.malformed for r in bad) == ["45.0,30.0", GOOD + ",more"]
    assert all(r.file.endswith("a.csv") and r.position == 0 for r in bad)
    routed = feeds.route_detections(rows)
    assert {r.reason: r.n for r in feeds.reason_counts(routed).collect()} == {"ok": 2, "malformed": 2}
    report = feeds.quality_report(routed, feeds.DETECTION_KEY).first()
    assert (report.raw_rows, report.malformed, report.kept, report.unique_rows) == (4, 2, 2, 1)
    assert feeds.normalise_detections(rows).count() == 1
    # without the columns such records are padded or cut, as before
    plain = landed.read_detection_files(spark, str(tmp_path))
    assert plain.columns == RAW_DETECTIONS.names and plain.count() == 4
    assert "malformed" not in feeds.quality_report(
        feeds.route_detections(plain), feeds.DETECTION_KEY).columns


def test_folders_have_a_header_each(spark, tmp_path):
    for name, header, lines in (
        ("one", "latitude,longitude,frp", ["1,2,3", "4,5,6"]), ("two", "longitude,latitude", ["20,10"]),
        ("three", "latitude,longitude,frp", []),
    ):
        (tmp_path / name).mkdir()
        for part in range(2):
            (tmp_path / name / f"{part}.csv").write_text("\n".join([header, *lines[part:part + 1]]) + "\n")
    (tmp_path / "two" / "empty.csv").write_text("")
    for told in (False, True):
        rows = landed.read_detection_files(spark, str(tmp_path), malformed=told).select(
            "latitude", "longitude", "frp").collect()
        assert sorted(map(tuple, rows)) == [("1", "2", "3"), ("10", "20", None), ("4", "5", "6")]
    none = landed.read_detection_files(spark, str(tmp_path / "two"), pattern="*.none")
    assert none.columns == RAW_DETECTIONS.names and none.count() == 0


def test_a_folder_of_two_headers(spark, tmp_path):
    """Fails, unless the reader is told; nothing is read under a wrong name."""
    (tmp_path / "a.csv").write_text("latitude,longitude\n1,2\n")
    (tmp_path / "b.csv").write_text("longitude,latitude\n2,1\n")
    with pytest.raises(Exception, match="header"):
        landed.read_detection_files(spark, str(tmp_path)).collect()
    rows = landed.read_detection_files(spark, str(tmp_path), mixed=True)
    assert [(r.latitude, r.longitude) for r in rows.collect()] == [("1", "2")] * 2


def test_finding_headers_reads_one_file_a_folder(spark, tmp_path):
    """The other files are listed only: they are gone when the headers are looked for."""
    (tmp_path / "p").mkdir()
    for k in range(4):
        (tmp_path / "p" / f"{k}.csv").write_text(f"latitude,longitude\n{k},{k}\n")
    files = landed.landed_files(spark, str(tmp_path))
    assert sorted(r.size for r in files.collect()) == [23] * 4
    assert {r.folder.rsplit("/", 1)[1] for r in files.collect()} == {"p"}
    plan = files.groupBy("folder").agg(F.min("path"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
