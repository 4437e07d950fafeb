from __future__ import annotations

import json

import pytest

from skyground.schemas import DETECTIONS, RAW_DETECTIONS, RAW_REPORTS, REPORTS
from skyground.sources import feeds
from skyground.sources.landed import read_batch, read_detection_files, read_report_files, write_batch

FIRE = dict(latitude="45.0", longitude="30.0", acq_date="2024-01-05", acq_time="130",
            bright_ti4="300.5", frp="2.5", satellite="N", confidence="n", daynight="Day",
            type="0", version="2.0NRT")
EVENT = dict(event_id_cnty="UKR1", event_date="2024-01-05", event_type="Explosions/Remote violence",
             sub_event_type=" Air/drone strike ", notes=" text ", actor1="A", actor2=" ",
             location="Kyiv", country="Ukraine", fatalities="3", latitude="50.4",
             longitude="30.5", geo_precision="1", source="A; B")


def raw_fires(spark, *changes):
    rows = [tuple((FIRE | c).get(f.name) for f in RAW_DETECTIONS) for c in changes]
    return spark.createDataFrame(rows, RAW_DETECTIONS)


def raw_events(spark, *changes):
    rows = [tuple((EVENT | c).get(f.name) for f in RAW_REPORTS) for c in changes]
    return spark.createDataFrame(rows, RAW_REPORTS)


@pytest.mark.parametrize("change,reason", [
    ({}, "ok"),
    ({"confidence": "LOW", "latitude": "bad"}, "low_conf"),
    ({"confidence": " l"}, "ok"),
    ({"confidence": ""}, "ok"),
    ({"confidence": None}, "ok"),
    ({"latitude": "bad", "longitude": "0"}, "parse_err"),
    ({"acq_time": "2460"}, "parse_err"),
    ({"acq_date": "2024-02-30"}, "parse_err"),
    ({"latitude": "40.0", "longitude": "20.0"}, "outside_zone"),
    ({"latitude": "nan"}, "outside_zone"),
    ({"latitude": "52.5", "longitude": "22.0"}, "ok"),
    ({"latitude": "82.0", "longitude": "180.0"}, "ok"),
])
def test_one_reason_per_detection(spark, change, reason):
    assert feeds.route_detections(raw_fires(spark, change)).first().reason == reason


@pytest.mark.parametrize("change,reason", [
    ({}, "ok"),
    ({"geo_precision": "3"}, "skipped"),
    ({"geo_precision": None}, "skipped"),
    ({"geo_precision": "x"}, "skipped"),
    ({"geo_precision": " 2 "}, "ok"),
    ({"sub_event_type": "Grenade"}, "skipped"),
    ({"sub_event_type": None}, "skipped"),
    ({"event_date": "2024-13-01"}, "skipped"),
    ({"longitude": ""}, "skipped"),
    ({"fatalities": "many"}, "ok"),
])
def test_one_reason_per_report(spark, change, reason):
    assert feeds.route_reports(raw_events(spark, change)).first().reason == reason


def test_detection_values(spark):
    row = feeds.normalise_detections(raw_fires(
        spark, {"satellite": "NOAA-20-VIIRS", "type": " 2 ", "scan": "", "track": "x"})).first()
    assert (row.satellite, row.type, row.scan, row.track, row.daynight) == (
        "NOAA-20-VI", 2, None, None, "D")
    assert row.acq_datetime.isoformat() == "2024-01-05T01:30:00"


def test_report_values(spark):
    row = feeds.normalise_reports(raw_events(spark, {"fatalities": "many"})).first()
    assert (row.sub_event_type, row.description, row.actor2_name, row.num_sources,
            row.fatalities) == ("Air/drone strike", "text", None, 2, None)
    assert row.event_datetime.isoformat() == "2024-01-05T00:00:00"


def test_strict_stops_on_unreadable_optional_values(spark):
    with pytest.raises(Exception, match="unreadable frp"):
        feeds.normalise_detections(raw_fires(spark, {"frp": "x"}), strict=True).collect()
    with pytest.raises(Exception, match="unreadable fatalities"):
        feeds.normalise_reports(raw_events(spark, {"fatalities": "x"}), strict=True).collect()


def test_exact_duplicates_are_merged_after_clipping(spark):
    same = {"satellite": "NOAA-20-VIIRS"}
    rows = feeds.normalise_detections(raw_fires(
        spark, same, {"satellite": "NOAA-20-VI"}, {"latitude": "45.1"}, {"satellite": ""},
        {"satellite": None}))
    assert rows.count() == 3
    assert rows.select("id").distinct().count() == 3


def test_reports_without_an_id_are_not_merged(spark):
    rows = feeds.normalise_reports(raw_events(
        spark, {}, {}, {"event_id_cnty": None}, {"event_id_cnty": None})).collect()
    assert sorted((r.global_event_id or "", r.id is None) for r in rows) == [
        ("", True), ("", True), ("UKR1", False)]


def test_quality_report(spark):
    raw = raw_fires(spark, {}, {}, {"frp": "x"}, {"confidence": "l"}, {"acq_time": "x"},
                    {"latitude": "0"})
    row = feeds.quality_report(feeds.route_detections(raw), feeds.DETECTION_KEY).first()
    assert row.asDict() == dict(
        raw_rows=6, low_conf=1, parse_err=1, outside_zone=1, skipped=0, kept=3, unique_rows=1,
        exact_duplicates=2, warnings=1)


def test_quality_report_of_nothing(spark):
    raw = spark.createDataFrame([], RAW_DETECTIONS)
    row = feeds.quality_report(feeds.route_detections(raw), feeds.DETECTION_KEY).first()
    assert (row.kept, row.unique_rows, row.warnings) == (0, 0, 0)


def test_plan_parses_each_coordinate_once(spark):
    plan = feeds.route_detections(raw_fires(spark, {})).filter("reason = 'ok'")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("trim(latitude") == 1 and text.count("trim(confidence") == 0


def test_csv_files_by_column_name(spark, tmp_path):
    header = ["acq_date", "acq_time", "longitude", "latitude", "confidence", "frp", "extra"]
    for day, rows in (("05", 2), ("06", 1)):
        lines = [",".join(header)] + [f"2024-01-{day},9,30.5,45.0,n,{i}.5,z" for i in range(rows)]
        (tmp_path / f"chunk-{day}.csv").write_text("\n".join(lines) + "\n")
    raw = read_detection_files(spark, [str(tmp_path / "chunk-05.csv"), str(tmp_path / "chunk-06.csv")])
    assert raw.columns == [f.name for f in RAW_DETECTIONS]
    got = feeds.normalise_detections(raw).collect()
    assert {(r.latitude, r.longitude, r.satellite) for r in got} == {(45.0, 30.5, None)}
    assert sorted(r.acq_datetime.isoformat() for r in got) == [
        "2024-01-05T00:09:00", "2024-01-06T00:09:00"]


def test_json_pages(spark, tmp_path):
    number = EVENT | {"latitude": 50.25, "geo_precision": 2, "event_id_cnty": "UKR2"}
    (tmp_path / "p1.json").write_text(json.dumps({"data": [EVENT, number], "count": 2}, indent=1))
    (tmp_path / "p2.json").write_text(json.dumps({"count": 0}))
    rows = feeds.normalise_reports(read_report_files(spark, str(tmp_path))).collect()
    assert sorted((r.global_event_id, r.latitude) for r in rows) == [
        ("UKR1", 50.4), ("UKR2", 50.25)]


def test_batch_files_round_trip(spark, tmp_path):
    rows = feeds.normalise_detections(raw_fires(spark, {}, {"latitude": "45.2"}))
    write_batch(rows, str(tmp_path / "d"), DETECTIONS)
    write_batch(rows, str(tmp_path / "d"), DETECTIONS)
    back = read_batch(spark, str(tmp_path / "d"), DETECTIONS)
    assert back.schema.simpleString() == DETECTIONS.simpleString()
    same = lambda df: sorted(map(str, df.drop("ingested_at").collect()))
    assert same(back) == same(rows)
    events = feeds.normalise_reports(raw_events(spark, {}))
    write_batch(events, str(tmp_path / "r"), REPORTS)
    assert read_batch(spark, str(tmp_path / "r"), REPORTS).count() == 1


def test_requested_rows_reach_the_scan(spark, tmp_path):
    raw_events(spark, {}, {"country": "France"}, {"event_type": "Battles"},
               {"event_date": "2024-02-01"}).write.parquet(str(tmp_path / "raw"))
    got = feeds.select_reports(spark.read.parquet(str(tmp_path / "raw")), "2024-01-01", "2024-01-31")
    assert got.count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("\n")[0]
    for name in ("country", "event_type", "event_date"):
        assert name in pushed
