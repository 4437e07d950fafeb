from __future__ import annotations

import random
from datetime import date

from helpers import as_rows, detections, ids
from skyground.operators import boxes
from skyground.operators.counts import counts_running
from skyground.operators.exact import first_per_key
from skyground.plans import requests


def points(spark, places):
    return detections(spark, as_rows([(i, a, o, 0) for i, (a, o) in enumerate(places)]))


def test_fixed_boxes_are_closed_and_count_once(spark):
    places = [(52.5, 40.5), (31.4, 34.5), (0, 0), (41.0, 19.0), (40.999, 19.0)]
    df = points(spark, places)
    assert ids(boxes.keep_in_boxes(df)) == [0, 1, 3]
    missing = detections(spark, [dict(id=1, latitude=None, longitude=30.0, sec=0)])
    assert ids(boxes.keep_in_boxes(missing)) == []


def test_overlapping_regions_give_duplicates(spark):
    df = points(spark, [(42, 30), (50, 30), (20, 50), (0, 0)])
    got = sorted((r.id, r.region) for r in boxes.pull_regions(df).collect())
    assert got == [(0, "Eastern Europe / Russia"), (0, "Middle East"),
                   (1, "Eastern Europe / Russia"), (2, "Middle East")]


def test_box_table_equals_brute_force(spark):
    rnd = random.Random(3)
    places = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(500)]
    places += [(10.0, 20.0), (11.5, 20.0)]
    table = [(10.0, 11.5, 20.0, 23.0), (10.0, 11.5, 20.0, 23.0)] + [
        (a, a + rnd.uniform(0, 20), o, o + rnd.uniform(0, 30))
        for a, o in ((rnd.uniform(-90, 70), rnd.uniform(-180, 150)) for _ in range(15))]
    df = spark.createDataFrame(
        table, "min_lat double, max_lat double, min_lon double, max_lon double")
    expected = [i for i, (a, o) in enumerate(places)
                if any(s <= a <= n and w <= o <= e for s, n, w, e in table)]
    got = boxes.keep_in_box_table(points(spark, places), df)
    assert ids(got) == expected
    crowded = [(10.5, 21.0)] * 200 + places
    split = boxes.keep_in_box_table(points(spark, crowded).repartition(4), df, rows_per_task=10)
    assert ids(split) == list(range(200)) + [i + 200 for i in expected]
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_date_chunks(spark):
    rows = [(1, date(2024, 1, 1), date(2024, 1, 12)), (2, date(2024, 1, 1), date(2024, 1, 5)),
            (3, date(2024, 1, 3), date(2024, 1, 3)), (4, date(2024, 1, 3), date(2024, 1, 2))]
    df = spark.createDataFrame(rows, "id int, a date, b date")
    got = [(r.id, r.chunk_start.day, r.chunk_days)
           for r in requests.date_chunks(df, "a", "b").orderBy("id", "chunk_start").collect()]
    assert got == [(1, 1, 5), (1, 6, 5), (1, 11, 2), (2, 1, 5), (3, 3, 1)]


def test_request_list(spark):
    days = spark.createDataFrame(
        [(date(2024, 1, 1), date(2024, 1, 8))], "first_day date, last_day date")
    rows = requests.request_list(days, requests.products_for(11)).collect()
    assert len(rows) == 8 and {r["product"] for r in rows} == {"VIIRS_SNPP_SP", "VIIRS_NOAA20_SP"}
    assert requests.products_for(10) == ("VIIRS_SNPP_NRT", "VIIRS_NOAA20_NRT")


def test_running_counts_list_every_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("x",), (None,)], "c string")
    got = [tuple(r) for r in counts_running(df, "c", ["a", "z", "b"]).orderBy("position").collect()]
    assert got == [(0, "a", 1, 1), (1, "z", 0, 1), (2, "b", 2, 3)]


def test_first_per_key(spark):
    rows = [(1, "b", 2), (1, "a", 3), (2, None, 1), (None, "x", 1), (None, "y", 1)]
    df = spark.createDataFrame(rows, "k int, v string, w int")
    keep = lambda **o: sorted(((r.k or 0), r.v or "") for r in first_per_key(df, ["k"], **o).collect())
    assert keep() == [(0, "x"), (1, "a"), (2, "")]
    assert keep(order=["w"]) == [(0, "x"), (1, "b"), (2, "")]
    assert keep(null_keys_differ=True) == [(0, "x"), (0, "y"), (1, "a"), (2, "")]


def test_of_two_copies_the_one_with_a_value_stays(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "v", None), (1, "v", 7)], "k int, v string, w int")
    assert [tuple(r) for r in first_per_key(df, ["k"]).collect()] == [(1, "v", 7)]
    assert [tuple(r) for r in first_per_key(df, ["k"], order=["w"]).collect()] == [(1, None, 5)]


def test_copies_are_combined_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    plan = first_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
