from __future__ import annotations

import random

import pytest

from helpers import METRES_PER_DEGREE, as_rows, brute_pairs, detections, reports
from skyground.operators.correlate import correlate

T0 = 1_700_006_400  # a UTC midnight
HOUR = 3600


def one(spark, fire, event, **options):
    f = dict(id=1, latitude=40.0, longitude=30.0, sec=T0, frp=300.0, confidence="h") | fire
    g = dict(id=2, latitude=40.0, longitude=30.0, sec=T0, num_sources=3) | event
    return correlate(detections(spark, [f]), reports(spark, [g]), **options).collect()


@pytest.mark.parametrize("offset,found", [
    (-48 * HOUR, True), (-48 * HOUR - 1, False), (6 * HOUR, True), (6 * HOUR + 1, False)])
def test_the_interval_is_asymmetric_and_closed(spark, offset, found):
    assert bool(one(spark, {}, {"sec": T0 + offset})) is found


@pytest.mark.parametrize("frp,found", [
    (None, False), (0.99, False), (1.0, True), (300.0, True), (900.0, True)])
def test_minimum_intensity(spark, frp, found):
    assert bool(one(spark, {"frp": frp}, {})) is found


@pytest.mark.parametrize("fire,event,score", [
    ({}, {}, 1.0),
    ({"frp": 900.0}, {"num_sources": 9}, 1.0),
    ({"frp": 30.0}, {}, 0.1),
    ({"confidence": "H"}, {}, 0.8),
    ({"confidence": "high"}, {}, 0.8),
    ({"confidence": None}, {}, 0.8),
    ({}, {"num_sources": None}, 1 / 3),
    ({}, {"num_sources": 0}, 0.0),
    ({}, {"num_sources": 1}, 1 / 3),
    ({}, {"sec": T0 - 27 * HOUR}, 0.5),
    ({}, {"latitude": 40 + 7500 / METRES_PER_DEGREE}, 0.5),
])
def test_score_factors(spark, fire, event, score):
    (pair,) = one(spark, fire, event)
    assert pair.score == pytest.approx(score, abs=1e-6)


def test_delta_is_event_minus_detection(spark):
    (pair,) = one(spark, {}, {"sec": T0 - 12 * HOUR})
    assert pair.time_delta_h == -12.0


@pytest.mark.parametrize("distance,found", [(9_999.9, True), (10_000.5, False)])
def test_distance(spark, distance, found):
    assert bool(one(spark, {}, {"latitude": 40 + distance / METRES_PER_DEGREE})) is found


def test_antimeridian(spark):
    fire, event = {"latitude": 65.0, "longitude": 179.95}, {"latitude": 65.0, "longitude": -179.95}
    assert one(spark, fire, event)
    assert not one(spark, fire, event, wrap=False)


def test_missing_place_or_time_never_pairs(spark):
    for gap in ({"latitude": None}, {"longitude": None}, {"sec": None}):
        assert not one(spark, gap, {})
        assert not one(spark, {}, gap)


def crowd(seed, n, first_id, lat, lon):
    rnd = random.Random(seed)
    return [(first_id + i, rnd.uniform(*lat), rnd.uniform(*lon), T0 + rnd.randrange(6 * 86_400))
            for i in range(n)]


@pytest.mark.parametrize("rows_per_task", [50_000, 7])
@pytest.mark.parametrize("lat,lon", [
    ((39.8, 40.2), (29.8, 30.2)), ((88.5, 90.0), (-180, 180)), ((-1, 1), (179.5, 180.0))])
def test_equals_brute_force(spark, lat, lon, rows_per_task):
    fires, events = crowd(1, 300, 0, lat, lon), crowd(2, 150, 1000, lat, lon)
    if lon[0] == 179.5:
        fires = [(i, a, o if i % 2 else -o, s) for i, a, o, s in fires]
    got = correlate(
        detections(spark, as_rows(fires)).repartition(4),
        reports(spark, as_rows(events)).repartition(3), rows_per_task=rows_per_task)
    pairs = sorted((r[0], r[1]) for r in got.select("firms_detection_id", "acled_event_id").collect())
    assert pairs == brute_pairs(fires, events)


def test_empty_sides(spark):
    d, r = detections(spark, as_rows([(1, 40, 30, T0)])), reports(spark, as_rows([(2, 40, 30, T0)]))
    assert correlate(d, r).count() == 1
    assert correlate(d.limit(0), r).count() == 0
    assert correlate(d, r.limit(0)).count() == 0


def test_crowds_are_looked_for_in_a_superset(spark):
    """Pieces come from the given frame; pairs only from the detections."""
    fires = [(i, 40.0, 30.0, T0) for i in range(60)]
    events = [(100 + i, 40.0, 30.0, T0) for i in range(5)]
    some = detections(spark, as_rows(fires[:20]))
    got = correlate(some, reports(spark, as_rows(events)), rows_per_task=10,
                    crowds_from=detections(spark, as_rows(fires)))
    assert got.count() == 100
    assert got.select("firms_detection_id", "acled_event_id").distinct().count() == 100


def test_crowds_on_both_sides(spark):
    """A third of both feeds at one spot; every pair comes out once."""
    fires = crowd(3, 400, 0, (20, 50), (20, 50)) + [(1000 + i, 40.0, 30.0, T0) for i in range(200)]
    events = crowd(4, 100, 5000, (20, 50), (20, 50)) + [
        (6000 + i, 40.0, 30.0, T0) for i in range(60)]
    d, r = detections(spark, as_rows(fires)), reports(spark, as_rows(events))
    got = correlate(d, r, rows_per_task=10).select("firms_detection_id", "acled_event_id")
    assert sorted(map(tuple, got.collect())) == brute_pairs(fires, events)


def test_plan_is_an_equi_join(spark):
    d = detections(spark, as_rows(crowd(1, 20, 0, (0, 1), (0, 1))))
    r = reports(spark, as_rows(crowd(2, 20, 0, (0, 1), (0, 1))))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = correlate(d, r)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan
    for operator in ("NestedLoop", "Cartesian", "Python", "Pandas"):
        assert operator not in plan
