from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import METRES_PER_DEGREE, as_rows, brute_dominated, detections, ids
from skyground.operators.proximity import (
    confident, dominated_ids, proximity_dedup, residual_pairs,
)

T0 = 1_700_000_000


def survivors(spark, rows, **options):
    return ids(proximity_dedup(detections(spark, rows), **options))


def test_of_a_chain_only_the_last_row_stays(spark):
    step = 900 / METRES_PER_DEGREE
    rows = as_rows([(i, 40 + i * step, 30, T0) for i in (1, 2, 3)])
    assert survivors(spark, rows) == [3]


@pytest.mark.parametrize("gap,left", [(21_600, [2]), (21_601, [1, 2])])
def test_time_radius_is_inclusive(spark, gap, left):
    assert survivors(spark, as_rows([(1, 40, 30, T0), (2, 40, 30, T0 + gap)])) == left


@pytest.mark.parametrize("gap,left", [(21_600, [2]), (21_601, [1, 2])])
def test_the_higher_id_survives_whichever_is_later(spark, gap, left):
    assert survivors(spark, as_rows([(1, 40, 30, T0 + gap), (2, 40, 30, T0)])) == left


@pytest.mark.parametrize("distance,left", [(1005, [2]), (1007, [1, 2])])
def test_distance_radius(spark, distance, left):
    rows = as_rows([(1, 40, 30, T0), (2, 40 + distance / METRES_PER_DEGREE, 30, T0)])
    assert survivors(spark, rows) == left


def test_equal_ids_and_missing_values_survive(spark):
    rows = as_rows([(7, 40, 30, T0), (7, 40, 30, T0), (8, 50, 30, T0), (9, 50, 30, T0)])
    rows += [dict(id=1, latitude=None, longitude=30.0, sec=T0),
             dict(id=2, latitude=float("nan"), longitude=30.0, sec=T0),
             dict(id=3, latitude=50.0, longitude=30.0, sec=None),
             dict(id=None, latitude=50.0, longitude=30.0, sec=T0)]
    left = proximity_dedup(detections(spark, rows))
    assert sorted((r.id is None, r.id or 0) for r in left.collect()) == [
        (False, 1), (False, 2), (False, 3), (False, 7), (False, 7), (False, 9), (True, 0)]


def test_an_id_dominated_in_one_place_is_dropped_everywhere(spark):
    rows = as_rows([(5, 40, 30, T0), (5, 50, 30, T0), (6, 50, 30, T0)])
    assert survivors(spark, rows) == [6]


def test_antimeridian(spark):
    rows = as_rows([(1, 65, 179.999, T0), (2, 65, -179.999, T0)])
    assert survivors(spark, rows) == [2]
    assert survivors(spark, rows, wrap=False) == [1, 2]


@pytest.mark.parametrize("lat", [79.0, 85.0, 89.9])
def test_high_latitudes(spark, lat):
    import math
    lon = 1000 / (METRES_PER_DEGREE * math.cos(math.radians(lat)))
    assert survivors(spark, as_rows([(1, lat, 10, T0), (2, lat, 10 + lon, T0)])) == [2]


def test_across_the_pole(spark):
    assert survivors(spark, as_rows([(1, 89.996, 0, T0), (2, 89.996, 180, T0)])) == [2]


def test_confidence_filter_drops_missing_confidence(spark):
    kinds = [None, "", "L", "Low", "l", "h", "H", "high", "n"]
    rows = [dict(id=i, latitude=1.0, longitude=1.0, sec=T0, confidence=c)
            for i, c in enumerate(kinds)]
    kept = confident(detections(spark, rows)).select("confidence").collect()
    assert sorted(r[0] for r in kept) == ["", "H", "h", "high", "n"]


def scattered(seed, n, lat_range, lon_range, span_s):
    rnd = random.Random(seed)
    order = rnd.sample(range(n * 3), n)
    return [(order[i], rnd.uniform(*lat_range), rnd.uniform(*lon_range),
             T0 + rnd.randrange(span_s)) for i in range(n)]


@pytest.mark.parametrize("seed,lat,lon", [
    (1, (39.95, 40.05), (29.9, 30.1)),
    (2, (-0.05, 0.05), (-0.05, 0.05)),
    (3, (83.9, 84.0), (-180, 180)),
    (4, (89.8, 90.0), (-180, 180)),
    (5, (-60.03, -59.97), (179.9, 180)),
])
@pytest.mark.parametrize("rows_per_task", [1_000_000, 5])
def test_equals_brute_force(spark, seed, lat, lon, rows_per_task):
    points = scattered(seed, 400, lat, lon, 4 * 86_400)
    if seed == 5:  # both sides of the 180th meridian
        points = [(i, a, o if i % 2 else -o, s) for i, a, o, s in points]
    df = detections(spark, as_rows(points)).repartition(4)
    assert ids(dominated_ids(df, rows_per_task=rows_per_task)) == brute_dominated(points)


def test_a_third_of_all_rows_in_one_place(spark):
    """A crowd of near and exact copies next to scattered rows, split into many pieces."""
    points = scattered(6, 1200, (20, 50), (20, 50), 86_400)
    crowd = scattered(7, 600, (40.0, 40.02), (30.0, 30.02), 30_000)
    crowd = [(i + 10_000, a, o, s) for i, a, o, s in crowd]
    same = [(20_000 + i, 40.01, 30.01, T0 + 100) for i in range(200)]
    rows = points + crowd + same
    df = detections(spark, as_rows(rows)).repartition(6)
    expected = brute_dominated(rows)
    assert ids(dominated_ids(df, rows_per_task=20)) == expected
    assert ids(dominated_ids(df)) == expected


def test_a_third_of_all_rows_are_copies(spark):
    """Copies of one row share its fate, and every surviving copy is kept."""
    points = scattered(10, 400, (39.9, 40.1), (29.9, 30.1), 86_400)
    gone = set(brute_dominated(points))
    for fate in (True, False):
        copied = next(p for p in points if (p[0] in gone) is fate)
        rows = as_rows(points + [copied] * 200)
        left = ids(proximity_dedup(detections(spark, rows).repartition(5), rows_per_task=20))
        expected = [r["id"] for r in rows if r["id"] not in gone]
        assert left == sorted(expected)


def test_copies_are_split_in_the_final_join(spark, tmp_path):
    """What id and content cannot tell apart, adaptive execution splits by map output."""
    points = scattered(12, 300, (45.0, 45.1), (45.0, 45.1), 86_400)
    points += [(5_000, 40.0, 30.0, T0)] * 20_000
    detections(spark, as_rows(points)).repartition(8).write.parquet(str(tmp_path / "d"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200B",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200B",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100B",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        kept = proximity_dedup(spark.read.parquet(str(tmp_path / "d")))
        assert kept.filter("id = 5000").count() == 20_000
        rows = kept.collect()
        plan = plan_of(kept)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(rows) > 20_000
    assert "SortMergeJoin(skew=true)" in plan.split("Initial Plan")[0]


def test_properties_of_the_result(spark):
    points = scattered(8, 500, (39.95, 40.05), (29.95, 30.05), 2 * 86_400)
    df = detections(spark, as_rows(points))
    kept = proximity_dedup(df)
    assert residual_pairs(kept).first().residual == 0
    assert ids(proximity_dedup(kept)) == ids(kept)
    assert len(ids(kept)) + dominated_ids(df).count() == len(points)


def test_other_radii(spark):
    points = scattered(9, 300, (39, 41), (29, 31), 86_400)
    df = detections(spark, as_rows(points))
    assert ids(dominated_ids(df, radius_m=25_000.0, window_s=3_600)) == brute_dominated(
        points, 25_000.0, 3_600)
    assert ids(dominated_ids(df, radius_m=2_000_000.0, window_s=600)) == brute_dominated(
        points, 2_000_000.0, 600)


def test_empty_and_placeless_inputs(spark):
    nowhere = [dict(id=i, latitude=None, longitude=None, sec=T0) for i in range(3)]
    for rows, left in ((nowhere, [0, 1, 2]), (as_rows([(4, 40, 30, T0)]), [4])):
        assert survivors(spark, rows) == left
    empty = detections(spark, nowhere).limit(0)
    assert ids(proximity_dedup(empty)) == []
    assert residual_pairs(empty).first().residual == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_keys_and_no_python(spark):
    df = detections(spark, as_rows(scattered(1, 50, (0, 1), (0, 1), 100)))
    for threshold in ("-1", "10485760"):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = plan_of(proximity_dedup(df))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for operator in ("NestedLoop", "Cartesian", "Python", "Pandas"):
            assert operator not in plan


def test_only_the_hot_list_is_broadcast(spark):
    """However small the other sides are; without hot keys the list is dropped from the plan."""
    kept = proximity_dedup(detections(spark, as_rows(scattered(1, 200, (0, 0.1), (0, 0.1), 100_000))))
    assert kept.collect()
    plan = plan_of(kept).split("Initial Plan")[0]
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 3


def test_scan_reads_only_four_columns_for_the_ids(spark, tmp_path):
    df = detections(spark, as_rows(scattered(1, 50, (0, 1), (0, 1), 100)))
    df.withColumn("note", F.lit("x")).write.parquet(str(tmp_path / "d"))
    plan = plan_of(dominated_ids(spark.read.parquet(str(tmp_path / "d"))))
    schemas = {line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line}
    assert schemas and all("note" not in s and "frp" not in s for s in schemas)


def test_the_branches_share_one_scan(spark, tmp_path):
    df = detections(spark, as_rows(scattered(1, 200, (0, 1), (0, 1), 100)))
    df.write.parquet(str(tmp_path / "d"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = dominated_ids(spark.read.parquet(str(tmp_path / "d")))
        result.collect()
        plan = plan_of(result).split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
