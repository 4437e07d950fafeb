"""Space-filling order: codes, ranges of a box, and files read."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyground.fixed_values import COUNTRY_BOXES
from skyground.functions import morton as M
from skyground.sources import clustered


def plain_code(lat, lon):
    y = max(0, min(int((lat + 90) / 180 * 65536 // 1), 65535))
    x = max(0, min(int((lon + 180) / 360 * 65536 // 1), 65535))
    return sum(((y >> k & 1) << 2 * k) | ((x >> k & 1) << 2 * k + 1) for k in range(16))


POINTS = [(0.0, 0.0), (-90.0, -180.0), (90.0, 180.0), (89.9999, 179.9999), (-95.0, 400.0), (45.5, 30.25)]


def test_codes(spark):
    draw = random.Random(1)
    points = POINTS + [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(200)]
    df = spark.createDataFrame(points + [(None, 1.0), (1.0, None)], "lat double, lon double")
    got = {(r.lat, r.lon): r.code for r in df.withColumn(
        "code", M.morton(F.col("lat"), F.col("lon"))).collect()}
    assert {p: plain_code(*p) for p in points} == {p: got[p] for p in points}
    assert got[(None, 1.0)] is None and got[(1.0, None)] is None


@pytest.mark.parametrize("most", [1, 8, 64])
def test_ranges_hold_every_point_of_a_box(most):
    draw = random.Random(2)
    boxes = [b[1:] for b in COUNTRY_BOXES] + [(-90, 90, -180, 180), (10, 10, 20, 20), (89.9, 90, 179.9, 180)]
    for s, n, w, e in boxes:
        found = M.ranges(s, n, w, e, most)
        assert 0 < len(found) <= most
        assert all(a <= b for a, b in found) and all(
            x[1] < y[0] for x, y in zip(found, found[1:]))
        for lat, lon in [(s, w), (n, e), (s, e), (n, w)] + [
                (draw.uniform(s, n), draw.uniform(w, e)) for _ in range(100)]:
            assert any(a <= plain_code(lat, lon) <= b for a, b in found)
    assert M.ranges(1, 0, 0, 1) == [] and M.ranges(-90, 90, -180, 180) == [(0, 2 ** 32 - 1)]
    if most == 64:  # few codes beyond the box
        share = sum(b - a + 1 for a, b in M.ranges(44.0, 52.5, 22.0, 40.5)) / 2 ** 32
        assert share < 1.5 * (8.5 / 180) * (18.5 / 360)


def test_a_box_is_read_from_few_files(spark, tmp_path):
    """A crowded place with a third of all rows, rows without a place, and 20 files."""
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(o)) for i, (a, o) in enumerate(zip(
        rng.uniform(-60, 80, 3000), rng.uniform(-180, 180, 3000)))]
    rows += [(5000 + i, 50.45, 30.52) for i in range(1500)] + [(9000, None, 1.0), (9001, 1.0, None)]
    df = spark.createDataFrame(rows, "id int, latitude double, longitude double")
    path = str(tmp_path / "points")
    clustered.write_clustered(df, path, files=20)
    listed = spark.read.parquet(f"{path}/files").collect()
    assert sum(r.n for r in listed) == len(rows) and 15 <= len(listed) <= 21
    assert max(r.n for r in listed) < 3 * len(rows) / 20
    for box in COUNTRY_BOXES:
        _, s, n, w, e = box
        inside = sorted(i for i, a, o in rows if a is not None and o is not None
                        and s <= a <= n and w <= o <= e)
        got = clustered.read_boxes(spark, path, [box])
        assert sorted(r.id for r in got.collect()) == inside and got.columns == df.columns
        crowd = s <= 50.45 <= n and w <= 30.52 <= e
        # the crowded place is in several files itself
        assert len(clustered.files_for(spark, path, [box])) <= (len(listed) * 0.75 if crowd else 4)
    far = [("X", -89.0, -80.0, 0.0, 1.0)]
    assert clustered.read_boxes(spark, path, far).count() == 0
    assert clustered.read_boxes(spark, path).count() == len(
        {i for i, a, o in rows if a is not None and o is not None
         for _, s, n, w, e in COUNTRY_BOXES if s <= a <= n and w <= o <= e})


def test_files_that_are_not_touched_are_not_opened(spark, tmp_path):
    rows = spark.range(400).select(
        "id", (F.col("id") % 20 * 8 - 80).cast("double").alias("latitude"),
        (F.floor(F.col("id") / 20) * 17 - 170).cast("double").alias("longitude"))
    path = tmp_path / "points"
    clustered.write_clustered(rows, str(path), files=16)
    box = [("X", 40.0, 60.0, 10.0, 40.0)]
    wanted = {f.rsplit("/", 1)[1] for f in clustered.files_for(spark, str(path), box)}
    others = [f for f in (path / "rows").glob("part-*") if f.name not in wanted]
    assert len(others) >= 10
    got = clustered.read_boxes(spark, str(path), box)
    assert {f.rsplit("/", 1)[1] for f in got.inputFiles()} == wanted
    assert sorted(r.id for r in got.collect()) == sorted(
        r.id for r in rows.filter("latitude BETWEEN 40 AND 60 AND longitude BETWEEN 10 AND 40").collect())
