"""Raw files to the exported map, through every layer, on the smallest tables."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import brute_dominated, brute_pairs
from skyground.functions.clock import epoch_s
from skyground.plans import daily
from skyground.schemas import DETECTIONS, REPORTS
from skyground.sources import feeds
from skyground.sources.landed import (
    read_batch, read_detection_files, read_report_files, write_batch,
)
from workload import fixtures


@pytest.fixture(scope="module")
def landed(spark, smallest, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    fixtures.raw_detections(spark, smallest).repartition(3).write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(f"{folder}/a")
    rows = [r.asDict() for r in fixtures.raw_reports(spark, smallest).collect()]
    (folder / "b").mkdir()
    for page in range(0, len(rows), 50):
        (folder / "b" / f"page{page}.json").write_text(
            json.dumps({"count": 50, "data": rows[page:page + 50]}))
    (folder / "b" / "empty.json").write_text(json.dumps({"count": 0}))
    return folder


def test_files_give_the_rows_they_were_made_of(spark, smallest, landed):
    for read, made in (
        (read_detection_files(spark, f"{landed}/a"), fixtures.raw_detections(spark, smallest)),
        (read_report_files(spark, f"{landed}/b"), fixtures.raw_reports(spark, smallest)),
    ):
        # CSV does not tell a blank text from a missing one, and neither do the parsers
        plain = lambda df: sorted(
            tuple(v or "" for v in r) for r in df.select(sorted(df.columns)).collect())
        assert plain(read) == plain(made)


def test_through_all_layers(spark, landed, tmp_path):
    detections = feeds.normalise_detections(read_detection_files(spark, f"{landed}/a"))
    reports = feeds.normalise_reports(read_report_files(spark, f"{landed}/b"))
    write_batch(detections, f"{tmp_path}/d", DETECTIONS)
    write_batch(reports, f"{tmp_path}/r", REPORTS)
    counts = daily.run_day(spark, "trip", f"{tmp_path}/d", f"{tmp_path}/r", ids_imply_time=True)

    d = read_batch(spark, f"{tmp_path}/d", DETECTIONS).filter("confidence is not null").select(
        "id", "latitude", "longitude", epoch_s(F.col("acq_datetime")), "frp").collect()
    r = read_batch(spark, f"{tmp_path}/r", REPORTS).select(
        "id", "latitude", "longitude", epoch_s(F.col("event_datetime"))).collect()
    # 64-bit ids do not fit a double: use their ranks
    rank = {i: n for n, i in enumerate(sorted(x[0] for x in d))}
    fires = [(rank[x[0]], *x[1:4]) for x in d]
    events = [(n, *x[1:]) for n, x in enumerate(r)]
    gone = set(brute_dominated(fires))
    strong = {rank[x[0]] for x in d if x[4] is not None and x[4] >= 1}
    kept = [f for f in fires if f[0] not in gone and f[0] in strong]
    expected = brute_pairs(kept, events)

    assert spark.table("trip.firms_silver").count() == len(fires) - len(gone)
    assert counts["pairs"] == counts["new_pairs"] == len(expected) > 0
    view = daily.serving_view(spark, "trip")
    best = {e for _, e in expected}
    assert 0 < view.count() <= len(best)
    assert view.select("acled_event_id").distinct().count() == view.count()
    daily.export(spark, "trip", f"{tmp_path}/out", f"{tmp_path}/none.json")
    assert spark.read.json(f"{tmp_path}/out/events").count() == view.count()
    assert np.all([row.passed for row in daily.check_tables(spark, "trip").collect()])
