"""Dedup batch by batch against dedup of all rows at once."""

from __future__ import annotations

import random
import uuid

import pytest

from helpers import as_rows, brute_dominated, detections
from skyground.operators import borders as B
from skyground.plans import borders as P
from skyground.sources import tables as T

T0 = 1_700_006_400
HOUR = 3600


def crowd(seed, n=60, hours=60):
    """Points in a small place over some days."""
    draw = random.Random(seed)
    return [(i, 45.0 + draw.uniform(0, 0.02), 30.0 + draw.uniform(0, 0.02),
             T0 + draw.randrange(hours * HOUR)) for i in draw.sample(range(1000), n)]


def run(spark, parts, order, **options):
    schema = f"b{uuid.uuid4().hex[:12]}"
    kept, back = set(), set()
    for k in order:
        silver, taken = P.dedup_batch(
            spark, schema, f"p{k}", detections(spark, as_rows(parts[k])), **options)
        kept |= {r.id for r in silver.collect()}
        back |= {r.id for r in taken.collect()}
    return kept, back, spark.table(T.qualified(schema, P.BORDERS))


@pytest.mark.parametrize("seed,order", [(1, (0, 1, 2, 3)), (2, (3, 2, 1, 0)), (3, (1, 3, 0, 2))])
def test_batches_give_the_dedup_of_all(spark, seed, order):
    """Batches of 15 hours and one of three, in any order of arrival."""
    points = crowd(seed)
    edges = [0, 15, 30, 33, 60]
    parts = [[p for p in points if a * HOUR <= p[3] - T0 < b * HOUR] for a, b in zip(edges, edges[1:])]
    kept, back, table = run(spark, parts, order)
    assert sorted({p[0] for p in points} - (kept - back)) == brute_dominated(points)
    assert back <= kept and (back or order == (1, 3, 0, 2))
    # the table tells which of its rows are still kept
    assert {r.id for r in table.filter("kept").collect()} <= kept - back


def test_a_batch_run_again(spark):
    points = crowd(5)
    parts = [[p for p in points if p[3] - T0 < 30 * HOUR], [p for p in points if p[3] - T0 >= 30 * HOUR]]
    kept, back, table = run(spark, parts, (0, 1, 1))
    assert sorted({p[0] for p in points} - (kept - back)) == brute_dominated(points)
    assert table.count() == table.select("id").distinct().count()


def test_only_ends_are_kept_and_read(spark):
    rows = [(k, 45.0, 30.0 + k, T0 + k * HOUR) for k in range(48)]
    near = B.near_ends(detections(spark, as_rows(rows)), T0, T0 + 47 * HOUR)
    assert sorted(r.id for r in near.collect()) == [*range(7), *range(41, 48)]
    schema = f"b{uuid.uuid4().hex[:12]}"
    P.dedup_batch(spark, schema, "a", detections(spark, as_rows(rows)))
    assert spark.table(T.qualified(schema, P.BORDERS)).count() == 14


def test_empty_batches_and_rows_without_time(spark):
    odd = [{"id": 1, "latitude": 45.0, "longitude": 30.0, "sec": None}, {"id": None, "sec": T0},
           {"id": 2, "latitude": None, "longitude": 30.0, "sec": T0}]
    schema = f"b{uuid.uuid4().hex[:12]}"
    for rows, n in (([], 0), (odd[:1], 1), (odd, 3)):
        silver, back = P.dedup_batch(spark, schema, f"n{n}", detections(spark, rows))
        assert silver.count() == n and back.count() == 0


def test_overlapping_times_are_the_exception(spark):
    """Named in the docstring: far from the ends of both batches, rows are not compared."""
    ends = lambda i: [(i, 10.0, 10.0 + i / 100, T0), (i + 1, 20.0, 10.0 + i / 100, T0 + 40 * HOUR)]
    parts = [[*ends(100), (1, 45.0, 30.0, T0 + 20 * HOUR)], [*ends(200), (2, 45.0, 30.0, T0 + 20 * HOUR)]]
    kept, back, _ = run(spark, parts, (0, 1))
    assert {1, 2} <= kept and not back


def test_sides_that_grow_are_not_broadcast(spark, monkeypatch):
    """The lists of hot keys are, and they are bounded; whatever else is sent to the driver grows."""
    plans = []

    def plan_of(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    def recorded(inner):
        return lambda df, *rest, **metrics: plan_of(df) or inner(df, *rest, **metrics)

    monkeypatch.setattr(P, "stored", recorded(P.stored))
    monkeypatch.setattr(P, "observed", recorded(P.observed))
    points = crowd(7)
    schema = f"b{uuid.uuid4().hex[:12]}"
    for k in (1, 0):
        part = [p for p in points if (p[3] - T0 >= 30 * HOUR) == k]
        for df in P.dedup_batch(spark, schema, f"p{k}", detections(spark, as_rows(part))):
            plan_of(df)
    assert sum("Join" in plan for plan in plans) >= 8
    # the two sides of the distance join read the list of hot keys
    assert max(plan.count("BroadcastHashJoin") for plan in plans) == 2
    assert all("hot-keys" in plan for plan in plans if "Broadcast" in plan)
