"""Partitioned merges that can be run again, the live view, and the map kept up to date."""

from __future__ import annotations

import random
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import as_rows, detections, reports
from skyground.operators.checks import CheckFailed, observed_contract, require
from skyground.operators.ranking import best_per_report, map_view
from skyground.plans import daily, incremental
from skyground.plans.stages import observed, stored_observed
from skyground.schemas import CORRELATIONS, DETECTIONS, MAP_COLUMNS, REPORTS
from skyground.sources import batches as B, tables as T, views
from skyground.sources.landed import write_batch

T0 = 1_700_006_400
DAY_S = 86_400
GOLD = T.CORRELATIONS_GOLD


@pytest.fixture
def schema(spark):
    name = f"s{uuid.uuid4().hex[:12]}"
    B.ensure_partitioned(spark, name)
    return name


def pairs(spark, rows):
    """Gold rows from (detection, report, score, lat, lon, day)."""
    data = [(d, e, float(s), float(lat), float(lon), T0 + DAY_S * day) for d, e, s, lat, lon, day in rows]
    df = spark.createDataFrame(
        data, "firms_detection_id long, acled_event_id long, score double, event_lat double,"
              " event_lon double, sec long")
    wide = df.withColumns({
        "fire_acq_datetime": F.timestamp_seconds("sec"), "event_datetime": F.timestamp_seconds("sec")})
    missing = [f for f in CORRELATIONS.fields if f.name not in wide.columns]
    return wide.select(
        *[F.col(f.name).cast(f.dataType) if f not in missing
          else F.lit(None).cast(f.dataType).alias(f.name) for f in CORRELATIONS.fields])


def fires(spark, rows):
    """Detections from (id, day, intensity)."""
    return detections(spark, [
        {"id": i, "latitude": 45.0, "longitude": 30.0, "frp": frp,
         "sec": None if day is None else T0 + DAY_S * day} for i, day, frp in rows])


def table(spark, schema, name=T.DETECTIONS_BRONZE):
    return spark.table(T.qualified(schema, name))


def partitions(spark, schema, name=T.DETECTIONS_BRONZE):
    return sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {T.qualified(schema, name)}").collect())


# Merges

def put(spark, schema, batch, rows, **metrics):
    return B.merge_batch(spark, schema, T.DETECTIONS_BRONZE, fires(spark, rows), batch, **metrics)


def held(spark, schema):
    return sorted(((r.id is None, r.id or 0), r.frp, r.batch) for r in table(spark, schema).collect())


def test_first_value_stays(spark, schema):
    assert put(spark, schema, "a", [(1, 0, 1.0), (2, 0, 1.0), (3, 1, 1.0)]) == {
        "source": 3, "inserted": 3}
    assert put(spark, schema, "b", [(2, 0, 9.0), (3, 1, 9.0), (4, 1, 9.0), (4, 1, 8.0)]) == {
        "source": 4, "inserted": 2}
    assert [(k[1], v, b) for k, v, b in held(spark, schema)] == [
        (1, 1.0, "a"), (2, 1.0, "a"), (3, 1.0, "a"), (4, 8.0, "b"), (4, 9.0, "b")]
    assert partitions(spark, schema) == [
        "day=2023-11-15/batch=a", "day=2023-11-16/batch=a", "day=2023-11-16/batch=b"]


def test_a_batch_run_again_replaces_itself(spark, schema):
    """Also its rows without a key, which match nothing, and days it no longer has."""
    put(spark, schema, "a", [(1, 0, 1.0)])
    rows = [(2, 0, 2.0), (None, 1, 2.0), (5, None, 2.0), (6, 3, 2.0)]
    assert put(spark, schema, "b'\\", rows) == {"source": 4, "inserted": 4}
    before = held(spark, schema)
    assert put(spark, schema, "b'\\", rows)["inserted"] == 4 and held(spark, schema) == before
    assert put(spark, schema, "b'\\", [(1, 0, 7.0), (2, 0, 7.0)])["inserted"] == 1
    assert [(k[1], v) for k, v, _ in held(spark, schema)] == [(1, 1.0), (2, 7.0)]
    assert len(partitions(spark, schema)) == 2
    assert put(spark, schema, "b'\\", []) == {"source": 0, "inserted": 0}
    assert partitions(spark, schema) == ["day=2023-11-15/batch=a"]


def test_a_write_that_was_killed_runs_again(spark, schema):
    """The write stops after some of its rows; nothing of it is seen, and the next run is whole."""
    put(spark, schema, "a", [(1, 0, 1.0)])
    broken = fires(spark, [(i, i % 3, 1.0) for i in range(2, 40)]).repartition(6).withColumn(
        "frp", F.when(F.col("id") == 30, F.raise_error(F.lit("lost")).cast("float")).otherwise(
            F.col("frp")))
    with pytest.raises(Exception, match="lost"):
        B.merge_batch(spark, schema, T.DETECTIONS_BRONZE, broken, "b")
    assert len(held(spark, schema)) == 1
    # a run that ended between its partitions: one day is there, another has old rows
    put(spark, schema, "b", [(3, 0, 5.0), (200, 4, 5.0)])
    assert put(spark, schema, "b", [(i, i % 3, 1.0) for i in range(2, 40)])["inserted"] == 38
    assert [(k[1], v) for k, v, _ in held(spark, schema)] == [(i, 1.0) for i in range(1, 40)]


def test_only_the_days_of_the_batch_are_read(spark, schema):
    for day in range(5):
        put(spark, schema, f"d{day}", [(10 * day + k, day, 1.0) for k in range(3)])
    days = B.in_days(date(2023, 11, 16), date(2023, 11, 17), False)
    known = B.known_rows(spark, schema, T.DETECTIONS_BRONZE, "d2", days)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1]
    assert "DataFilters: []" in plan
    assert sorted(r.id for r in known.collect()) == [10, 11, 12]
    # undated rows are looked for where undated rows are
    put(spark, schema, "e", [(99, None, 1.0)])
    assert put(spark, schema, "f", [(99, None, 2.0), (98, None, 2.0)])["inserted"] == 1


def test_a_merge_counts_no_table(spark, schema, monkeypatch):
    put(spark, schema, "a", [(1, 0, 1.0)])
    frame = type(spark.range(1))
    monkeypatch.setattr(frame, "count", lambda self: pytest.fail("a table was counted"))
    found = put(spark, schema, "b", [(1, 0, 3.0), (2, 1, 4.0)], most=F.max("frp"))
    assert found == {"source": 2, "inserted": 1, "most": 4.0}


def test_reports_are_compared_over_all_days(spark, schema):
    """A report dated anew under its id is still the same report."""
    rows = lambda *days: reports(spark, [
        {"id": i, "latitude": 45.0, "longitude": 30.0, "sec": T0 + DAY_S * d} for i, d in days]
    ).withColumn("global_event_id", F.concat(F.lit("E"), F.col("id")))
    name = T.REPORTS_BRONZE
    assert B.merge_batch(spark, schema, name, rows((1, 0), (2, 0)), "a")["inserted"] == 2
    assert B.merge_batch(spark, schema, name, rows((1, 9), (3, 9)), "b")["inserted"] == 1
    assert sorted((r.global_event_id, str(r.day)) for r in table(spark, schema, name).collect()) == [
        ("E1", "2023-11-15"), ("E2", "2023-11-15"), ("E3", "2023-11-24")]


def test_observed_counts_are_those_of_the_rows(spark):
    df = spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count()
    rows, seen = stored_observed(df, "seen", n=F.count(F.lit(1)), total=F.sum("count"))
    assert seen == {"n": 10, "total": 1000} and rows.count() == 10
    _, none = stored_observed(df.filter("k > 99"), "none", n=F.count(F.lit(1)), top=F.max("k"))
    assert none == {"n": 0, "top": None}


# Gold in buckets

def exchanges_of_gold(plan):
    """The exchanges above a scan of the table; broadcasts do not count."""
    lines = plan._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    found = []
    for k, line in enumerate(lines):
        if "FileScan" in line and "Bucketed: true" in line:
            at = depth(line)
            for above in reversed(lines[:k]):
                if depth(above) < at:
                    at = depth(above)
                    if "Exchange hashpartitioning" in above:
                        found.append(above)
    return found, sum("Bucketed: true" in line for line in lines)


def test_bucketed_gold_is_not_shuffled(spark, monkeypatch):
    name = f"s{uuid.uuid4().hex[:12]}"
    B.ensure_partitioned(spark, name, buckets=8)
    draw = random.Random(3)
    rows = lambda n, day: list({(d, e): (d, e, 0.5, 45.0, 30.0, day) for d, e in (
        (draw.randrange(300), draw.randrange(40)) for _ in range(n))}.values())
    first, second = rows(80, 0), rows(80, 0)
    assert insert(spark, name, first, "a")["inserted"] == len(first)
    known = {r[:2] for r in first}
    fresh = [r for r in second if r[:2] not in known]
    plans = []

    def seen(df, write, **metrics):
        plans.append(exchanges_of_gold(df))
        return observed(df, write, **metrics)

    monkeypatch.setattr(B, "observed", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = B.merge_batch(spark, name, GOLD, pairs(spark, second), "b", small_bytes=0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got["inserted"] == len(fresh) and plans == [([], 1)]
    best = best_per_report(table(spark, name, GOLD))
    assert exchanges_of_gold(best) == ([], 1)
    assert {r.acled_event_id for r in best.collect()} == {r[1] for r in first + second}


# The live view

def shown(df):
    return sorted(((r.acled_event_id is None, r.acled_event_id or 0), r.firms_detection_id,
                   round(r.map_lat, 9), round(r.map_lon, 9), round(r.score_display, 6))
                  for r in df.collect())


def insert(spark, schema, rows, batch):
    return B.merge_batch(spark, schema, GOLD, pairs(spark, rows), batch)


def test_an_inserted_row_shows_in_every_session(spark, schema):
    insert(spark, schema, [(1, 10, 0.5, 45.0, 30.0, 0), (2, 10, 0.4, 45.0, 30.0, 0)], "a")
    name = f"SELECT * FROM {T.qualified(schema, T.MAP_VIEW)}"
    view = views.serving_view(spark, schema)
    assert view.columns == list(MAP_COLUMNS) and [r.firms_detection_id for r in view.collect()] == [1]
    other = spark.newSession()
    assert other.sql(name).count() == 1
    insert(spark, schema, [(3, 10, 0.9, 45.0, 30.0, 1), (4, 5, 0.1, 45.0, 30.0, 1),
                           (5, 6, 0.001, 45.0, 30.0, 1)], "b")
    for rows in (spark.sql(name), spark.sql(f"SELECT * FROM {T.MAP_VIEW}"), other.sql(name),
                 views.read_map(other, schema), spark.newSession().sql(name)):
        found = {r.acled_event_id: (r.firms_detection_id, round(r.map_lat, 6)) for r in rows.collect()}
        assert found == {5: (4, 44.9955), 10: (3, 44.9965)}
    assert shown(views.read_map(spark, schema)) == shown(map_view(table(spark, schema, GOLD)))


@pytest.mark.parametrize("grid", [False, True])
def test_view_over_ids_of_all_ranges(spark, schema, grid):
    """Hashed ids, a crowded coordinate, ties, an id missing, scores at the limit."""
    draw = random.Random(4)
    ids = [draw.getrandbits(64) - 2 ** 63 for _ in range(120)] + [None, -1, 0, 2 ** 63 - 1, -2 ** 63]
    rows = [(draw.randrange(50), i, draw.choice([0.001, 0.002, 0.3, 0.3, 0.7]),
             45.0 if k % 3 else 46.0 + k % 5, 30.0, 0) for k, i in enumerate(ids) for _ in range(2)]
    insert(spark, schema, rows, "a")
    got = shown(views.serving_view(spark, schema, grid=grid))
    assert got == shown(map_view(table(spark, schema, GOLD), grid=grid)) and len(got) > 60


def test_the_view_holds_no_stored_stage(spark, schema):
    insert(spark, schema, [(1, 10, 0.5, 45.0, 30.0, 0)], "a")
    plan = views.serving_view(spark, schema)._jdf.queryExecution().executedPlan().toString()
    assert "stage-" not in plan and "WindowGroupLimit" in plan
    assert "BroadcastNestedLoop" not in plan and "CartesianProduct" not in plan


# The map kept up to date

def update(spark, schema, rows, batch, **options):
    insert(spark, schema, rows, batch)
    return incremental.update_map(spark, schema, B.batch_rows(spark, schema, GOLD, batch), **options)


def same_as_rebuilt(spark, schema):
    got = shown(incremental.published_map(spark, schema))
    assert got == shown(map_view(table(spark, schema, GOLD)))
    return got


def test_a_batch_reads_only_what_it_touches(spark, schema):
    """Two far places; the second batch has a report of one of them."""
    first = [(k, 100 + k, 0.5, 45.0, 30.0, 0) for k in range(12)]
    first += [(50 + k, 500 + k, 0.5, -20.0, 140.0, 0) for k in range(30)]
    assert update(spark, schema, first, "a") == dict(
        candidates=42, read=0, changed=42, tiles=2, written=42)
    got = update(spark, schema, [(90, 90, 0.7, 45.0, 30.0, 1), (91, 105, 0.1, 45.0, 30.0, 1)], "b")
    assert got == dict(candidates=2, read=12, changed=1, tiles=1, written=13)
    same_as_rebuilt(spark, schema)
    # nothing better, and nothing that reaches the score
    assert update(spark, schema, [(92, 501, 0.2, -20.0, 140.0, 2)], "c")["changed"] == 0
    assert update(spark, schema, [(93, 777, 0.001, 0.0, 0.0, 2)], "d")["candidates"] == 0
    assert update(spark, schema, [], "e")["candidates"] == 0
    same_as_rebuilt(spark, schema)


def test_a_report_that_moves(spark, schema):
    """Its old coordinate is numbered anew, or dropped where nothing is left there."""
    update(spark, schema, [(1, 10, 0.5, 45.0, 30.0, 0), (2, 11, 0.5, 45.0, 30.0, 0),
                           (3, 12, 0.5, 10.0, 10.0, 0)], "a")
    got = update(spark, schema, [(4, 10, 0.9, 60.0, 60.0, 1), (5, 12, 0.9, 60.0, 60.0, 1)], "b")
    assert got["changed"] == 2 and got["tiles"] == 3
    assert len(same_as_rebuilt(spark, schema)) == 3
    assert len(partitions(spark, schema, T.MAP_TABLE)) == 2
    # with a lower score the report stays where it is
    assert update(spark, schema, [(6, 10, 0.1, 0.0, 0.0, 2)], "c")["changed"] == 0
    same_as_rebuilt(spark, schema)


def test_a_rebuilt_map_has_no_old_tiles(spark, schema):
    update(spark, schema, [(1, 10, 0.5, 45.0, 30.0, 0), (2, 11, 0.5, -45.0, 30.0, 0)], "a")
    rows = map_view(table(spark, schema, GOLD).filter("acled_event_id = 11"))
    incremental.rebuild_map(spark, schema, rows)
    assert shown(incremental.published_map(spark, schema)) == shown(rows)
    incremental.rebuild_map(spark, schema, map_view(table(spark, schema, GOLD)))
    assert len(same_as_rebuilt(spark, schema)) == 2


def test_an_update_that_ended_half_way(spark, schema):
    """One of two tiles was replaced: the report is published twice until the batch runs again."""
    update(spark, schema, [(1, 10, 0.5, 45.0, 30.0, 0), (2, 11, 0.5, 45.0, 30.0, 0)], "a")
    name = T.qualified(schema, T.MAP_TABLE)
    insert(spark, schema, [(4, 10, 0.9, 60.0, 60.0, 1)], "b")
    new = B.batch_rows(spark, schema, GOLD, "b")
    half = map_view(new).withColumn("tile", incremental.tile(F.col("event_lat"), F.col("event_lon")))
    half.write.insertInto(name)
    spark.catalog.refreshTable(name)
    for changed in (1, 0):
        assert incremental.update_map(spark, schema, new)["changed"] == changed
        assert len(same_as_rebuilt(spark, schema)) == 2


@pytest.mark.parametrize("seed,move", [(1, True), (2, False)])
def test_any_sequence_of_batches(spark, schema, seed, move):
    """Random pairs with ties, crowded places, NULL reports and small tasks."""
    draw = random.Random(seed)
    place = lambda: (draw.choice([10.0, 10.5, 45.0]), draw.choice([-180.0, 30.0, 179.9999, 180.0]))
    fixed = {e: place() for e in [*range(12), None]}
    for k in range(4):
        rows = [(draw.randrange(100), e, draw.choice([0.001, 0.2, 0.4, 0.4]),
                 *(place() if move else fixed[e]), k)
                for e in draw.choices(list(fixed), k=14)]
        update(spark, schema, list({r[:2]: r for r in rows}.values()), f"b{k}",
               reports_may_move=move, rows_per_task=5)
        same_as_rebuilt(spark, schema)


# The daily run

def landed(spark, folder, shift, frp, day=0):
    """Six sites with two near detections and one report each."""
    start = T0 + DAY_S * day
    found = [(shift + 10 * s + i, 45.0 + s, 30.0, start + 600 * i) for s in range(6) for i in (0, 1)]
    events = [(shift + 500 + s, 45.01 + s, 30.0, start) for s in range(6)]
    r = reports(spark, as_rows(events)).withColumn("global_event_id", F.concat(F.lit("E"), F.col("id")))
    write_batch(detections(spark, as_rows(found, frp=frp)), f"{folder}/d", DETECTIONS)
    write_batch(r, f"{folder}/r", REPORTS)
    return f"{folder}/d", f"{folder}/r"


def test_run_batch(spark, schema, tmp_path):
    one, two = landed(spark, f"{tmp_path}/1", 0, 30.0), landed(spark, f"{tmp_path}/2", 1000, 30.0, 1)
    whole = dict(detections=12, new_detections=12, reports=6, new_reports=6, silver=6, pairs=6,
                 new_pairs=6, map_changed=6)
    first = daily.run_batch(spark, schema, "one", *one)
    assert first == whole | dict(map_read=0)
    again = daily.run_batch(spark, schema, "one", *one)
    assert again == whole | dict(map_changed=0, map_read=6)
    assert daily.run_batch(spark, schema, "other", *one)["new_pairs"] == 0
    assert daily.run_batch(spark, schema, "two", *two, audit=False)["new_pairs"] == 6
    assert same_as_rebuilt(spark, schema) == shown(views.read_map(spark, schema))
    assert spark.sql(f"SELECT count(*) AS n FROM {T.qualified(schema, T.MAP_VIEW)}").first().n == 12
    assert all(r.passed for r in daily.check_tables(spark, schema).collect())
    empty = str(tmp_path / "none")
    write_batch(detections(spark, []), empty, DETECTIONS)
    with pytest.raises(CheckFailed, match="silver_rows"):
        daily.run_batch(spark, schema, "three", empty, one[1])


def test_observed_contract(spark):
    residual = spark.createDataFrame([(2,)], "residual long")
    with pytest.raises(CheckFailed, match="score_min.*score_max.*residual_pairs"):
        require(observed_contract(spark, 3, residual, -0.5, 1.5))
    require(observed_contract(spark, 3, None, None, None))
