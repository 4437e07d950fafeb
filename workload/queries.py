"""Registered queries: each reads a whole scale-factor folder and returns one DataFrame.

Results leave out run times and hash ids, and round floating point values, so that they can be
compared across engines. Nullable integers are filled for the same reason.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skyground import fixed_values as V
from skyground.functions.clock import batch_days, epoch_s
from skyground.functions.parsing import decimal, key_hash, moment, settled, stripped
from skyground.operators import boxes, checks, exact, merge, ranking, serving, tiles
from skyground.operators.correlate import PAIR_COLUMNS, correlate
from skyground.operators.counts import counts_running
from skyground.operators.proximity import (
    confident, dominated_ids, proximity_dedup, residual_pairs,
)
from skyground.plans import borders, incremental, ledger, requests
from skyground.plans.stages import shared_folder, stored
from skyground.schemas import DETECTIONS, REPORTS, conform
from skyground.sources import batches, clustered, export, feeds, landed, views
from skyground.sources.tables import (
    CORRELATIONS_GOLD, DETECTIONS_BRONZE, DETECTIONS_SILVER, PAIR_KEY, ensure_tables, qualified,
    write_silver,
)

from . import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the example runs, within the days the events table covers.
TODAY = date(2024, 1, 20)
LAG_DAYS = 3
SECOND_BATCH_FROM = "2024-01-10"
FIRST_BATCH_UNTIL = "2024-01-16"

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _rounded(name: str, digits: int, alias: str | None = None) -> Column:
    return F.round(F.col(name).cast("double"), digits).alias(alias or name)


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("bigint"), F.lit(-1).cast("bigint")).alias(name)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proximity_dedup(confident(X.detections(spark, sf_dir)))


def _pairs(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    detections = confident(X.detections(spark, sf_dir))
    return correlate(
        proximity_dedup(detections), X.reports(spark, sf_dir, dense), crowds_from=detections)


def _gold(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    """Pairs as a stored table: the views on it read it more than once."""
    return stored(_pairs(spark, sf_dir, dense), "pairs")


def _view(spark: SparkSession, sf_dir: str, dense: bool = False, grid: bool = False) -> DataFrame:
    return ranking.map_view(_gold(spark, sf_dir, dense), grid=grid)


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the page reads, with the event id."""
    return export.export_rows(_view(spark, sf_dir), extra=[F.col("acled_event_id")])


# Proximity dedup

@query
def silver_dedup(spark, sf_dir):
    return _silver_columns(_silver(spark, sf_dir))


def _silver_columns(silver: DataFrame) -> DataFrame:
    return silver.select(
        "id", epoch_s(F.col("acq_datetime")).alias("acq_s"), "latitude", "longitude",
        _rounded("frp", 4), "confidence")


@query
def dominated(spark, sf_dir):
    return dominated_ids(confident(X.detections(spark, sf_dir)))


@query
def residual_after_dedup(spark, sf_dir):
    return residual_pairs(stored(_silver(spark, sf_dir).select(
        "id", "latitude", "longitude", "acq_datetime"), "silver"))


@query
def silver_across_batches(spark, sf_dir):
    """Batches of five days, the later half first, each compared with the ends of the others."""
    schema, rows = _own_schema("borders"), confident(X.detections(spark, sf_dir))
    step = F.floor(epoch_s(F.col("acq_datetime")) / (5 * 86_400))
    silver, taken_back = [], []
    for k in sorted((r[0] for r in rows.select(step).distinct().collect()), key=lambda k: (k % 2, k)):
        kept, back = borders.dedup_batch(spark, schema, f"b{k}", rows.filter(step == k))
        silver.append(kept)
        taken_back.append(back)
    whole = reduce(DataFrame.unionByName, silver).join(
        reduce(DataFrame.unionByName, taken_back).hint("merge"), "id", "left_anti")
    return _silver_columns(whole)


@query
def residual_before_dedup(spark, sf_dir):
    """The audit where there is something to find."""
    return residual_pairs(confident(X.detections(spark, sf_dir)))


# Correlation and serving

@query
def candidates_scored(spark, sf_dir):
    return _pairs(spark, sf_dir).select(
        "firms_detection_id", "acled_event_id", "fire_lat", "fire_lon",
        epoch_s(F.col("fire_acq_datetime")).alias("fire_s"), _rounded("fire_frp", 4),
        "fire_confidence", "event_lat", "event_lon",
        epoch_s(F.col("event_datetime")).alias("event_s"), "event_sub_event_type",
        "event_description", "event_location_full_name", "event_source",
        _filled("event_num_sources"), _rounded("distance_m", 3), _rounded("time_delta_h", 5),
        _rounded("score", 6))


@query
def best_match(spark, sf_dir):
    return ranking.best_per_report(_pairs(spark, sf_dir)).select(
        "acled_event_id", "firms_detection_id", _rounded("score", 6))


def _map_columns(view: DataFrame) -> DataFrame:
    return view.select(
        "firms_detection_id", "acled_event_id", "event_sub_event_type",
        "event_location_full_name", _rounded("distance_m", 3), _rounded("time_delta_h", 5),
        _rounded("score_display", 3), _rounded("map_lat", 6), _rounded("map_lon", 6))


@query
def map_view(spark, sf_dir):
    return _map_columns(_view(spark, sf_dir))


@query
def map_view_dense(spark, sf_dir):
    return _map_columns(_view(spark, sf_dir, dense=True))


@query
def map_view_straight_grid(spark, sf_dir):
    return _map_columns(_view(spark, sf_dir, dense=True, grid=True))


@query
def top_pairs(spark, sf_dir):
    return ranking.top_pairs(_pairs(spark, sf_dir)).select(
        _rounded("score", 6), _rounded("distance_m", 3), _rounded("time_delta_h", 5), "fire_lat",
        "fire_lon", _rounded("fire_frp", 4), "fire_confidence", "event_location_full_name",
        "event_sub_event_type")


@query
def leaderboard(spark, sf_dir):
    return ranking.leaderboard(_exported(spark, sf_dir))


@query
def export_rows(spark, sf_dir):
    rows = export.export_rows(_view(spark, sf_dir))
    return rows.withColumns({
        "event_num_sources": _filled("event_num_sources"),
        "score_display": _rounded("score_display", 3), "distance_m": _rounded("distance_m", 3),
    })


@query
def run_metadata(spark, sf_dir):
    """Against the metadata of a run that ended before the later reports came."""
    view = _view(spark, sf_dir)
    earlier = view.filter(
        F.col("event_datetime").cast("date") < F.lit(FIRST_BATCH_UNTIL).cast("date"))
    document = export.run_metadata(earlier, spark.range(1).select(
        F.lit(0).cast("bigint").alias("total"))).select(
        F.to_json(F.struct("total_events", "events_added_last_run")).alias("value"))
    previous = document.agg(F.max(export.total_in(F.col("value"))).alias("total"))
    iso = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\+00:00$"
    return export.run_metadata(view, previous).withColumn(
        "last_run_utc", F.col("last_run_utc").rlike(iso)).withColumnRenamed(
        "last_run_utc", "is_iso")


@query
def visible_events(spark, sf_dir):
    rows = serving.visible(
        export.export_rows(_view(spark, sf_dir)), min_score=5, air=False,
        date_from="2024-01-05", date_to="2024-01-25")
    return rows.select(
        "map_lat", "map_lon", "event_location_full_name", "event_sub_event_type",
        "event_datetime", _rounded("score_display", 3))


@query
def date_range(spark, sf_dir):
    return serving.date_range(export.export_rows(_view(spark, sf_dir)))


@query
def marker_style(spark, sf_dir):
    return serving.marker_style(_exported(spark, sf_dir)).select(
        "acled_event_id", "colour", _rounded("radius", 4))


@query
def popup_text(spark, sf_dir):
    return serving.popup_text(_exported(spark, sf_dir)).select(
        "acled_event_id", "score_text", "confidence_text", "frp_text", "sources_text",
        "distance_text", "source_list", "date_text")


# Raw feeds

@query
def feed_a_normalised(spark, sf_dir):
    routed = feeds.route_detections(X.raw_detections(spark, sf_dir))
    kept = routed.filter("reason = 'ok'").drop("reason", "warnings")
    return exact.first_per_key(kept, feeds.DETECTION_KEY).select(
        epoch_s(F.col("acq_datetime")).alias("acq_s"), "latitude", "longitude", "bright_ti4",
        "frp", "satellite", "confidence", "daynight", _filled("type"), "version")


@query
def feed_a_rejects(spark, sf_dir):
    return feeds.reason_counts(feeds.route_detections(X.raw_detections(spark, sf_dir)))


@query
def feed_a_quality(spark, sf_dir):
    return feeds.quality_report(
        feeds.route_detections(X.raw_detections(spark, sf_dir)), feeds.DETECTION_KEY)


@query
def feed_b_normalised(spark, sf_dir):
    return _reports_compared(feeds.normalise_reports(X.raw_reports(spark, sf_dir)))


def _reports_compared(reports: DataFrame) -> DataFrame:
    return reports.select(
        "global_event_id", F.col("event_date").cast("string").alias("event_date"),
        epoch_s(F.col("event_datetime")).alias("event_s"), "event_type", "sub_event_type",
        "description", _filled("num_sources"), "actor1_name", "actor2_name",
        "action_geo_fullname", "action_geo_country", _filled("fatalities"), "latitude",
        "longitude", "source")


@query
def feed_b_rejects(spark, sf_dir):
    return feeds.reason_counts(feeds.route_reports(X.raw_reports(spark, sf_dir)))


@query
def feed_b_quality(spark, sf_dir):
    return feeds.quality_report(
        feeds.route_reports(X.raw_reports(spark, sf_dir)), feeds.REPORT_KEY)


@query
def feed_b_requested(spark, sf_dir):
    return feeds.select_reports(
        X.raw_reports(spark, sf_dir), "2024-01-05", "2024-01-25"
    ).select("event_id_cnty", "country", "event_date", "notes")


@query
def feed_b_country_counts(spark, sf_dir):
    return counts_running(X.raw_reports(spark, sf_dir), "country", V.REPORT_COUNTRIES)


@query
def feed_key_stability(spark, sf_dir):
    """Ids are equal for equal keys, whatever order and however often the rows come."""
    rows = feeds.normalise_detections(X.raw_detections(spark, sf_dir))
    again = feeds.normalise_detections(
        X.raw_detections(spark, sf_dir).unionByName(X.raw_detections(spark, sf_dir)))
    both = rows.unionByName(again).groupBy(*feeds.DETECTION_KEY).agg(
        F.min("id").alias("low"), F.max("id").alias("high"),
        F.first(key_hash(*feeds.DETECTION_KEY)).alias("own"))
    per_id = both.groupBy("low").agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if((F.col("low") != F.col("high")) | (F.col("low") != F.col("own")))
        .alias("unstable"))
    return per_id.agg(
        F.sum("keys").alias("keys"), F.count(F.lit(1)).alias("ids"),
        F.sum("unstable").alias("unstable"))


# Landed files, written to the shared folder and read back

def _landing(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/landing-{name}-{uuid.uuid4().hex}"


def _land_lines(lines: DataFrame, header: str, path: str) -> None:
    """Text files that all begin with the header."""
    # the number of a row within its part
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines.select(F.when(first, F.concat(F.lit(f"{header}\n"), F.col("value"))).otherwise(
        F.col("value"))).write.text(path)


def _broken() -> Column:
    """'short' and 'long' for some rows."""
    own, night = F.col("bright_ti4"), F.col("daynight") == "N"
    return F.when(night & own.endswith("5"), "short").when(
        night & own.endswith("7"), "long").otherwise("")


@query
def feed_a_from_files(spark, sf_dir):
    """Files of two products with other columns in another order, through the normaliser and the
    batch that the daily job reads."""
    path, raw = _landing(spark, "a"), X.raw_detections(spark, sf_dir)
    for name, own, columns in (("one", F.col("satellite") == "N", raw.columns),
                               ("two", F.col("satellite") != "N", [*reversed(raw.columns)])):
        raw.filter(own).select(*columns).write.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        ).csv(f"{path}/{name}")
    rows = feeds.normalise_detections(landed.read_detection_files(spark, path))
    landed.write_batch(rows, f"{path}-batch", DETECTIONS)
    return landed.read_batch(spark, f"{path}-batch", DETECTIONS).select(
        epoch_s(F.col("acq_datetime")).alias("acq_s"), "latitude", "longitude",
        F.col("bright_ti4").cast("double").alias("bright_ti4"), _rounded("frp", 4), "satellite",
        "confidence", "daynight", _filled("type"), "version")


@query
def feed_a_malformed(spark, sf_dir):
    """Reasons of records some of which lack their last field or have one too many."""
    path, raw = _landing(spark, "malformed"), X.raw_detections(spark, sf_dir)
    fields = [F.when(F.col(c).contains(","), F.concat(F.lit('"'), F.col(c), F.lit('"'))).otherwise(
        F.coalesce(c, F.lit(""))) for c in raw.columns]
    kind = _broken()
    text = F.when(kind == "short", F.concat_ws(",", *fields[:-1])).when(
        kind == "long", F.concat_ws(",", *fields, F.lit("extra"))).otherwise(
        F.concat_ws(",", *fields))
    _land_lines(raw.select(text.alias("value")), ",".join(raw.columns), path)
    rows = landed.read_detection_files(spark, path, malformed=True, pattern="part-*")
    return feeds.reason_counts(feeds.route_detections(rows))


@query
def feed_b_from_pages(spark, sf_dir):
    """Pages of fifty reports and one without any, through the normaliser and the batch."""
    path, raw = _landing(spark, "b"), X.raw_reports(spark, sf_dir)
    paged = raw.withColumn("page", F.pmod(F.xxhash64("event_id_cnty"), F.lit(40)))
    whole = paged.groupBy("page").agg(F.collect_list(F.struct(*raw.columns)).alias("data"))
    whole.select("page", F.to_json(F.struct("data")).alias("value")).repartition(8, "page").write.partitionBy(
        "page").text(f"{path}/pages")
    spark.range(1).select(F.lit('{"count": 0}').alias("value")).write.text(f"{path}/pages/page=none")
    rows = feeds.normalise_reports(landed.read_report_files(spark, f"{path}/pages"))
    landed.write_batch(rows, f"{path}-batch", REPORTS)
    return _reports_compared(landed.read_batch(spark, f"{path}-batch", REPORTS))


@query
def export_order(spark, sf_dir):
    """The exported files read back: every row's place in them."""
    path = _landing(spark, "export")
    export.write_export(_view(spark, sf_dir), path)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"), "value")
    place = F.row_number().over(Window.orderBy("file", "line"))
    found = F.from_json("value", "map_lat double, map_lon double, score_display double")
    return lines.select(place.cast("bigint").alias("place"), found.alias("r")).select(
        "place", _rounded("r.map_lat", 5, "map_lat"), _rounded("r.map_lon", 5, "map_lon"),
        _rounded("r.score_display", 3, "score_display"))


@query
def missing_ranges(spark, sf_dir):
    """Planned days of the detection feed that did not land: some chunks failed, some had no rows."""
    path, days, rows = _landing(spark, "chunks"), *_landed_rows(spark, sf_dir)
    planned = requests.request_list(days)
    first = days.select("first_day").scalar()
    chunk = F.floor(F.date_diff(F.col("d"), first) / V.MAX_DAYS_PER_REQUEST).cast("int")
    start = F.date_add(first, chunk * V.MAX_DAYS_PER_REQUEST)
    pulled = rows.withColumn("chunk_start", start).join(
        planned.select("region", "product", "chunk_start", "chunk_days"),
        ["region", "product", "chunk_start"])
    failed = (chunk % 3 == 1) & (F.col("product") == V.RECENT_PRODUCTS[0])
    pulled.filter(~failed).select(
        "region", "product", "chunk_start", "chunk_days", "latitude", "longitude").write.partitionBy(
        "region", "product", "chunk_start", "chunk_days").csv(path)
    files = ledger.file_ledger(spark, path)
    return ledger.missing_ranges(planned, files, ledger.row_ledger(
        rows.filter((F.col("product") == V.RECENT_PRODUCTS[0]) & (F.dayofmonth("d") == 8)), "d")).select(
        "region", "product", F.col("first_day").cast("string").alias("first_day"),
        F.col("last_day").cast("string").alias("last_day"), "days")


# Boxes and request planning

@query
def in_any_box(spark, sf_dir):
    return boxes.keep_in_boxes(X.detections(spark, sf_dir)).select("id", "latitude", "longitude")


@query
def in_box_table(spark, sf_dir):
    around = X.reports(spark, sf_dir).select(
        (F.col("latitude") - 0.05).alias("min_lat"), (F.col("latitude") + 0.05).alias("max_lat"),
        (F.col("longitude") - 0.05).alias("min_lon"), (F.col("longitude") + 0.05).alias("max_lon"))
    return boxes.keep_in_box_table(X.detections(spark, sf_dir), around).select("id")


@query
def in_tiled_boxes(spark, sf_dir):
    """Detections in boxes of all sizes: a tenth of a degree around reports, and three countries."""
    around = X.reports(spark, sf_dir).filter("id % 3 = 0").select(
        (F.col("latitude") - 0.05).alias("min_lat"), (F.col("latitude") + 0.05).alias("max_lat"),
        (F.col("longitude") - 0.05).alias("min_lon"), (F.col("longitude") + 0.05).alias("max_lon"))
    some = [tuple(map(float, b[1:])) for b in V.COUNTRY_BOXES if b[0] in ("UP", "SY", "KU")]
    whole = spark.createDataFrame(some, "min_lat double, max_lat double, min_lon double, max_lon double")
    return tiles.keep_in_tiled_boxes(
        X.detections(spark, sf_dir), around.unionByName(whole)).select("id")


@query
def boxes_from_clustered(spark, sf_dir):
    """The detections of three countries, from files in a space-filling order."""
    path = _landing(spark, "clustered")
    clustered.write_clustered(X.detections(spark, sf_dir), path, files=24)
    some = [b for b in V.COUNTRY_BOXES if b[0] in ("UP", "RS", "KU")]
    return clustered.read_boxes(spark, path, some).select("id", "latitude", "longitude")


@query
def region_pulls(spark, sf_dir):
    return boxes.pull_regions(X.detections(spark, sf_dir)).select("region", "id")


@query
def date_chunks(spark, sf_dir):
    """The request chunks that cover the active days of each site."""
    seen = X.detections(spark, sf_dir).select(
        "latitude", "longitude", F.col("acq_datetime").cast("date").alias("d"))
    spans = seen.groupBy(
        F.round("latitude").cast("bigint").alias("lat_deg"),
        F.round("longitude").cast("bigint").alias("lon_deg"),
    ).agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"))
    return requests.date_chunks(spans, "first_day", "last_day").select(
        "lat_deg", "lon_deg", F.col("chunk_start").cast("string").alias("chunk_start"),
        F.col("chunk_days").cast("bigint").alias("chunk_days"))


def _landed_rows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """First and last landed day, and a row for each region a dated row lies in, with its product."""
    raw = X.raw_detections(spark, sf_dir)
    dated = stored(settled(raw.select(
        decimal(stripped(F.col("latitude"))).alias("latitude"),
        decimal(stripped(F.col("longitude"))).alias("longitude"), "satellite",
        moment(F.col("acq_date"), F.col("acq_time")).cast("date").alias("d"),
    )).filter(F.col("d").isNotNull()), "dated")
    days = dated.agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"))
    return days, boxes.pull_regions(dated).withColumn(
        "product", F.when(F.col("satellite") == "N", V.RECENT_PRODUCTS[0])
        .otherwise(V.RECENT_PRODUCTS[1]))


@query
def request_list(spark, sf_dir):
    """Every region x product x chunk of the landed days, with its rows and a running total."""
    days, rows = _landed_rows(spark, sf_dir)
    tasks = requests.request_list(days)
    first = days.select("first_day").scalar()
    whole_chunks = F.floor(F.date_diff(F.col("d"), first) / V.MAX_DAYS_PER_REQUEST).cast("int")
    counts = (
        rows.withColumn("chunk_start", F.date_add(first, whole_chunks * V.MAX_DAYS_PER_REQUEST))
        .groupBy("region", "product", "chunk_start").agg(F.count(F.lit(1)).alias("landed"))
    )
    so_far = Window.partitionBy("region", "product").orderBy("chunk_start").rowsBetween(
        Window.unboundedPreceding, 0)
    listed = tasks.join(counts, ["region", "product", "chunk_start"], "left").withColumn(
        "landed", F.coalesce("landed", F.lit(0)))
    return listed.select(
        "region", "product", F.col("chunk_start").cast("string").alias("chunk_start"),
        F.col("chunk_days").cast("bigint").alias("chunk_days"), "landed",
        F.sum("landed").over(so_far).alias("running"))


@query
def batch_window(spark, sf_dir):
    """The rows of both feeds in the rolling batch of one day."""
    parts = []
    for feed, df, column, extra in (
        ("detections", X.detections(spark, sf_dir), "acq_datetime", False),
        ("reports", X.reports(spark, sf_dir), "event_datetime", True),
    ):
        first, last = batch_days(TODAY, LAG_DAYS, extra_day=extra)
        on_day = F.col(column).cast("date")
        parts.append(requests.in_days(df, on_day, first, last).select(
            F.lit(feed).alias("feed"), "id", on_day.cast("string").alias("day")))
    return parts[0].unionByName(parts[1])


# Merges and table form

def _two_batches(spark, sf_dir):
    """Overlapping batches; the second one reports twice the intensity."""
    rows = X.detections(spark, sf_dir)
    on_day = F.col("acq_datetime").cast("date")
    return (
        rows.filter(on_day < F.lit(FIRST_BATCH_UNTIL).cast("date")),
        rows.filter(on_day >= F.lit(SECOND_BATCH_FROM).cast("date"))
        .withColumn("frp", (F.col("frp") * 2).cast("float")),
    )


@query
def merge_detections(spark, sf_dir):
    first, second = _two_batches(spark, sf_dir)
    return merge.merge_frames(first, second, ["id"]).select("id", _rounded("frp", 4))


@query
def merge_pairs_first_wins(spark, sf_dir):
    reports = X.reports(spark, sf_dir)
    found = []
    for batch in _two_batches(spark, sf_dir):
        kept = confident(batch)
        found.append(stored(correlate(
            proximity_dedup(kept), reports, crowds_from=kept), "batch"))
    return merge.merge_frames(*found, PAIR_KEY).select(
        *PAIR_KEY, _rounded("score", 6))


def _own_schema(name: str) -> str:
    """A schema of this run alone; its tables are in the warehouse, which the cluster shares."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def _by_fire_day(pairs: DataFrame) -> list[DataFrame]:
    """Pairs in three batches of days, the last of which repeats a part of the second."""
    on_day = F.col("fire_acq_datetime").cast("date")
    first, second = (F.lit(d).cast("date") for d in (SECOND_BATCH_FROM, FIRST_BATCH_UNTIL))
    return [pairs.filter(on_day < first), pairs.filter(on_day.between(first, second)),
            pairs.filter(on_day >= second)]


@query
def merge_partitioned(spark, sf_dir):
    """Two overlapping batches in tables by day and batch; the first one is run twice."""
    schema = _own_schema("merged")
    batches.ensure_partitioned(spark, schema)
    first, second = _two_batches(spark, sf_dir)
    for name, rows in (("one", first), ("one", first), ("two", second)):
        batches.merge_batch(spark, schema, DETECTIONS_BRONZE, rows, name)
    return spark.table(qualified(schema, DETECTIONS_BRONZE)).select(
        "id", _rounded("frp", 4), F.col("day").cast("string").alias("day"), "batch")


@query
def serving_view_live(spark, sf_dir):
    """The view is made over the first batch of pairs and read after the others were inserted."""
    schema = _own_schema("live")
    batches.ensure_partitioned(spark, schema)
    for k, rows in enumerate(_by_fire_day(_gold(spark, sf_dir, dense=True))):
        batches.merge_batch(spark, schema, CORRELATIONS_GOLD, rows, f"batch{k}")
        if k == 0:
            views.serving_view(spark, schema)
    return _map_columns(views.read_map(spark, schema))


@query
def map_incremental(spark, sf_dir):
    """The map table after three batches of pairs, each of which updates it."""
    schema = _own_schema("map")
    batches.ensure_partitioned(spark, schema)
    for k, rows in enumerate(_by_fire_day(_gold(spark, sf_dir, dense=True))):
        batches.merge_batch(spark, schema, CORRELATIONS_GOLD, rows, f"batch{k}")
        incremental.update_map(
            spark, schema, batches.batch_rows(spark, schema, CORRELATIONS_GOLD, f"batch{k}"))
    return _map_columns(incremental.published_map(spark, schema))


@query
def silver_table(spark, sf_dir):
    """Silver's table filled with all confident rows, then replaced by the dedup, and read by name."""
    schema = _own_schema("silver")
    ensure_tables(spark, schema)
    rows = confident(X.detections(spark, sf_dir))
    write_silver(spark, schema, rows)
    write_silver(spark, schema, proximity_dedup(rows))
    return _silver_columns(spark.sql(f"SELECT * FROM {qualified(schema, DETECTIONS_SILVER)}"))


@query
def silver_schema_cast(spark, sf_dir):
    """A batch with wide types, as other writers leave it, in the types of the table."""
    wide = X.detections(spark, sf_dir).withColumns({
        "frp": F.col("frp").cast("double"), "bright_ti4": F.col("id") / 3.0,
        "type": (F.col("id") % 4).cast("bigint"),
    })
    narrow = conform(wide, DETECTIONS)
    return narrow.select(
        "id", F.col("frp").cast("double").alias("frp"),
        F.col("bright_ti4").cast("double").alias("bright_ti4"), _filled("type"),
        F.typeof("frp").alias("frp_type"), F.typeof("type").alias("type_type"))


# Counts and checks

@query
def stage_counts(spark, sf_dir):
    detections = X.detections(spark, sf_dir)
    reports = X.reports(spark, sf_dir)
    silver = stored(_silver(spark, sf_dir), "silver")
    pairs = stored(correlate(silver, reports), "pairs")
    return checks.row_counts({
        "detections": detections, "reports": reports, "silver": silver, "pairs": pairs,
        "map": ranking.best_per_report(pairs),
    })


@query
def removed_by_dedup(spark, sf_dir):
    return checks.removed(X.detections(spark, sf_dir), _silver(spark, sf_dir))


@query
def score_stats(spark, sf_dir):
    stats = checks.score_stats(_pairs(spark, sf_dir))
    return stats.select([_rounded(c, 4 if c.startswith("score") else 2) for c in stats.columns])


@query
def contract_checks(spark, sf_dir):
    silver = stored(_silver(spark, sf_dir), "silver")
    rows = checks.contract_checks(silver, correlate(silver, X.reports(spark, sf_dir)))
    return rows.withColumn("value", F.round("value", 5))


@query
def verification_summary(spark, sf_dir):
    silver = stored(_silver(spark, sf_dir), "silver")
    pairs = stored(correlate(silver, X.reports(spark, sf_dir)), "pairs")
    rows = checks.verification_summary(silver, pairs)
    return rows.withColumn("value", F.round("value", 4))


@query
def table_health(spark, sf_dir):
    silver = stored(_silver(spark, sf_dir), "silver")
    reports = X.reports(spark, sf_dir)
    return checks.table_health({
        "detections": X.detections(spark, sf_dir), "reports": reports, "silver": silver,
        "pairs": stored(correlate(silver, reports), "pairs"),
    }, "pairs")


assert set(PAIR_KEY) < set(PAIR_COLUMNS)
