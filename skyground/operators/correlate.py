"""Detections x reports: distance and interval join with a score per pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions.clock import bucket, buckets, epoch_s, hours_between
from ..functions.geo import CircleGrid, great_circle_m, located
from ..functions.scoring import match_score
from ..schemas import CORRELATIONS
from .skew import hot_keys, split_hot

_CELL = ["_band", "_cell", "_slot"]
PAIR_COLUMNS = [f.name for f in CORRELATIONS.fields if f.name != "created_at"]


def correlate(
    detections: DataFrame,
    reports: DataFrame,
    radius_m: float = V.JOIN_RADIUS_M,
    lookback_s: int = V.JOIN_LOOKBACK_S,
    lookahead_s: int = V.JOIN_LOOKAHEAD_S,
    min_frp: float = V.MIN_FRP_MW,
    wrap: bool = True,
    rows_per_task: int = 50_000,
    crowds_from: DataFrame | None = None,
) -> DataFrame:
    """Every pair within ``radius_m`` whose report time lies in
    [detection - lookback, detection + lookahead], with distance, hours and score.

    Equality on grid cell and time slot makes it a hash or merge join. Reports, the smaller feed,
    are copied to the cells and slots they can match; the exact tests follow as the join condition.
    Cells crowded on either side are split. ``crowds_from`` names a cheaper superset of
    ``detections`` (such as its unfiltered source) to look for crowds in.
    """
    grid = CircleGrid(radius_m, wrap)
    slot_s = lookback_s + lookahead_s

    def fires(df: DataFrame) -> DataFrame:
        rows = df.select(
            F.col("id").alias("firms_detection_id"),
            F.col("latitude").alias("fire_lat"),
            F.col("longitude").alias("fire_lon"),
            F.col("acq_datetime").alias("fire_acq_datetime"),
            F.col("frp").alias("fire_frp"),
            F.col("confidence").alias("fire_confidence"),
            epoch_s(F.col("acq_datetime")).alias("_fire_s"),
        ).filter(
            (F.col("fire_frp") >= min_frp) & F.col("_fire_s").isNotNull()
            & located(F.col("fire_lat"), F.col("fire_lon")))
        return grid.home(rows, "fire_lat", "fire_lon", "_band", "_cell").withColumn(
            "_slot", bucket(F.col("_fire_s"), slot_s))

    events = reports.select(
        F.col("id").alias("acled_event_id"),
        F.col("latitude").alias("event_lat"),
        F.col("longitude").alias("event_lon"),
        F.col("event_datetime"),
        F.col("sub_event_type").alias("event_sub_event_type"),
        F.col("description").alias("event_description"),
        F.col("action_geo_fullname").alias("event_location_full_name"),
        F.col("source").alias("event_source"),
        F.col("num_sources").alias("event_num_sources"),
        epoch_s(F.col("event_datetime")).alias("_event_s"),
    ).filter(F.col("_event_s").isNotNull() & located(F.col("event_lat"), F.col("event_lon")))
    events = grid.touched(events, "event_lat", "event_lon", "_band", "_cell").withColumn(
        "_slot", F.explode(buckets(
            F.col("_event_s") - lookahead_s, F.col("_event_s") + lookback_s, slot_s)))

    crowds = fires(detections if crowds_from is None else crowds_from)
    left, right, on = split_hot(
        fires(detections), events, _CELL,
        left_hot=hot_keys(crowds, _CELL, rows_per_task), left_deal=["firms_detection_id"],
        right_hot=hot_keys(events, _CELL, rows_per_task), right_deal=["acled_event_id"])

    apart = great_circle_m(F.col("fire_lat"), F.col("fire_lon"),
                           F.col("event_lat"), F.col("event_lon")).cast("float")
    close = (
        F.col("_event_s").between(F.col("_fire_s") - lookback_s, F.col("_fire_s") + lookahead_s)
        & (apart <= radius_m)  # compared as the FLOAT that is stored
    )
    if not wrap:
        close = close & (F.abs(F.col("fire_lon") - F.col("event_lon")) <= 180)
    f, g = left.alias("f"), right.alias("g")
    same_cell = [F.col(f"f.{c}") == F.col(f"g.{c}") for c in on]
    pairs = (
        f.join(g, [*same_cell, close])
        .withColumn("distance_m", apart)
        .withColumn("time_delta_h", hours_between(F.col("_fire_s"), F.col("_event_s")))
    )
    score = match_score(
        F.col("fire_frp"), F.col("fire_confidence"), F.col("event_num_sources"),
        F.col("distance_m"), F.col("time_delta_h"), radius_m, slot_s / 3600.0)
    return pairs.withColumn("score", score).select(*PAIR_COLUMNS)
