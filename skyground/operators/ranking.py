"""Best row per group, ordinals within a group, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import fixed_values as V
from ..functions.display import date_prefix, score_text
from ..plans.stages import stored
from ..schemas import MAP_COLUMNS
from .skew import hot_keys


def best_per_report(pairs: DataFrame, min_score: float = V.SERVING_MIN_SCORE) -> DataFrame:
    """The highest-scoring detection of each report, if it reaches ``min_score``.

    The threshold is applied first: a best pair below it has no better one. Ties go to the lower
    detection id. Spark keeps one row per report and task before the shuffle.
    """
    best_first = Window.partitionBy("acled_event_id").orderBy(
        F.col("score").desc(), F.col("firms_detection_id").asc())
    return (
        pairs.filter(F.col("score").cast("double") >= min_score)
        .withColumn("_rank", F.row_number().over(best_first))
        .filter("_rank = 1")
        .drop("_rank")
    )


def ordinal_within(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    name: str,
    rows_per_task: int = 1_000_000,
    pieces: int = 256,
) -> DataFrame:
    """Adds the 0-based position of each row in its group, by ``order``.

    A group with more than ``rows_per_task`` rows is cut into ranges of ``order`` at approximate
    quantiles. Each range is numbered on its own and shifted by the size of those before it, which
    gives the exact position wherever the cuts fall.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*group))
    hot = hot_keys(df, group, rows_per_task, per_class=16)
    shares = F.array([F.lit(i / pieces) for i in range(1, pieces)])
    cuts = (
        # at most 1,024 hot groups with 255 cuts each: 2 MB
        hashed.join(F.broadcast(hot), "_hash", "left_semi")
        .groupBy("_hash")
        .agg(F.percentile_approx(order, shares, F.lit(8 * pieces)).alias("_cuts"))
    )
    # the cuts number the rows and shift them; written once, both see the same ones
    cuts = stored(cuts, "cuts")
    ranged = hashed.join(F.broadcast(cuts), "_hash", "left").withColumn(
        "_piece", F.coalesce(
            F.size(F.filter("_cuts", lambda cut: cut < F.col(order))), F.lit(0)))
    key = [*group, "_piece"]
    number = F.row_number().over(Window.partitionBy(*key).orderBy(order)).cast("bigint")
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(
        Window.unboundedPreceding, -1)
    # one row per range of a hot group
    sizes = (
        ranged.filter(F.col("_cuts").isNotNull()).groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_shift", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .drop("_size")
    )
    numbered = ranged.drop("_cuts", "_hash").withColumn("_number", number).alias("r")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in key]
    return numbered.join(F.broadcast(sizes.alias("s")), same, "left").select(
        *[F.col(f"r.{c}").alias(c) for c in df.columns],
        (F.col("r._number") - 1 + F.coalesce("s._shift", F.lit(0))).alias(name),
    )


def map_view(
    pairs: DataFrame,
    min_score: float = V.SERVING_MIN_SCORE,
    grid: bool = False,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """One map point per report, with reports at one coordinate spread around it.

    The longitude step grows by a tenth per report, which shears the lattice; ``grid`` gives
    straight columns of ten instead.
    """
    # one row a report, written once: numbering reads it several times, the pairs only here
    best = stored(best_per_report(pairs, min_score), "best")
    placed = ordinal_within(
        best, ["event_lat", "event_lon"], "acled_event_id", "_ordinal", rows_per_task)
    return spread(placed, grid)


def spread(placed: DataFrame, grid: bool = False) -> DataFrame:
    """Map columns of best pairs with their ``_ordinal`` at their coordinate."""
    row = (F.col("_ordinal") % 10).cast("double")
    column = F.col("_ordinal").cast("double") / 10
    if grid:
        column = F.floor(column).cast("double")
    return placed.select(
        "*",
        (F.col("score").cast("double") * V.DISPLAY_SCALE).alias("score_display"),
        (F.col("event_lat") + row * V.JITTER_STEP_DEG - V.JITTER_CENTRE_DEG).alias("map_lat"),
        (F.col("event_lon") + column * V.JITTER_STEP_DEG - V.JITTER_CENTRE_DEG).alias("map_lon"),
    ).select(*MAP_COLUMNS)


def top_pairs(pairs: DataFrame, k: int = 3) -> DataFrame:
    """The k best pairs, ties by ids."""
    return pairs.orderBy(
        F.col("score").desc(), "firms_detection_id", "acled_event_id"
    ).limit(k).select(
        "score", "distance_m", "time_delta_h", "fire_lat", "fire_lon", "fire_frp",
        "fire_confidence", "event_location_full_name", "event_sub_event_type")


def leaderboard(view: DataFrame, k: int = 10) -> DataFrame:
    """Rank, score text, place and month of the k best map points; no filter applies."""
    order = [F.col("score_display").desc(), F.col("acled_event_id").asc()]
    top = view.orderBy(*order).limit(k)
    # k rows, so the window over all of them is small
    return top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        score_text(F.col("score_display")).alias("score_text"),
        F.col("event_location_full_name").alias("place"),
        date_prefix(F.col("event_datetime").cast("string"), 7).alias("month"),
    )
