"""Near-duplicate removal: points within a distance and a time of each other.

A row is dominated when a row with a higher id lies within both radii. Domination is a single
pass over the input: a dominated row still dominates others, so of a chain only the last row stays.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions.clock import bucket, buckets, epoch_s
from ..functions.geo import CircleGrid, great_circle_m, located
from .skew import hot_keys, split_hot

_SURE = ["_sure_band", "_sure_cell", "_sure_slot"]
_CELL = ["_band", "_cell", "_slot"]


def confident(df: DataFrame, column: str = "confidence") -> DataFrame:
    """Drops low-confidence rows, and with them rows without a confidence."""
    return df.filter(~F.lower(F.col(column)).isin(*V.LOW_CONFIDENCE))


def _dominated(
    df: DataFrame,
    radius_m: float = V.DEDUP_RADIUS_M,
    window_s: int = V.DEDUP_WINDOW_S,
    wrap: bool = True,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Ids of the dominated rows of ``df(id, latitude, longitude, acq_datetime)``; an id comes once
    or a few times.

    Work stays linear in the rows of a crowded place:

    0. Exact copies are combined before the first shuffle.
    1. In cells so small that all their rows are neighbours, only the highest id can survive.
       That is a maximum per cell, combined before the shuffle, and settles almost all rows of a
       crowd at once.
    2. The few rows left, at most one id per small cell, are compared with all rows of the grid
       cells around them. Rows of a crowded cell are dealt over several tasks.

    Sides that grow with the input are merged, never broadcast: many runs of the dedup, batch by batch, would
    otherwise each send the driver as much as Spark broadcasts.
    """
    # the id test is cheap and comes first, so larger cells with fewer copies pay here
    grid = CircleGrid(radius_m, wrap, span=4)
    points = df.select(
        "id",
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lon"),
        epoch_s(F.col("acq_datetime")).alias("_sec"),
    ).filter(
        F.col("id").isNotNull() & F.col("_sec").isNotNull()
        & located(F.col("_lat"), F.col("_lon"))
    ).distinct()  # combines copies map side; its shuffle is shared by all uses of points below

    crowded = grid.sure(points, "_lat", "_lon", "_sure_band", "_sure_cell").withColumn(
        "_sure_slot", bucket(F.col("_sec"), window_s + 1))
    leaders = crowded.groupBy(*_SURE).agg(F.max("id").alias("id"), F.lit(True).alias("_led"))
    # the id is part of the key, so a crowded cell does not gather in one task
    marked = crowded.join(leaders.hint("merge"), [*_SURE, "id"], "left").selectExpr(
        "id", "_lat", "_lon", "_sec", "_led IS NOT NULL AS _leads")

    # Leaders go to all cells and slots around them. The others are settled: they only pass
    # through, each under a key of its own that no point has.
    slot_s = max(3 * window_s, 1)
    probes = grid.touched(marked, "_lat", "_lon", "_band", "_cell", only="_leads").withColumns({
        "_cell": F.expr("if(_leads, _cell, id)"),
        "_slot": F.explode(F.when(F.col("_leads"), buckets(
            F.col("_sec") - window_s, F.col("_sec") + window_s, slot_s))
            .otherwise(F.expr("array(0L)"))),
    })
    others = grid.home(points, "_lat", "_lon", "_band", "_cell").withColumn(
        "_slot", bucket(F.col("_sec"), slot_s))
    probes, others, on = split_hot(
        probes, others, _CELL,
        right_hot=hot_keys(others, _CELL, rows_per_task), right_deal=["id"])

    mine = lambda c: F.col(f"p.{c}").outer()
    near = reduce(and_, [mine(c) == F.col(c) for c in on]) & (mine("id") < F.col("id"))
    near = near & (F.abs(mine("_sec") - F.col("_sec")) <= window_s)
    if not wrap:
        near = near & (F.abs(mine("_lon") - F.col("_lon")) <= 180)
    near = near & (great_circle_m(
        mine("_lat"), mine("_lon"), F.col("_lat"), F.col("_lon")) <= radius_m)
    # an existence test: a probe stops at its first match
    return probes.alias("p").where(~F.col("_leads") | others.where(near).hint("merge").exists()).select("id")


def dominated_ids(df: DataFrame, **options) -> DataFrame:
    """Distinct ids of the rows that a higher id dominates. Options are ``radius_m``,
    ``window_s``, ``wrap`` and ``rows_per_task``."""
    return _dominated(df, **options).distinct()


def proximity_dedup(df: DataFrame, **options) -> DataFrame:
    """Rows of ``df`` that no higher id dominates; rows without place or time all stay.

    ``df`` is computed twice, once for four columns and once whole, so it should be a table or a
    stored stage rather than the end of a long computation.
    """
    # Repeated ids do no harm here. With both sides straight from their shuffle, adaptive execution
    # can split an id that very many copies share.
    return df.join(_dominated(df, **options).hint("merge"), "id", "left_anti")


def residual_pairs(df: DataFrame, **options) -> DataFrame:
    """One row: how many ids are still dominated. Zero after :func:`proximity_dedup`."""
    return dominated_ids(df, **options).agg(F.count(F.lit(1)).alias("residual"))
