"""Silver batch by batch, with the ends of the batches in a table of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as V
from ..functions.clock import epoch_s
from ..operators.borders import POINT, dominated_across, near_ends, split_dominated
from ..sources import tables as T
from ..sources.batches import BATCH, DAY, drop_partitions, utc_day
from .stages import observed, replace_partitions, stored, stored_observed

BORDERS = "firms_silver_borders"


def ensure_borders(spark: SparkSession, schema: str) -> str:
    """Creates the table of ends where it is missing; its name."""
    name = T.qualified(schema, BORDERS)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (id BIGINT, latitude DOUBLE, longitude DOUBLE,"
              f" acq_datetime TIMESTAMP, kept BOOLEAN, {DAY} DATE, {BATCH} STRING) USING parquet"
              f" PARTITIONED BY ({DAY}, {BATCH})")
    return name


def dedup_batch(spark: SparkSession, schema: str, batch: str, detections: DataFrame,
                window_s: int = V.DEDUP_WINDOW_S, **options) -> tuple[DataFrame, DataFrame]:
    """The silver rows of a batch, compared with the ends of the other batches, and the ids of rows that
    those had kept and that this batch dominates.

    All silver rows so far, less all ids taken back, are the dedup of all batches, where their times
    do not overlap. Rows in the overlap of two batches and farther than ``window_s`` from the ends of
    both are the exception: they are not compared with each other. Rows without a time stay, as always.
    A batch that runs again replaces its own ends; rows it has made others take back stay so.
    """
    name = ensure_borders(spark, schema)
    second = epoch_s(F.col("acq_datetime"))
    points, ends = stored_observed(
        detections, "border-batch", first=F.min(second), last=F.max(second))
    first, last = ends["first"], ends["last"]
    if first is None:
        return points, spark.createDataFrame([], "id bigint")
    day = lambda s: F.date_from_unix_date(F.lit(s // 86_400))
    reach = (F.col(DAY) >= day(first - window_s)) & (F.col(DAY) <= day(last + window_s))
    others = spark.table(name).filter(F.col(BATCH) != batch).filter(reach).filter(
        second.between(first - window_s, last + window_s))
    neighbours = stored(others.select(*POINT, "kept", BATCH), "border-others")
    gone = stored(dominated_across(points, neighbours, window_s=window_s, **options), "border-gone")
    kept, back = split_dominated(points, neighbours, gone)
    back = stored(back, "border-back")

    own = near_ends(points.filter("id IS NOT NULL"), first, last, window_s).select(*POINT)
    marked = own.join(gone.withColumn("_gone", F.lit(True)).hint("merge"), "id", "left").select(
        *POINT, F.col("_gone").isNull().alias("kept"), utc_day(F.col("acq_datetime")).alias(DAY),
        F.lit(batch).alias(BATCH))
    found = observed(
        marked, lambda rows: replace_partitions(rows, name),
        days=F.collect_set(F.col(DAY).cast("string")))
    drop_partitions(spark, name, batch, kept=set(found["days"]))
    _take_back(spark, name, back)
    return kept, back


def _take_back(spark: SparkSession, name: str, back: DataFrame) -> None:
    """Marks rows as no longer kept, in the partitions that have some."""
    table = spark.table(name)
    touched = stored(table.join(back.hint("merge"), "id", "left_semi").filter("kept").select(DAY, BATCH).distinct(),
                     "border-touched")
    # a partition is a day of a batch near its ends, so there are a few
    rows = touched.collect()
    if not rows:
        return
    some = F.lit(False)
    for r in rows:
        some = some | ((F.col(DAY) == F.lit(r[DAY])) & (F.col(BATCH) == r[BATCH]))
    renewed = stored(table.filter(some).join(
        back.withColumn("_back", F.lit(True)).hint("merge"), "id", "left").select(
        *POINT, (F.col("kept") & F.col("_back").isNull()).alias("kept"), DAY, BATCH), "border-renewed")
    replace_partitions(renewed, name)
