"""The daily run: landed batches to bronze, silver, gold and the map view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.checks import (
    contract_checks, observed_contract, require, table_health, verification_summary,
)
from ..operators.correlate import correlate
from ..operators.proximity import confident, proximity_dedup, residual_pairs
from ..operators.ranking import map_view, top_pairs
from ..schemas import DETECTIONS, REPORTS
from ..sources import batches as B, tables as T
from ..sources.export import previous_total, run_metadata, write_export
from ..sources.landed import read_batch
from ..sources.views import read_map, serving_view
from .incremental import published_map, rebuild_map, update_map
from .stages import stored


def publish_map(spark: SparkSession, schema: str) -> DataFrame:
    """The map as a table of the schema, rebuilt from all of gold."""
    rebuild_map(spark, schema, map_view(spark.table(T.qualified(schema, T.CORRELATIONS_GOLD))))
    return published_map(spark, schema)


def run_day(
    spark: SparkSession,
    schema: str,
    detections_path: str,
    reports_path: str,
    ids_imply_time: bool = False,
) -> dict[str, int]:
    """One batch end to end. Each stage is computed once, written, and read back.

    Silver is rebuilt from this batch alone; bronze and gold only grow. With ``ids_imply_time``
    (true of the ids this library makes) merges read only the batch's time range of them. Raises
    :class:`~skyground.operators.checks.CheckFailed` when the result breaks the contract.
    """
    T.ensure_tables(spark, schema)
    detections = read_batch(spark, detections_path, DETECTIONS)
    reports = read_batch(spark, reports_path, REPORTS)
    in_detections, in_reports = T.merge_bronze(
        spark, schema, detections, reports, ids_imply_time)

    silver = T.write_silver(spark, schema, proximity_dedup(confident(detections)))
    pairs = stored(correlate(silver, reports), "pairs")
    gold = T.merge_gold(spark, schema, pairs, ids_imply_time)

    publish_map(spark, schema)
    serving_view(spark, schema)
    require(contract_checks(silver, spark.table(T.qualified(schema, T.CORRELATIONS_GOLD))))
    return {
        "detections": in_detections["source"], "new_detections": in_detections["inserted"],
        "reports": in_reports["source"], "new_reports": in_reports["inserted"],
        "pairs": gold["source"], "new_pairs": gold["inserted"],
    }


def run_batch(
    spark: SparkSession,
    schema: str,
    batch: str,
    detections_path: str,
    reports_path: str,
    audit: bool = True,
    reports_may_move: bool = True,
) -> dict[str, int]:
    """:func:`run_day` over tables partitioned by day and batch, for a long history.

    Merges read only the days the batch can meet, the map is brought up to date from the new pairs,
    and all counts are observed by the writes. A batch that failed anywhere is run again under its
    name: it replaces what the failed run left. ``audit`` repeats the proximity join over silver to see
    that nothing is left; scores are checked as they are inserted, so gold is not read for that.
    """
    B.ensure_partitioned(spark, schema)
    detections = read_batch(spark, detections_path, DETECTIONS)
    reports = read_batch(spark, reports_path, REPORTS)
    in_detections = B.merge_batch(spark, schema, T.DETECTIONS_BRONZE, detections, batch)
    in_reports = B.merge_batch(spark, schema, T.REPORTS_BRONZE, reports, batch)

    silver, kept = T.write_silver_observed(spark, schema, proximity_dedup(confident(detections)))
    pairs = correlate(silver, reports).withColumn("created_at", F.current_timestamp())
    gold = B.merge_batch(
        spark, schema, T.CORRELATIONS_GOLD, pairs, batch,
        score_min=F.min("score"), score_max=F.max("score"))
    on_map = update_map(
        spark, schema, B.batch_rows(spark, schema, T.CORRELATIONS_GOLD, batch),
        reports_may_move=reports_may_move)
    serving_view(spark, schema)
    require(observed_contract(
        spark, kept, residual_pairs(silver) if audit else None, gold["score_min"], gold["score_max"]))
    return {
        "detections": in_detections["source"], "new_detections": in_detections["inserted"],
        "reports": in_reports["source"], "new_reports": in_reports["inserted"],
        "silver": kept, "pairs": gold["source"], "new_pairs": gold["inserted"],
        "map_changed": on_map["changed"], "map_read": on_map["read"],
    }


def verify(spark: SparkSession, schema: str) -> tuple[DataFrame, DataFrame]:
    """Verification summary and the three best pairs."""
    gold = spark.table(T.qualified(schema, T.CORRELATIONS_GOLD))
    silver = spark.table(T.qualified(schema, T.DETECTIONS_SILVER))
    return verification_summary(silver, gold), top_pairs(gold)


def check_tables(spark: SparkSession, schema: str) -> DataFrame:
    """Health rows of the four tables."""
    names = (T.DETECTIONS_BRONZE, T.REPORTS_BRONZE, T.DETECTIONS_SILVER, T.CORRELATIONS_GOLD)
    return table_health(
        {n: spark.table(T.qualified(schema, n)) for n in names}, T.CORRELATIONS_GOLD)


def export(spark: SparkSession, schema: str, folder: str, previous: str,
           as_array: bool = True) -> None:
    """Map view and metadata as JSON under ``folder``; ``previous`` is the last run's metadata. The
    part files of the map, put together in order, are one array; JSON lines without ``as_array``."""
    view = stored(read_map(spark, schema), "map")
    metadata = run_metadata(view, previous_total(spark, previous))
    write_export(view, f"{folder}/events", as_array)
    # one row
    metadata.coalesce(1).write.mode("overwrite").json(f"{folder}/metadata")
