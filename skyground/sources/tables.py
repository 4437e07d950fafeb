"""The four layer tables: created once, filled by overwrite or insert-only merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.merge import insert_new
from ..plans.stages import observed
from ..schemas import CORRELATIONS, DETECTIONS, REPORTS, STAMPS, conform

# Table names
DETECTIONS_BRONZE = "firms_detections"
REPORTS_BRONZE = "acled_events"
DETECTIONS_SILVER = "firms_silver"
CORRELATIONS_GOLD = "fire_event_correlations"
MAP_VIEW = "gold_fire_event_map"
MAP_TABLE = "gold_fire_event_map_rows"

_SCHEMAS = {
    DETECTIONS_BRONZE: DETECTIONS,
    REPORTS_BRONZE: REPORTS,
    DETECTIONS_SILVER: DETECTIONS,
    CORRELATIONS_GOLD: CORRELATIONS,
}
PAIR_KEY = ["firms_detection_id", "acled_event_id"]


def qualified(schema: str, table: str) -> str:
    return f"`{schema}`.`{table}`"


def ensure_tables(spark: SparkSession, schema: str, file_format: str = "parquet") -> None:
    """Creates the schema and its tables where missing; leaves existing ones alone."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    for table, columns in _SCHEMAS.items():
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {qualified(schema, table)} ({ddl}) USING {file_format}")


def merge_bronze(
    spark: SparkSession,
    schema: str,
    detections: DataFrame,
    reports: DataFrame,
    ids_imply_time: bool = False,
):
    """New rows of a batch into the two bronze tables, keyed by id and by event id.

    ``ids_imply_time`` holds for detection ids made by this library. A report may be dated anew
    under its id, so its table is always compared as a whole.
    """
    return (
        insert_new(spark, conform(detections, DETECTIONS, STAMPS),
                   qualified(schema, DETECTIONS_BRONZE), ["id"],
                   "acq_datetime" if ids_imply_time else None),
        insert_new(spark, conform(reports, REPORTS, STAMPS),
                   qualified(schema, REPORTS_BRONZE), ["global_event_id"]),
    )


def write_silver(spark: SparkSession, schema: str, silver: DataFrame) -> DataFrame:
    """Replaces silver in the table's types and returns it read back, with its lineage cut."""
    table = qualified(schema, DETECTIONS_SILVER)
    conform(silver, DETECTIONS, STAMPS).write.mode("overwrite").insertInto(table, overwrite=True)
    return spark.table(table)


def write_silver_observed(
    spark: SparkSession, schema: str, silver: DataFrame
) -> tuple[DataFrame, int]:
    """:func:`write_silver`, and how many rows the write has written."""
    table = qualified(schema, DETECTIONS_SILVER)
    found = observed(
        conform(silver, DETECTIONS, STAMPS),
        lambda rows: rows.write.mode("overwrite").insertInto(table, overwrite=True),
        rows=F.count(F.lit(1)))
    return spark.table(table), found["rows"]


def merge_gold(
    spark: SparkSession, schema: str, pairs: DataFrame, ids_imply_time: bool = False
) -> dict[str, int]:
    """New pairs into gold with the time they were first seen; known pairs keep their score."""
    stamped = pairs.withColumn("created_at", F.current_timestamp())
    return insert_new(
        spark, conform(stamped, CORRELATIONS, STAMPS), qualified(schema, CORRELATIONS_GOLD), PAIR_KEY,
        "fire_acq_datetime" if ids_imply_time else None)
