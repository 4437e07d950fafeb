"""Layer tables partitioned by day and batch, and merges into them that can be run again.

A merge reads the days that its batch can meet, writes partitions of its own, and replaces those an
earlier, perhaps half-finished run of the same batch has left. Nothing is counted by a scan: the
writes observe what they write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as S

from ..functions.clock import epoch_s
from ..operators.merge import ROW_BYTES, SMALL_KEYS_BYTES, new_rows
from ..plans.stages import observed, replace_partitions, setting, stored_observed
from ..schemas import CORRELATIONS, DETECTIONS, REPORTS, STAMPS, conform
from . import tables as T

DAY, BATCH = "day", "batch"
REPORT = "acled_event_id"


@dataclass(frozen=True)
class Layer:
    """A table: its columns, its key, and the time that names a row's day. ``key_has_time``: equal keys
    always share that time, so rows of other days need not be looked at."""

    schema: S.StructType
    keys: tuple[str, ...]
    time: str
    key_has_time: bool


LAYERS = {
    # the id is a hash of the time among others
    T.DETECTIONS_BRONZE: Layer(DETECTIONS, ("id",), "acq_datetime", True),
    # a report may be dated anew under its id
    T.REPORTS_BRONZE: Layer(REPORTS, ("global_event_id",), "event_datetime", False),
    T.CORRELATIONS_GOLD: Layer(CORRELATIONS, tuple(T.PAIR_KEY), "fire_acq_datetime", True),
}


def utc_day(time: Column) -> Column:
    """The UTC day, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(epoch_s(time) / 86_400).cast("int"))


def ensure_partitioned(
    spark: SparkSession, schema: str, file_format: str = "parquet", buckets: int | None = None
) -> None:
    """Creates the schema, its merged tables partitioned by day and batch, and silver; leaves what is
    there alone.

    With ``buckets`` gold lies in that many buckets by report in every partition. The pairs of a
    report are then together wherever they are read: the best of each report, the live view and the merge of
    a batch of any size take gold as it lies, without a shuffle of it; for the merge there should be
    as many buckets as shuffle partitions, or Spark prefers more tasks. A bucket is read by one task,
    so this is for gold in which no report has a large share of the pairs.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    for table, layer in LAYERS.items():
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layer.schema.fields)
        together = f" CLUSTERED BY ({REPORT}) INTO {buckets} BUCKETS" if (
            buckets and table == T.CORRELATIONS_GOLD) else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {T.qualified(schema, table)}"
                  f" ({ddl}, {DAY} DATE, {BATCH} STRING) USING {file_format}"
                  f" PARTITIONED BY ({DAY}, {BATCH}){together}")
    T.ensure_tables(spark, schema, file_format)  # those still missing


def in_days(first: date | None, last: date | None, without_day: bool) -> Column:
    """A filter on partitions: days of a closed range, and rows without a day if asked for."""
    found = F.lit(False) if first is None else F.col(DAY).between(F.lit(first), F.lit(last))
    return found | F.col(DAY).isNull() if without_day else found


def known_rows(spark: SparkSession, schema: str, table: str, batch: str, days: Column | None) -> DataFrame:
    """The rows of a table that other batches wrote, of the given days; both are tests of partitions."""
    rows = spark.table(T.qualified(schema, table)).filter(F.col(BATCH) != batch)
    return rows if days is None else rows.filter(days)


def merge_batch(spark: SparkSession, schema: str, table: str, source: DataFrame, batch: str,
                small_bytes: int = SMALL_KEYS_BYTES, **metrics: Column) -> dict:
    """Inserts the rows of ``source`` whose key the table does not hold yet, as partitions of
    ``batch``. The first value of a key stays; rows with a NULL key are all inserted, once.

    Gives ``source``, ``inserted`` and any ``metrics`` over the inserted rows. Running the same batch again
    replaces what its earlier run wrote, whether that ended or not: its own partitions are not
    compared with, the new ones are written over them, and days that are no longer written are dropped.
    Keys of a batch that take up to ``small_bytes`` are broadcast; then the table is not shuffled.
    """
    layer, name = LAYERS[table], T.qualified(schema, table)
    keys = list(layer.keys)
    key_bytes = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys),
                    F.lit(ROW_BYTES))
    staged, facts = stored_observed(
        conform(source, layer.schema, STAMPS).withColumn(DAY, utc_day(F.col(layer.time))), "batch",
        rows=F.count(F.lit(1)), first=F.min(DAY), last=F.max(DAY),
        undated=F.count_if(F.col(DAY).isNull()), bytes=F.coalesce(F.sum(key_bytes), F.lit(0)))
    days = in_days(facts["first"], facts["last"], facts["undated"] > 0) if layer.key_has_time else None
    fresh = new_rows(staged, known_rows(spark, schema, table, batch, days), keys,
                     small_source=facts["bytes"] <= small_bytes)
    rows = fresh.select(*layer.schema.names, DAY, F.lit(batch).alias(BATCH))
    # rows that lie together by one of the keys need not be dealt anew by all of them
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        found = observed(
            rows, lambda df: replace_partitions(df, name),
            inserted=F.count(F.lit(1)),
            # a batch spans a few days, and an archive load thousands at most
            days=F.collect_set(F.coalesce(F.col(DAY).cast("string"), F.lit(""))), **metrics)
    drop_partitions(spark, name, batch, kept=set(found.pop("days")))
    return {"source": facts["rows"]} | found


def drop_partitions(spark: SparkSession, name: str, batch: str, kept: set[str]) -> None:
    """Drops the partitions of a batch but those of the days ``kept`` ('' for none)."""
    for row in spark.sql(f"SHOW PARTITIONS {name} PARTITION ({BATCH} = {_quoted(batch)})").collect():
        text = row[0].split("/")[0].removeprefix(f"{DAY}=")
        day = "" if text in ("__HIVE_DEFAULT_PARTITION__", "null") else text
        if day not in kept:
            value = f"DATE'{day}'" if day else "NULL"
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION"
                      f" ({DAY} = {value}, {BATCH} = {_quoted(batch)})")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def batch_rows(spark: SparkSession, schema: str, table: str, batch: str) -> DataFrame:
    """The rows that a batch inserted, in the columns of the layer; only its partitions are read."""
    layer = LAYERS[table]
    return spark.table(T.qualified(schema, table)).filter(F.col(BATCH) == batch).select(
        *layer.schema.names)
