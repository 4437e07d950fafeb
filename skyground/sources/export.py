"""Sorted JSON export of the map view, and the run metadata next to it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def utc_text(ts: Column) -> Column:
    """Timestamp as text in UTC, whatever the session time zone."""
    local = ts.cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local).cast("string")


def export_rows(
    view: DataFrame, digits: int = 5, extra: Sequence[Column] = ()
) -> DataFrame:
    """The 16 export columns, DOUBLEs rounded half up in decimal, and any ``extra`` ones."""
    shaped = view.select(
        "map_lat", "map_lon", "event_lat", "event_lon",
        F.col("score_display").cast("double").alias("score_display"),
        F.col("fire_frp").cast("double").alias("fire_frp"),
        "fire_confidence", "event_sub_event_type", "event_description",
        "event_location_full_name", "event_source",
        F.col("event_num_sources").cast("int").alias("event_num_sources"),
        utc_text(F.col("event_datetime")).alias("event_datetime"),
        utc_text(F.col("fire_acq_datetime")).alias("fire_acq_datetime"),
        F.col("distance_m").cast("double").alias("distance_m"),
        F.col("time_delta_h").cast("double").alias("time_delta_h"),
        *extra,
    )
    return shaped.select([
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in shaped.schema.fields
    ])


def write_export(view: DataFrame, path: str, as_array: bool = False) -> None:
    """JSON lines, best score first across and within files; NULL fields are written.

    Sorting is by ranges: no task holds the whole view, and the event id breaks up equal scores.
    With ``as_array`` the part files, put together in order, are one JSON array.
    """
    ordered = view.orderBy(F.col("score_display").desc(), "acled_event_id")
    if not as_array:
        export_rows(ordered).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
        return
    place = F.struct(-F.col("score_display"), F.col("acled_event_id"))
    ends = view.agg(F.min(place).alias("first"), F.max(place).alias("last"))
    columns = export_rows(view).columns
    # the event id tells the first and the last row; the export itself does not have it
    keyed = export_rows(ordered, extra=[place.alias("_place")])
    text = F.concat(
        F.when(F.col("_place") == ends.select("first").scalar(), "[").otherwise(","),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}),
        F.when(F.col("_place") == ends.select("last").scalar(), "]").otherwise(""))
    none = view.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit("[]").alias("value"))
    lines = keyed.select(text.alias("value"))
    none.unionByName(lines).write.mode("overwrite").text(path)


def total_in(document: Column) -> Column:
    """``total_events`` of a metadata document; 0 when the field or valid JSON is missing."""
    field = F.get_json_object(document, "$.total_events")
    return F.coalesce(field.try_cast("bigint"), F.lit(0).cast("bigint"))


def previous_total(spark: SparkSession, path: str) -> DataFrame:
    """One row ``total``: the last run's count, 0 when there is no readable file."""
    try:
        documents = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        documents = spark.createDataFrame([], "value string")
    return documents.agg(F.coalesce(F.max(total_in(F.col("value"))), F.lit(0)).alias("total"))


def run_metadata(view: DataFrame, previous: DataFrame) -> DataFrame:
    """``last_run_utc, total_events, events_added_last_run``; ``previous`` has one ``total``."""
    now_utc = utc_text(F.current_timestamp())
    now = view.agg(F.count(F.lit(1)).alias("now")).select("now", F.lit(0).alias("before"))
    then = previous.select(F.lit(0).alias("now"), F.col("total").alias("before"))
    return now.unionByName(then).agg(
        F.sum("now").alias("now"), F.sum("before").alias("before")
    ).select(
        F.concat_ws("T", F.substring(now_utc, 1, 10), F.concat(
            F.substring(now_utc, 12, 8), F.lit("+00:00"))).alias("last_run_utc"),
        F.col("now").alias("total_events"),
        (F.col("now") - F.col("before")).alias("events_added_last_run"),
    )
