"""Explicit schemas, applied at every read; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    """``name TYPE`` pairs, comma separated, to a StructType (no session needed)."""
    kinds = {
        "BIGINT": T.LongType(), "INT": T.IntegerType(), "SMALLINT": T.ShortType(),
        "DOUBLE": T.DoubleType(), "FLOAT": T.FloatType(), "STRING": T.StringType(),
        "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
    }
    fields = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields])


# Table schemas
DETECTIONS = _struct(
    "id BIGINT, acq_datetime TIMESTAMP, latitude DOUBLE, longitude DOUBLE, bright_ti4 FLOAT,"
    " bright_ti5 FLOAT, frp FLOAT, scan FLOAT, track FLOAT, satellite STRING, confidence STRING,"
    " daynight STRING, type SMALLINT, version STRING, ingested_at TIMESTAMP"
)
REPORTS = _struct(
    "id BIGINT, global_event_id STRING, event_date DATE, event_datetime TIMESTAMP,"
    " event_type STRING, sub_event_type STRING, description STRING, num_sources INT,"
    " actor1_name STRING, actor2_name STRING, action_geo_fullname STRING,"
    " action_geo_country STRING, fatalities INT, latitude DOUBLE, longitude DOUBLE,"
    " source STRING, ingested_at TIMESTAMP"
)
CORRELATIONS = _struct(
    "firms_detection_id BIGINT, acled_event_id BIGINT, fire_lat DOUBLE, fire_lon DOUBLE,"
    " fire_acq_datetime TIMESTAMP, fire_frp FLOAT, fire_confidence STRING, event_lat DOUBLE,"
    " event_lon DOUBLE, event_datetime TIMESTAMP, event_sub_event_type STRING,"
    " event_description STRING, event_location_full_name STRING, event_source STRING,"
    " event_num_sources INT, distance_m FLOAT, time_delta_h FLOAT, score FLOAT,"
    " created_at TIMESTAMP"
)
MAP_COLUMNS = (
    "firms_detection_id", "fire_acq_datetime", "fire_frp", "fire_confidence", "fire_lat",
    "fire_lon", "acled_event_id", "event_datetime", "event_sub_event_type", "event_description",
    "event_location_full_name", "event_source", "event_num_sources", "event_lat", "event_lon",
    "distance_m", "time_delta_h", "score", "score_display", "map_lat", "map_lon",
)

# Raw feed fields, all text
RAW_DETECTIONS = T.StructType([T.StructField(n, T.StringType()) for n in (
    "latitude", "longitude", "acq_date", "acq_time", "bright_ti4", "bright_ti5", "frp", "scan",
    "track", "satellite", "confidence", "daynight", "type", "version",
)])
RAW_REPORTS = T.StructType([T.StructField(n, T.StringType()) for n in (
    "event_id_cnty", "event_date", "event_type", "sub_event_type", "notes", "actor1", "actor2",
    "location", "country", "fatalities", "latitude", "longitude", "geo_precision", "source",
)])
RAW_REPORT_PAGE = T.StructType([T.StructField("data", T.ArrayType(RAW_REPORTS))])


#: Columns that a batch need not have; the tables fill them.
STAMPS = ("ingested_at", "created_at")


def conform(df, schema: T.StructType, absent=None):
    """Columns of ``schema`` in its order and types; missing ones become NULL.

    Rows that come from outside name the columns they may lack in ``absent``; any other missing one
    is an error then.
    """
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if absent is not None and (missing := [n for n in missing if n not in absent]):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.selectExpr(*[
        f"CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()})"
        f" AS `{f.name}`"
        for f in schema.fields
    ])
