"""Detections, reports and raw feeds derived from the ``events`` table.

One SQL text per table serves Spark and DuckDB; only the clock and the row copier differ. Every
user is a site at least one degree from all others, detections scatter around it and reports lie on
a small lattice. Coordinates are integers divided once, so both engines hold the same double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyground.fixed_values import REPORT_COUNTRIES
from skyground.schemas import DETECTIONS, RAW_DETECTIONS, RAW_REPORTS, REPORTS, conform

_ENGINE = {
    "spark": {
        "sec": "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', "
               "CAST(ts AS TIMESTAMP_NTZ))",
        "copies": "explode(sequence(1, CASE WHEN {twice} THEN 2 ELSE 1 END))",
    },
    "duckdb": {
        "sec": "CAST(epoch_us(ts) // 1000000 AS BIGINT)",
        "copies": "unnest(generate_series(1, CASE WHEN {twice} THEN 2 ELSE 1 END))",
    },
}

_SITE_LAT = "(30 + user_id % 40)"
_SITE_LON = "(20 + CAST((user_id - user_id % 40) / 40 AS BIGINT) % 40)"


def _fixed_point(site: str, per_degree: int, offset: str) -> str:
    return f"({site} * {per_degree} + {offset})"


_FINE_LAT = _fixed_point(_SITE_LAT, 50000, "(event_id * 7919) % 1001 - 500")
_FINE_LON = _fixed_point(_SITE_LON, 50000, "(event_id * 10473) % 1009 - 504")
_COARSE_LAT = _fixed_point(_SITE_LAT, 50, "(event_id * 31) % 11 - 5")
_COARSE_LON = _fixed_point(_SITE_LON, 50, "(event_id * 17) % 13 - 6")


def _as_text(fixed: str, per_degree: int, digits: int) -> str:
    """Decimal text of a fixed-point coordinate (value / per_degree, ``digits`` decimals)."""
    scale = 10 ** digits
    scaled = f"({fixed} * {scale // per_degree})"
    return (f"concat(CAST(CAST(({scaled} - {scaled} % {scale}) / {scale} AS BIGINT) AS VARCHAR(9)),"
            f" '.', lpad(CAST({scaled} % {scale} AS VARCHAR(9)), {digits}, '0'))")


_COUNTRY = "CASE user_id % 18 " + " ".join(
    f"WHEN {i} THEN '{name}'" for i, name in enumerate(REPORT_COUNTRIES)) + " ELSE 'Greece' END"

_TABLES = {
    "detections": f"""
SELECT event_id AS id, user_id AS site, <SEC> AS sec,
 CAST({_FINE_LAT} AS DOUBLE) / 50000 AS latitude,
 CAST({_FINE_LON} AS DOUBLE) / 50000 AS longitude,
 CAST(value AS FLOAT) AS frp,
 CASE event_id % 10 WHEN 0 THEN 'l' WHEN 1 THEN 'LOW' WHEN 2 THEN NULL WHEN 3 THEN 'h'
  WHEN 4 THEN 'h' WHEN 5 THEN 'high' ELSE 'n' END AS confidence
FROM events WHERE event_type <> 'signup'""",
    "reports": f"""
SELECT event_id AS id, user_id AS site, <SEC> - <SEC> % 86400 AS sec,
 CAST({_COARSE_LAT} AS DOUBLE) / 50 AS latitude,
 CAST({_COARSE_LON} AS DOUBLE) / 50 AS longitude,
 CAST(CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 5 END AS INT) AS num_sources,
 CASE WHEN event_id % 2 = 0 THEN 'Air/drone strike'
  ELSE 'Shelling/artillery/missile attack' END AS sub_event_type,
 concat('Report ', CAST(event_id AS VARCHAR(12)), ' of user ', CAST(user_id AS VARCHAR(12)))
  AS description,
 concat('Site ', CAST(user_id AS VARCHAR(12))) AS place,
 CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'A; B ;;C' WHEN 2 THEN ' ; ' ELSE 'A' END AS source
FROM events WHERE event_type = 'signup'""",
    # all reports of a site at one coordinate
    "dense_reports": f"""
SELECT event_id AS id, user_id AS site, <SEC> - <SEC> % 86400 AS sec,
 CAST({_SITE_LAT} AS DOUBLE) AS latitude, CAST({_SITE_LON} AS DOUBLE) AS longitude,
 CAST(CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 5 END AS INT) AS num_sources,
 CASE WHEN event_id % 2 = 0 THEN 'Air/drone strike'
  ELSE 'Shelling/artillery/missile attack' END AS sub_event_type,
 CAST(NULL AS VARCHAR(9)) AS description,
 concat('Site ', CAST(user_id AS VARCHAR(12))) AS place,
 CAST(NULL AS VARCHAR(9)) AS source
FROM events WHERE event_type = 'signup'""",
    # all text: blanks, unreadable numbers, hour 24, long names, exact copies
    "raw_a": f"""
SELECT {_as_text(_FINE_LAT, 50000, 5)} AS latitude,
 CASE WHEN event_id % 60 = 11 THEN 'bad' ELSE {_as_text(_FINE_LON, 50000, 5)} END AS longitude,
 CAST(CAST(ts AS DATE) AS VARCHAR(10)) AS acq_date,
 CASE WHEN event_id % 50 = 7 THEN '2460' WHEN event_id % 50 = 8 THEN ''
  ELSE CAST(hour(ts) * 100 + minute(ts) AS VARCHAR(4)) END AS acq_time,
 CASE WHEN event_id % 70 = 5 THEN '12,5' ELSE CAST(event_id % 400 AS VARCHAR(9)) END AS bright_ti4,
 CASE WHEN event_id % 20 = 3 THEN '' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR(9)) END
  AS frp,
 CASE event_id % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'N20' ELSE 'NOAA-20-VIIRS' END AS satellite,
 CASE event_id % 10 WHEN 0 THEN 'l' WHEN 1 THEN 'LOW' WHEN 2 THEN '' WHEN 3 THEN 'h' ELSE 'n' END
  AS confidence,
 CASE event_id % 2 WHEN 0 THEN 'Day' ELSE 'N' END AS daynight,
 CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '2.0' ELSE ' 2 ' END AS type,
 '2.0NRT' AS version,
 <COPIES event_id % 25 = 3> AS copy
FROM events WHERE event_type <> 'signup'""",
    # bad dates, missing precision, padded sub-types, messy source lists, exact copies
    "raw_b": f"""
SELECT concat('EV', CAST(event_id AS VARCHAR(12))) AS event_id_cnty,
 CASE WHEN event_id % 40 = 13 THEN '2024-13-01' ELSE CAST(CAST(ts AS DATE) AS VARCHAR(10)) END
  AS event_date,
 CASE WHEN event_id % 16 = 5 THEN 'Battles' ELSE 'Explosions/Remote violence' END AS event_type,
 CASE event_id % 3 WHEN 0 THEN ' Air/drone strike ' WHEN 1 THEN 'Shelling/artillery/missile attack'
  ELSE 'Grenade' END AS sub_event_type,
 concat(' Note on ', props, ' ') AS notes,
 concat('Group ', CAST(user_id % 7 AS VARCHAR(2))) AS actor1,
 CASE WHEN event_id % 2 = 0 THEN ' ' ELSE 'Civilians' END AS actor2,
 concat('Site ', CAST(user_id AS VARCHAR(12))) AS location,
 {_COUNTRY} AS country,
 CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 6 = 1 THEN 'many'
  ELSE CAST(event_id % 6 AS VARCHAR(2)) END AS fatalities,
 {_as_text(_COARSE_LAT, 50, 2)} AS latitude, {_as_text(_COARSE_LON, 50, 2)} AS longitude,
 CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 4 AS VARCHAR(2)) END AS geo_precision,
 CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'A; B ;;C' WHEN 2 THEN ' ; ' ELSE 'A' END AS source,
 <COPIES event_id % 10 = 4> AS copy
FROM events WHERE event_type = 'signup'""",
}


def sql(table: str, engine: str) -> str:
    """The SQL text of a derived table for 'spark' or 'duckdb'."""
    import re

    parts = _ENGINE[engine]
    text = _TABLES[table].replace("<SEC>", parts["sec"])
    return re.sub(r"<COPIES ([^>]*)>", lambda m: parts["copies"].format(twice=m[1]), text).strip()


def derived(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(sql(table, "spark").replace("FROM events", "FROM {events}"), events=events)


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived(spark, sf_dir, "detections")
    return conform(rows.withColumn("acq_datetime", F.timestamp_seconds("sec")), DETECTIONS)


def reports(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    rows = derived(spark, sf_dir, "dense_reports" if dense else "reports")
    return conform(
        rows.withColumn("event_datetime", F.timestamp_seconds("sec"))
        .withColumn("global_event_id", F.concat(F.lit("EV"), F.col("id").cast("string")))
        .withColumn("event_date", F.col("event_datetime").cast("date"))
        .withColumnRenamed("place", "action_geo_fullname"), REPORTS)


def raw_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(derived(spark, sf_dir, "raw_a"), RAW_DETECTIONS)


def raw_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(derived(spark, sf_dir, "raw_b"), RAW_REPORTS)
