"""The registered queries as DuckDB SQL over the raw tables: brute force, no grid, no salting."""

from __future__ import annotations

from skyground.fixed_values import (
    COUNTRY_BOXES, RECENT_PRODUCTS, REGION_BOXES, REPORT_COUNTRIES,
)

from . import fixtures as X


def _metres(p: str, q: str, lat: str = "latitude", lon: str = "longitude") -> str:
    return (
        f"12742000.0 * asin(sqrt(least(1.0, pow(sin(radians({q}.{lat} - {p}.{lat}) / 2), 2)"
        f" + cos(radians({p}.{lat})) * cos(radians({q}.{lat}))"
        f" * pow(sin(radians({q}.{lon} - {p}.{lon}) / 2), 2))))")


def _silver(source: str, name: str) -> dict[str, str]:
    """The parts ``<name>_dominated`` and ``<name>`` over a detections part."""
    return {
        f"{name}_confident":
            f"SELECT * FROM {source} WHERE lower(confidence) NOT IN ('l', 'low')",
        f"{name}_dominated":
            f"SELECT DISTINCT p.id FROM {name}_confident p JOIN {name}_confident q"
            f" ON p.id < q.id AND abs(p.sec - q.sec) <= 21600 AND {_metres('p', 'q')} <= 1006.0",
        name:
            f"SELECT * FROM {name}_confident c"
            f" WHERE NOT EXISTS (SELECT 1 FROM {name}_dominated d WHERE d.id = c.id)",
    }


def _pairs(silver: str, reports: str, name: str) -> dict[str, str]:
    return {
        f"{name}_near": f"""
SELECT f.id AS firms_detection_id, g.id AS acled_event_id, f.latitude AS fire_lat,
 f.longitude AS fire_lon, f.sec AS fire_s, f.frp AS fire_frp, f.confidence AS fire_confidence,
 g.latitude AS event_lat, g.longitude AS event_lon, g.sec AS event_s,
 g.sub_event_type AS event_sub_event_type, g.description AS event_description,
 g.place AS event_location_full_name, g.source AS event_source,
 g.num_sources AS event_num_sources, CAST({_metres('f', 'g')} AS FLOAT) AS distance_m,
 CAST((g.sec - f.sec) / CAST(3600 AS DOUBLE) AS FLOAT) AS time_delta_h
FROM {silver} f JOIN {reports} g
 ON g.sec >= f.sec - 172800 AND g.sec <= f.sec + 21600 AND f.frp >= 1
WHERE CAST({_metres('f', 'g')} AS FLOAT) <= 10000""",
        name: f"""
SELECT *, CAST(least(coalesce(CAST(fire_frp AS DOUBLE), 0) / 300, 1)
  * CAST(CASE WHEN fire_confidence = 'h' THEN 1.0 ELSE 0.8 END AS DOUBLE)
  * least(CAST(coalesce(event_num_sources, 1) AS DOUBLE) / 3, 1)
  * sqrt(1 - CAST(distance_m AS DOUBLE) / 10000)
  * (1 - abs(CAST(time_delta_h AS DOUBLE)) / 54) AS FLOAT) AS score
FROM {name}_near""",
    }


def _map(pairs: str, name: str, column: str = "n / CAST(10 AS DOUBLE)") -> dict[str, str]:
    return {
        f"{name}_best": f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY acled_event_id
  ORDER BY score DESC, firms_detection_id) AS rn FROM {pairs})
WHERE rn = 1 AND CAST(score AS DOUBLE) >= 0.002""",
        f"{name}_placed": f"""
SELECT *, row_number() OVER (PARTITION BY event_lat, event_lon ORDER BY acled_event_id) - 1 AS n
FROM {name}_best""",
        name: f"""
SELECT *, CAST(score AS DOUBLE) * 1000 AS score_display,
 event_lat + CAST(n % 10 AS DOUBLE) * CAST(0.001 AS DOUBLE) - CAST(0.0045 AS DOUBLE) AS map_lat,
 event_lon + {column} * CAST(0.001 AS DOUBLE) - CAST(0.0045 AS DOUBLE) AS map_lon,
 strftime(make_timestamp(event_s * 1000000), '%Y-%m-%d %H:%M:%S') AS event_text,
 strftime(make_timestamp(fire_s * 1000000), '%Y-%m-%d %H:%M:%S') AS fire_text
FROM {name}_placed""",
    }


def _one_decimal(number: str) -> str:
    """printf rounds the exact binary value; only exact ties (odd quarters) it sends to even, where
    the page goes up."""
    tie = f"{number} * 4 = floor({number} * 4) AND CAST(floor({number} * 4) AS BIGINT) % 2 = 1"
    up = f"printf('%.1f', floor({number} * 10 + CAST(0.5 AS DOUBLE)) / 10)"
    return f"CASE WHEN {tie} THEN {up} ELSE printf('%.1f', {number}) END"


def _in_boxes(lat: str, lon: str, codes: tuple[str, ...] | None = None) -> str:
    return "(" + " OR ".join(
        f"({lat} BETWEEN {s} AND {n} AND {lon} BETWEEN {w} AND {e})"
        for code, s, n, w, e in COUNTRY_BOXES if codes is None or code in codes) + ")"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_REGIONS = ", ".join(
    f"({_quoted(label)}, {w}, {s}, {e}, {n})" for label, w, s, e, n in REGION_BOXES)
_PRODUCTS = ", ".join(f"({_quoted(p)})" for p in RECENT_PRODUCTS)
_COUNTRIES = ", ".join(f"({i}, {_quoted(c)})" for i, c in enumerate(REPORT_COUNTRIES))
_DAY_16 = 1705363200  # 2024-01-16
_DAY_10 = 1704844800  # 2024-01-10

_PARTS: dict[str, str] = {
    **{name: X.sql(name, "duckdb")
       for name in ("detections", "reports", "dense_reports", "raw_a", "raw_b")},
    **_silver("detections", "silver"),
    **_pairs("silver", "reports", "pairs"),
    **_map("pairs", "map"),
    **_pairs("silver", "dense_reports", "dense_pairs"),
    **_map("dense_pairs", "dense_map"),
    **_map("dense_pairs", "grid_map", "CAST(n // 10 AS DOUBLE)"),
    "batch_1": f"SELECT * FROM detections WHERE sec < {_DAY_16}",
    "batch_2": f"SELECT * REPLACE (CAST(frp * 2 AS FLOAT) AS frp) FROM detections"
               f" WHERE sec >= {_DAY_10}",
    **_silver("batch_1", "silver_1"),
    **_pairs("silver_1", "reports", "pairs_1"),
    **_silver("batch_2", "silver_2"),
    **_pairs("silver_2", "reports", "pairs_2"),
    "clock_a": """
SELECT *, CASE WHEN length(acq_time) < 4 THEN lpad(acq_time, 4, '0') ELSE acq_time END AS hhmm
FROM raw_a""",
    "read_a": """
SELECT *, TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon,
 CASE WHEN regexp_full_match(hhmm, '([01][0-9]|2[0-3])[0-5][0-9]')
  THEN CAST(epoch(CAST(acq_date AS DATE)) AS BIGINT)
   + CAST(substr(hhmm, 1, 2) AS BIGINT) * 3600 + CAST(substr(hhmm, 3, 2) AS BIGINT) * 60 END
  AS acq_s,
 CASE WHEN trim(type) IN ('0', '2') THEN CAST(trim(type) AS BIGINT) ELSE -1 END AS kind,
 CAST(bright_ti4 = '12,5' AS BIGINT) + CAST(trim(type) = '2.0' AS BIGINT) AS warnings
FROM clock_a""",
    "routed_a": f"""
SELECT *, left(satellite, 10) AS sat, CASE WHEN lower(confidence) IN ('l', 'low') THEN 'low_conf'
 WHEN acq_s IS NULL OR lat IS NULL OR lon IS NULL THEN 'parse_err'
 WHEN NOT {_in_boxes('lat', 'lon')} THEN 'outside_zone' ELSE 'ok' END AS reason
FROM read_a""",
    "read_b": """
SELECT *, TRY_CAST(event_date AS DATE) AS d, trim(sub_event_type) AS kind,
 coalesce(TRY_CAST(geo_precision AS INT), 0) AS prec,
 CAST(coalesce(fatalities = 'many', FALSE) AS BIGINT) AS warnings
FROM raw_b""",
    "routed_b": """
SELECT *, CASE WHEN d IS NOT NULL AND prec IN (1, 2)
 AND kind IN ('Air/drone strike', 'Shelling/artillery/missile attack')
 THEN 'ok' ELSE 'skipped' END AS reason
FROM read_b""",
    "countries": f"SELECT * FROM (VALUES {_COUNTRIES}) AS t(position, country)",
    "regions": f"SELECT * FROM (VALUES {_REGIONS}) AS t(region, w, s, e, n)",
    "products": f"SELECT * FROM (VALUES {_PRODUCTS}) AS t(product)",
    "landed_a": """
SELECT lat, lon, CAST(make_timestamp(acq_s * 1000000) AS DATE) AS d,
 CASE WHEN left(satellite, 10) = 'N' THEN 'VIIRS_SNPP_NRT' ELSE 'VIIRS_NOAA20_NRT' END AS product
FROM read_a WHERE acq_s IS NOT NULL""",
    "landed_days": "SELECT min(d) AS first_day, max(d) AS last_day FROM landed_a",
    "landed_chunks": """
SELECT first_day + CAST(k * 5 AS INT) AS chunk_start,
 least(date_diff('day', first_day, last_day) - k * 5 + 1, 5) AS chunk_days
FROM (SELECT *, unnest(generate_series(0, date_diff('day', first_day, last_day) // 5)) AS k
 FROM landed_days)""",
    "landed_counts": """
SELECT r.region, a.product,
 first_day + CAST((date_diff('day', first_day, a.d) // 5) * 5 AS INT) AS chunk_start,
 count(*) AS landed
FROM landed_a a JOIN landed_days ON TRUE
 JOIN regions r ON a.lat BETWEEN r.s AND r.n AND a.lon BETWEEN r.w AND r.e
GROUP BY ALL""",
    # days of planned chunks without a file: it failed, or it has no row
    "missing_a": """
SELECT r.region, p.product, c.chunk_start + CAST(k AS INT) AS day
FROM regions r JOIN products p ON TRUE
 JOIN (SELECT *, unnest(generate_series(0, chunk_days - 1)) AS k FROM landed_chunks) c ON TRUE
 CROSS JOIN landed_days
WHERE NOT EXISTS (SELECT 1 FROM landed_counts l WHERE l.region = r.region
  AND l.product = p.product AND l.chunk_start = c.chunk_start
  AND NOT ((date_diff('day', first_day, c.chunk_start) // 5) % 3 = 1
   AND p.product = 'VIIRS_SNPP_NRT'))
 AND NOT EXISTS (SELECT 1 FROM landed_a a WHERE a.d = c.chunk_start + CAST(k AS INT)
  AND day(a.d) = 8 AND a.product = p.product AND p.product = 'VIIRS_SNPP_NRT'
  AND a.lat BETWEEN r.s AND r.n AND a.lon BETWEEN r.w AND r.e)""",
    "site_days": """
SELECT CAST(round(latitude) AS BIGINT) AS lat_deg, CAST(round(longitude) AS BIGINT) AS lon_deg,
 min(CAST(make_timestamp(sec * 1000000) AS DATE)) AS first_day,
 max(CAST(make_timestamp(sec * 1000000) AS DATE)) AS last_day
FROM detections GROUP BY ALL""",
}

# Each text may use any of the parts above by name.
_MAP_SELECT = """
SELECT firms_detection_id, acled_event_id, event_sub_event_type, event_location_full_name,
 round(CAST(distance_m AS DOUBLE), 3) AS distance_m,
 round(CAST(time_delta_h AS DOUBLE), 5) AS time_delta_h,
 round(score_display, 3) AS score_display, round(map_lat, 6) AS map_lat,
 round(map_lon, 6) AS map_lon FROM {}"""

_QUALITY = """
SELECT CAST(sum(n) AS BIGINT) AS raw_rows,
 CAST(coalesce(sum(n) FILTER (reason = 'low_conf'), 0) AS BIGINT) AS low_conf,
 CAST(coalesce(sum(n) FILTER (reason = 'parse_err'), 0) AS BIGINT) AS parse_err,
 CAST(coalesce(sum(n) FILTER (reason = 'outside_zone'), 0) AS BIGINT) AS outside_zone,
 CAST(coalesce(sum(n) FILTER (reason = 'skipped'), 0) AS BIGINT) AS skipped,
 CAST(coalesce(sum(n) FILTER (reason = 'ok'), 0) AS BIGINT) AS kept,
 count(*) FILTER (reason = 'ok') AS unique_rows,
 CAST(coalesce(sum(n - 1) FILTER (reason = 'ok'), 0) AS BIGINT) AS exact_duplicates,
 CAST(coalesce(sum(warnings), 0) AS BIGINT) AS warnings
FROM (SELECT reason, {key}, count(*) AS n, sum(warnings) AS warnings FROM {routed} GROUP BY ALL)"""

_QUERIES: dict[str, str] = {
    "silver_dedup": "SELECT id, sec AS acq_s, latitude, longitude,"
                    " round(CAST(frp AS DOUBLE), 4) AS frp, confidence FROM silver",
    "dominated": "SELECT id FROM silver_dominated",
    "residual_after_dedup":
        "SELECT count(DISTINCT p.id) AS residual FROM silver p JOIN silver q ON p.id < q.id"
        f" AND abs(p.sec - q.sec) <= 21600 AND {_metres('p', 'q')} <= 1006.0",
    "residual_before_dedup": "SELECT count(*) AS residual FROM silver_dominated",
    "candidates_scored": """
SELECT firms_detection_id, acled_event_id, fire_lat, fire_lon, fire_s,
 round(CAST(fire_frp AS DOUBLE), 4) AS fire_frp, fire_confidence, event_lat, event_lon, event_s,
 event_sub_event_type, event_description, event_location_full_name, event_source,
 CAST(coalesce(event_num_sources, -1) AS BIGINT) AS event_num_sources,
 round(CAST(distance_m AS DOUBLE), 3) AS distance_m,
 round(CAST(time_delta_h AS DOUBLE), 5) AS time_delta_h, round(CAST(score AS DOUBLE), 6) AS score
FROM pairs""",
    "best_match": "SELECT acled_event_id, firms_detection_id,"
                  " round(CAST(score AS DOUBLE), 6) AS score FROM map_best",
    "map_view": _MAP_SELECT.format("map"),
    "map_view_dense": _MAP_SELECT.format("dense_map"),
    "map_view_straight_grid": _MAP_SELECT.format("grid_map"),
    "top_pairs": """
SELECT round(CAST(score AS DOUBLE), 6) AS score, round(CAST(distance_m AS DOUBLE), 3) AS distance_m,
 round(CAST(time_delta_h AS DOUBLE), 5) AS time_delta_h, fire_lat, fire_lon,
 round(CAST(fire_frp AS DOUBLE), 4) AS fire_frp, fire_confidence, event_location_full_name,
 event_sub_event_type
FROM (SELECT * FROM pairs ORDER BY pairs.score DESC, firms_detection_id, acled_event_id LIMIT 3)""",
    "leaderboard": f"""
SELECT CAST(row_number() OVER (ORDER BY round(score_display, 5) DESC, acled_event_id) AS INT) AS rank,
 {_one_decimal('round(score_display, 5)')} AS score_text, event_location_full_name AS place,
 left(event_text, 7) AS month
FROM (SELECT * FROM map ORDER BY round(score_display, 5) DESC, acled_event_id LIMIT 10)""",
    "export_rows": """
SELECT round(map_lat, 5) AS map_lat, round(map_lon, 5) AS map_lon,
 round(event_lat, 5) AS event_lat, round(event_lon, 5) AS event_lon,
 round(round(score_display, 5), 3) AS score_display,
 round(CAST(fire_frp AS DOUBLE), 5) AS fire_frp,
 fire_confidence, event_sub_event_type, event_description, event_location_full_name, event_source,
 CAST(coalesce(event_num_sources, -1) AS BIGINT) AS event_num_sources,
 event_text AS event_datetime, fire_text AS fire_acq_datetime,
 round(round(CAST(distance_m AS DOUBLE), 5), 3) AS distance_m,
 round(CAST(time_delta_h AS DOUBLE), 5) AS time_delta_h FROM map""",
    "run_metadata": f"SELECT true AS is_iso, count(*) AS total_events,"
                    f" count(*) FILTER (event_s >= {_DAY_16}) AS events_added_last_run FROM map",
    "visible_events": """
SELECT round(map_lat, 5) AS map_lat, round(map_lon, 5) AS map_lon, event_location_full_name,
 event_sub_event_type, event_text AS event_datetime,
 round(round(score_display, 5), 3) AS score_display
FROM map WHERE round(score_display, 5) >= 5 AND NOT contains(lower(event_sub_event_type), 'air')
 AND left(event_text, 10) BETWEEN '2024-01-05' AND '2024-01-25'""",
    "date_range": """
SELECT first_date, last_date, left(first_date, 7) AS first_month, left(last_date, 7) AS last_month,
 CASE WHEN left(first_date, 7) = left(last_date, 7) THEN left(first_date, 7)
  ELSE concat(left(first_date, 7), ' – ', left(last_date, 7)) END AS header_range
FROM (SELECT min(left(event_text, 10)) AS first_date, max(left(event_text, 10)) AS last_date
 FROM map)""",
    "marker_style": """
SELECT acled_event_id, CASE WHEN fire_confidence = 'h' THEN '#c0392b' ELSE '#d68910' END AS colour,
 round(greatest(6, least(6 + sqrt(coalesce(nullif(round(score_display, 5), 0), 2)) * CAST(1.8 AS DOUBLE),
  22)), 4) AS radius FROM map""",
    "popup_text": f"""
SELECT acled_event_id, {_one_decimal('round(score_display, 5)')} AS score_text,
 CASE WHEN fire_confidence = 'h' THEN 'High confidence' ELSE 'Nominal' END AS confidence_text,
 concat('FRP ', {_one_decimal('round(CAST(fire_frp AS DOUBLE), 5)')}, ' MW') AS frp_text,
 concat(coalesce(CAST(event_num_sources AS VARCHAR), 'null'), ' source',
  CASE WHEN event_num_sources > 1 THEN 's' ELSE '' END) AS sources_text,
 concat({_one_decimal('(round(CAST(distance_m AS DOUBLE), 5) / 1000)')}, ' km apart') AS distance_text,
 array_to_string(list_filter(list_transform(string_split(coalesce(event_source, ''), ';'),
  lambda x: trim(x)), lambda x: x <> ''), ' · ') AS source_list,
 left(event_text, 10) AS date_text FROM map""",
    "feed_a_normalised": """
SELECT DISTINCT acq_s, lat AS latitude, lon AS longitude,
 CAST(TRY_CAST(bright_ti4 AS DOUBLE) AS DOUBLE) AS bright_ti4,
 TRY_CAST(nullif(frp, '') AS DOUBLE) AS frp, sat AS satellite,
 nullif(confidence, '') AS confidence, left(daynight, 1) AS daynight, kind AS type, version
FROM routed_a WHERE reason = 'ok'""",
    "feed_a_rejects": "SELECT reason, count(*) AS n FROM routed_a GROUP BY reason",
    "feed_a_quality": _QUALITY.format(key="acq_s, lat, lon, sat", routed="routed_a"),
    "feed_b_normalised": """
SELECT DISTINCT event_id_cnty AS global_event_id, CAST(d AS VARCHAR) AS event_date,
 CAST(epoch(d) AS BIGINT) AS event_s, event_type, kind AS sub_event_type,
 trim(notes) AS description,
 CAST(greatest(len(list_filter(string_split(coalesce(source, ''), ';'),
  lambda x: trim(x) <> '')), 1) AS BIGINT) AS num_sources,
 actor1 AS actor1_name, nullif(trim(actor2), '') AS actor2_name,
 location AS action_geo_fullname, country AS action_geo_country,
 coalesce(TRY_CAST(fatalities AS BIGINT), -1) AS fatalities,
 CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
 nullif(trim(source), '') AS source
FROM routed_b WHERE reason = 'ok'""",
    "feed_b_rejects": "SELECT reason, count(*) AS n FROM routed_b GROUP BY reason",
    "feed_b_quality": _QUALITY.format(key="event_id_cnty", routed="routed_b"),
    "feed_b_requested": """
SELECT event_id_cnty, country, event_date, notes FROM raw_b
WHERE country IN (SELECT country FROM countries) AND event_type = 'Explosions/Remote violence'
 AND event_date BETWEEN '2024-01-05' AND '2024-01-25'""",
    "feed_b_country_counts": """
SELECT CAST(position AS INT) AS position, country, n,
 CAST(sum(n) OVER (ORDER BY position ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
FROM (SELECT c.position, c.country, count(b.country) AS n
 FROM countries c LEFT JOIN raw_b b ON b.country = c.country GROUP BY ALL)""",
    "feed_key_stability": """
SELECT count(*) AS keys, count(*) AS ids, CAST(0 AS BIGINT) AS unstable
FROM (SELECT DISTINCT acq_s, lat, lon, sat FROM routed_a WHERE reason = 'ok')""",
    "feed_a_from_files": """
SELECT DISTINCT acq_s, lat AS latitude, lon AS longitude,
 CAST(CAST(TRY_CAST(bright_ti4 AS DOUBLE) AS FLOAT) AS DOUBLE) AS bright_ti4,
 round(CAST(CAST(TRY_CAST(nullif(frp, '') AS DOUBLE) AS FLOAT) AS DOUBLE), 4) AS frp, sat AS satellite,
 nullif(confidence, '') AS confidence, left(daynight, 1) AS daynight, kind AS type, version
FROM routed_a WHERE reason = 'ok'""",
    "feed_a_malformed": """
SELECT CASE WHEN daynight = 'N' AND (bright_ti4 LIKE '%5' OR bright_ti4 LIKE '%7') THEN 'malformed'
 ELSE reason END AS reason, count(*) AS n FROM routed_a GROUP BY ALL""",
    "export_order": """
SELECT row_number() OVER (ORDER BY score_display DESC, acled_event_id) AS place,
 round(map_lat, 5) AS map_lat, round(map_lon, 5) AS map_lon,
 round(round(score_display, 5), 3) AS score_display FROM map""",
    "missing_ranges": """
SELECT region, product, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day,
 count(*) AS days
FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY region, product ORDER BY day) AS INT) AS island
 FROM missing_a)
GROUP BY region, product, island""",
    "in_any_box": "SELECT id, latitude, longitude FROM detections"
                  f" WHERE {_in_boxes('latitude', 'longitude')}",
    "in_tiled_boxes": f"""
SELECT id FROM detections d WHERE {_in_boxes('latitude', 'longitude', ('UP', 'SY', 'KU'))}
 OR EXISTS (SELECT 1 FROM reports r WHERE r.id % 3 = 0
 AND d.latitude BETWEEN r.latitude - CAST(0.05 AS DOUBLE) AND r.latitude + CAST(0.05 AS DOUBLE)
 AND d.longitude BETWEEN r.longitude - CAST(0.05 AS DOUBLE)
  AND r.longitude + CAST(0.05 AS DOUBLE))""",
    "boxes_from_clustered": "SELECT id, latitude, longitude FROM detections"
                            f" WHERE {_in_boxes('latitude', 'longitude', ('UP', 'RS', 'KU'))}",
    "in_box_table": """
SELECT id FROM detections d WHERE EXISTS (SELECT 1 FROM reports r
 WHERE d.latitude BETWEEN r.latitude - CAST(0.05 AS DOUBLE) AND r.latitude + CAST(0.05 AS DOUBLE)
 AND d.longitude BETWEEN r.longitude - CAST(0.05 AS DOUBLE)
  AND r.longitude + CAST(0.05 AS DOUBLE))""",
    "region_pulls": "SELECT r.region, d.id FROM detections d JOIN regions r"
                    " ON d.latitude BETWEEN r.s AND r.n AND d.longitude BETWEEN r.w AND r.e",
    "date_chunks": """
SELECT lat_deg, lon_deg, CAST(first_day + CAST(k * 5 AS INT) AS VARCHAR) AS chunk_start,
 least(date_diff('day', first_day, last_day) - k * 5 + 1, 5) AS chunk_days
FROM (SELECT *, unnest(generate_series(0, date_diff('day', first_day, last_day) // 5)) AS k
 FROM site_days)""",
    "request_list": """
SELECT region, product, CAST(chunk_start AS VARCHAR) AS chunk_start, chunk_days, landed,
 CAST(sum(landed) OVER (PARTITION BY region, product ORDER BY chunk_start
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
FROM (SELECT r.region, p.product, c.chunk_start, c.chunk_days, coalesce(l.landed, 0) AS landed
 FROM regions r JOIN products p ON TRUE JOIN landed_chunks c ON TRUE
 LEFT JOIN landed_counts l ON l.region = r.region AND l.product = p.product
  AND l.chunk_start = c.chunk_start)""",
    "batch_window": """
SELECT 'detections' AS feed, id, CAST(CAST(make_timestamp(sec * 1000000) AS DATE) AS VARCHAR) AS day
FROM detections WHERE CAST(make_timestamp(sec * 1000000) AS DATE) = DATE '2024-01-17'
UNION ALL
SELECT 'reports', id, CAST(CAST(make_timestamp(sec * 1000000) AS DATE) AS VARCHAR)
FROM reports WHERE CAST(make_timestamp(sec * 1000000) AS DATE)
 BETWEEN DATE '2024-01-16' AND DATE '2024-01-17'""",
    "merge_detections": """
SELECT id, round(CAST(frp AS DOUBLE), 4) AS frp FROM batch_1
UNION ALL
SELECT id, round(CAST(frp AS DOUBLE), 4) FROM batch_2 b
WHERE NOT EXISTS (SELECT 1 FROM batch_1 a WHERE a.id = b.id)""",
    "merge_pairs_first_wins": """
SELECT firms_detection_id, acled_event_id, round(CAST(score AS DOUBLE), 6) AS score FROM pairs_1
UNION ALL
SELECT firms_detection_id, acled_event_id, round(CAST(score AS DOUBLE), 6) FROM pairs_2 b
WHERE NOT EXISTS (SELECT 1 FROM pairs_1 a WHERE a.firms_detection_id = b.firms_detection_id
 AND a.acled_event_id = b.acled_event_id)""",
    "merge_partitioned": """
SELECT id, round(CAST(frp AS DOUBLE), 4) AS frp,
 CAST(CAST(make_timestamp(sec * 1000000) AS DATE) AS VARCHAR) AS day, 'one' AS batch FROM batch_1
UNION ALL
SELECT id, round(CAST(frp AS DOUBLE), 4),
 CAST(CAST(make_timestamp(sec * 1000000) AS DATE) AS VARCHAR), 'two' FROM batch_2 b
WHERE NOT EXISTS (SELECT 1 FROM batch_1 a WHERE a.id = b.id)""",
    "serving_view_live": _MAP_SELECT.format("dense_map"),
    "map_incremental": _MAP_SELECT.format("dense_map"),
    "silver_schema_cast": """
SELECT id, CAST(frp AS DOUBLE) AS frp,
 CAST(CAST(id / CAST(3 AS DOUBLE) AS FLOAT) AS DOUBLE) AS bright_ti4, id % 4 AS type,
 'float' AS frp_type, 'smallint' AS type_type FROM detections""",
    "stage_counts": """
SELECT 'detections' AS stage, count(*) AS n FROM detections
UNION ALL SELECT 'reports', count(*) FROM reports
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'pairs', count(*) FROM pairs
UNION ALL SELECT 'map', count(*) FROM map""",
    "removed_by_dedup":
        "SELECT (SELECT count(*) FROM detections) - (SELECT count(*) FROM silver) AS removed",
    "score_stats": """
SELECT round(a, 4) AS score_min, round(b, 4) AS score_avg, round(c, 4) AS score_max,
 round(a * 1000, 2) AS display_min, round(b * 1000, 2) AS display_avg,
 round(c * 1000, 2) AS display_max
FROM (SELECT min(CAST(score AS DOUBLE)) AS a, avg(CAST(score AS DOUBLE)) AS b,
 max(CAST(score AS DOUBLE)) AS c FROM pairs)""",
    "contract_checks": f"""
SELECT 'silver_rows' AS check_name, CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS passed
FROM silver
UNION ALL SELECT 'residual_pairs', CAST(count(DISTINCT p.id) AS DOUBLE), count(*) = 0
FROM silver p JOIN silver q ON p.id < q.id AND abs(p.sec - q.sec) <= 21600
 AND {_metres('p', 'q')} <= 1006.0
UNION ALL SELECT 'score_min', round(CAST(min(score) AS DOUBLE), 5), min(score) >= 0 FROM pairs
UNION ALL SELECT 'score_max', round(CAST(max(score) AS DOUBLE), 5), max(score) <= 1 FROM pairs""",
    "verification_summary": f"""
SELECT 'silver_rows' AS item, CAST(count(*) AS DOUBLE) AS value FROM silver
UNION ALL SELECT 'pair_rows', CAST(count(*) AS DOUBLE) FROM pairs
UNION ALL SELECT 'residual_pairs', CAST(count(DISTINCT p.id) AS DOUBLE)
FROM silver p JOIN silver q ON p.id < q.id AND abs(p.sec - q.sec) <= 21600
 AND {_metres('p', 'q')} <= 1006.0
UNION ALL SELECT 'score_min', round(CAST(min(score) AS DOUBLE), 4) FROM pairs
UNION ALL SELECT 'score_avg', round(avg(CAST(score AS DOUBLE)), 4) FROM pairs
UNION ALL SELECT 'score_max', round(CAST(max(score) AS DOUBLE), 4) FROM pairs
UNION ALL SELECT 'display_min', round(CAST(min(score) AS DOUBLE) * 1000, 4) FROM pairs
UNION ALL SELECT 'display_avg', round(avg(CAST(score AS DOUBLE)) * 1000, 4) FROM pairs
UNION ALL SELECT 'display_max', round(CAST(max(score) AS DOUBLE) * 1000, 4) FROM pairs""",
    "table_health": """
SELECT 'detections_rows' AS check_name, count(*) AS value, count(*) > 0 AS passed FROM detections
UNION ALL SELECT 'reports_rows', count(*), count(*) > 0 FROM reports
UNION ALL SELECT 'silver_rows', count(*), count(*) > 0 FROM silver
UNION ALL SELECT 'pairs_rows', count(*), count(*) > 0 FROM pairs
UNION ALL SELECT 'bad_scores', count(*), count(*) = 0 FROM pairs WHERE score < 0 OR score > 1""",
}


def _needed(text: str) -> list[str]:
    """Names of the parts a text uses, directly or through other parts, in definition order."""
    import re

    wanted: set[str] = set()
    pending = [text]
    while pending:
        words = set(re.findall(r"\b[a-z_0-9]+\b", pending.pop()))
        for name in words & _PARTS.keys() - wanted:
            wanted.add(name)
            pending.append(_PARTS[name])
    return [name for name in _PARTS if name in wanted]


_QUERIES["silver_across_batches"] = _QUERIES["silver_table"] = _QUERIES["silver_dedup"]
_QUERIES["feed_b_from_pages"] = _QUERIES["feed_b_normalised"]


def oracle_sql() -> dict[str, str]:
    """Complete statements: each text with the parts it needs as a WITH list."""
    statements = {}
    for name, text in _QUERIES.items():
        parts = ",\n".join(
            f"{part} AS MATERIALIZED ({_PARTS[part].strip()})" for part in _needed(text))
        statements[name] = f"WITH {parts}\n{text.strip()}"
    return statements
