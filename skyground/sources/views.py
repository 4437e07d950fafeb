"""The serving view as SQL text in the catalog: planned anew at every read, so it follows gold.

Nothing is stored inside. Reports at one coordinate are numbered within ranges of their ids, the ranges
being the leading bits; every range is then shifted by the size of those before it. Ids are hashes,
so a coordinate with very many reports is spread evenly over as many tasks as there are ranges, and
what meets per coordinate is one row a range. Ids that fill one range only give the same numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import fixed_values as V
from ..schemas import MAP_COLUMNS
from . import tables as T

#: Leading bits of an id that name its range: 256 ranges.
RANGE_BITS = 8


def map_sql(gold: str, min_score: float = V.SERVING_MIN_SCORE, grid: bool = False) -> str:
    """The map over the table ``gold`` as one SELECT: best detection of each report, spread around its
    coordinate. The same rows as :func:`~skyground.operators.ranking.map_view`."""
    column = "floor(_ordinal / 10)" if grid else "CAST(_ordinal AS DOUBLE) / 10"
    half = f"CAST({V.JITTER_CENTRE_DEG!r} AS DOUBLE)"
    step = f"CAST({V.JITTER_STEP_DEG!r} AS DOUBLE)"
    derived = {
        "score_display": f"CAST(score AS DOUBLE) * {V.DISPLAY_SCALE}",
        "map_lat": f"event_lat + CAST(_ordinal % 10 AS DOUBLE) * {step} - {half}",
        "map_lon": f"event_lon + CAST({column} AS DOUBLE) * {step} - {half}",
    }
    selected = ", ".join(f"{derived[c]} AS {c}" if c in derived else c for c in MAP_COLUMNS)
    return f"""
WITH ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY acled_event_id ORDER BY score DESC, firms_detection_id) AS _rank
  FROM {gold} WHERE CAST(score AS DOUBLE) >= CAST({min_score!r} AS DOUBLE)),
best AS (
  SELECT * EXCEPT (_rank), shiftright(acled_event_id, {64 - RANGE_BITS}) AS _range
  FROM ranked WHERE _rank = 1),
numbered AS (
  SELECT *, row_number() OVER (
    PARTITION BY event_lat, event_lon, _range ORDER BY acled_event_id) AS _number FROM best),
sizes AS (
  SELECT event_lat, event_lon, _range, count(*) AS _size FROM best
  GROUP BY event_lat, event_lon, _range),
shifts AS (
  SELECT event_lat AS _lat, event_lon AS _lon, _range AS _of, sum(_size) OVER (
    PARTITION BY event_lat, event_lon ORDER BY _range
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _before FROM sizes),
placed AS (
  SELECT numbered.*, _number - 1 + coalesce(_before, 0) AS _ordinal
  FROM numbered LEFT JOIN shifts
    ON event_lat <=> _lat AND event_lon <=> _lon AND _range <=> _of)
SELECT {selected} FROM placed"""


def serving_view(spark: SparkSession, schema: str, **options) -> DataFrame:
    """Creates or replaces the map view of a schema, and the session's own view of the same name.

    Both are kept as text: every SELECT plans them over what gold holds by then, in any session
    that shares the catalog. Sessions keep lists of a table's files; one that did not write gold itself reads
    through :func:`read_map`, which looks at the table anew."""
    name = T.qualified(schema, T.MAP_VIEW)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS "
              f"{map_sql(T.qualified(schema, T.CORRELATIONS_GOLD), **options)}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{T.MAP_VIEW}` AS SELECT * FROM {name}")
    return read_map(spark, schema)


def read_map(spark: SparkSession, schema: str) -> DataFrame:
    """The map view as it is now."""
    spark.catalog.refreshTable(T.qualified(schema, T.CORRELATIONS_GOLD))
    return spark.table(T.qualified(schema, T.MAP_VIEW))
