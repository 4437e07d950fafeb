"""The map as a table that a batch of new pairs brings up to date.

One row a report, the best pair it has had, in partitions by tiles of a few degrees. A batch can only
change reports it has new pairs for, and the numbering of the coordinates they are at. So the new
pairs are read, the published rows of the tiles they touch, and nothing of the history of pairs;
the touched tiles are written anew, each as a whole. The result is that of
:func:`~skyground.operators.ranking.map_view` over all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import fixed_values as V
from ..operators.ranking import best_per_report, ordinal_within, spread
from ..schemas import CORRELATIONS, MAP_COLUMNS
from ..sources import tables as T
from .stages import replace_partitions, setting, stored, stored_observed

#: Degrees of a tile: at most 72 x 36 of them, so a list of tiles may come to the driver.
TILE_DEG = 5
_PAIR = [f.name for f in CORRELATIONS.fields if f.name != "created_at"]
_PLACE = ["event_lat", "event_lon"]


def tile(lat: Column, lon: Column) -> Column:
    """The tile of a coordinate; coordinates off the globe share those at its edge."""
    row = F.floor(F.greatest(F.lit(-90.0), F.least(lat, F.lit(89.999))) / TILE_DEG)
    column = F.floor(F.greatest(F.lit(-180.0), F.least(lon, F.lit(179.999))) / TILE_DEG)
    return F.coalesce((row * (360 // TILE_DEG) + column).cast("int"), F.lit(-1_000_000))


def ensure_map(spark: SparkSession, schema: str) -> str:
    """Creates the table where it is missing; its name."""
    name = T.qualified(schema, T.MAP_TABLE)
    kinds = {f.name: f.dataType.simpleString() for f in CORRELATIONS.fields}
    ddl = ", ".join(f"`{c}` {kinds.get(c, 'double')}" for c in MAP_COLUMNS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}, tile INT) USING parquet"
              " PARTITIONED BY (tile)")
    return name


def _tiles(df: DataFrame) -> list[int]:
    """The different tiles of rows; there are 2,592 and one at most."""
    return sorted(r[0] for r in df.select("tile").distinct().collect())


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> list[Column]:
    return [a[c].eqNullSafe(b[c]) for c in columns]


def update_map(spark: SparkSession, schema: str, new_pairs: DataFrame, *,
               reports_may_move: bool = True, min_score: float = V.SERVING_MIN_SCORE,
               rows_per_task: int = 1_000_000) -> dict[str, int]:
    """Brings the map table up to date with pairs inserted into gold.

    Gives ``candidates`` (reports with a new pair that reaches the score), ``read`` (published rows
    read), ``changed`` (reports with another best pair), ``tiles`` and ``written`` (rows of the tiles
    replaced). The same pairs may come again, also after a run that ended half-way: every tile is
    replaced at once, and a report found in two tiles is put right.

    A report whose place was corrected between batches may be published in a tile that the new pairs do
    not touch. Its id is therefore looked for in the whole table, two columns of it; without
    ``reports_may_move`` only touched tiles are read.
    """
    name = ensure_map(spark, schema)
    none = {"candidates": 0, "read": 0, "changed": 0, "tiles": 0, "written": 0}
    candidates, facts = stored_observed(
        best_per_report(new_pairs.select(*_PAIR), min_score).withColumn(
            "tile", tile(F.col("event_lat"), F.col("event_lon"))),
        "map-candidates", rows=F.count(F.lit(1)))
    if not facts["rows"]:
        return none
    table = spark.table(name)
    ids = candidates.select("acled_event_id")
    touched = set(_tiles(candidates))
    if reports_may_move:
        known = table.select("acled_event_id", "tile")
        touched |= set(_tiles(known.join(ids, _same(known, ids, ["acled_event_id"]), "left_semi")))
    # the rows of the touched tiles, read once
    current, seen = stored_observed(
        table.filter(F.col("tile").isin(*touched)).select(*MAP_COLUMNS, "tile"), "map-current",
        rows=F.count(F.lit(1)))
    before = current.join(ids, _same(current, ids, ["acled_event_id"]), "left_semi")
    contest = candidates.select(*_PAIR, "tile", F.lit(0).alias("_old")).unionByName(
        before.select(*_PAIR, "tile", F.lit(1).alias("_old")))
    of_report = Window.partitionBy("acled_event_id")
    order = of_report.orderBy(F.col("score").desc(), F.col("firms_detection_id"), F.col("_old").desc())
    judged = contest.withColumns({
        "_rank": F.row_number().over(order), "_known": F.sum("_old").over(of_report)})
    # a report stays as it is if its one published row is still the best
    winners = judged.filter("_rank = 1 AND NOT (_old = 1 AND _known = 1)").select(*_PAIR, "tile")
    changed, count = stored_observed(winners, "map-changed", rows=F.count(F.lit(1)))
    if not count["rows"]:
        return none | {"candidates": facts["rows"], "read": seen["rows"]}

    gone = changed.select("acled_event_id")
    left = before.join(gone, _same(before, gone, ["acled_event_id"]), "left_semi")
    # coordinates that a report has left or come to are numbered anew
    places = stored(changed.select(*_PLACE, "tile").unionByName(
        left.select(*_PLACE, "tile")).distinct(), "map-places")
    replaced = _tiles(places)
    stay = current.filter(F.col("tile").isin(*replaced))
    stay = stay.join(gone, _same(stay, gone, ["acled_event_id"]), "left_anti")
    at = places.select(*_PLACE)
    moved = stay.join(at, _same(stay, at, _PLACE), "left_semi").select(*_PAIR)
    numbered = ordinal_within(
        stored(moved.unionByName(changed.select(*_PAIR)), "map-moved"),
        _PLACE, "acled_event_id", "_ordinal", rows_per_task)
    renewed = spread(numbered).withColumn("tile", tile(F.col("event_lat"), F.col("event_lon")))
    same = stay.join(at, _same(stay, at, _PLACE), "left_anti")
    # the result is written before the tiles it was made from are replaced
    result, size = stored_observed(
        same.select(*MAP_COLUMNS, "tile").unionByName(renewed.select(*MAP_COLUMNS, "tile")),
        "map-tiles", rows=F.count(F.lit(1)), tiles=F.collect_set("tile"))
    replace_partitions(result, name)
    for empty in sorted(set(replaced) - set(size["tiles"])):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (tile = {empty})")
    return {"candidates": facts["rows"], "read": seen["rows"], "changed": count["rows"],
            "tiles": len(replaced), "written": size["rows"]}


def rebuild_map(spark: SparkSession, schema: str, view: DataFrame) -> None:
    """Replaces the whole table by the rows of ``view``."""
    name = ensure_map(spark, schema)
    rows = stored(view.select(*MAP_COLUMNS).withColumn(
        "tile", tile(F.col("event_lat"), F.col("event_lon"))), "map-rows")
    # whatever the session's mode: tiles without rows go
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
        rows.write.insertInto(name, overwrite=True)


def published_map(spark: SparkSession, schema: str) -> DataFrame:
    """The map table as it is now."""
    name = T.qualified(schema, T.MAP_TABLE)
    spark.catalog.refreshTable(name)
    return spark.table(name).select(*MAP_COLUMNS)
