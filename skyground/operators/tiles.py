"""Points in a table of boxes of any size, through tiles as large as the boxes.

A box is laid over tiles of its own size, so it touches four of them at most, be it a city or the
globe. A point looks up its one tile on every level that some box has. Both sides of that join may be
crowded: points at one coordinate are combined first, and tiles with very many points or
boxes are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geo import in_box, located
from .skew import hot_keys, split_hot

#: Tiles of level 0 are 360 degrees wide, those of each next level half as wide: 0.02 degrees at last.
MAX_LEVEL = 14
_EDGES = ["min_lat", "max_lat", "min_lon", "max_lon"]
_TILE = ["_level", "_y", "_x"]


def _side(level: int) -> float:
    return 360.0 / 2 ** level


def level_of(height: Column, width: Column) -> Column:
    """The last level whose tiles are at least as high and wide."""
    level = F.lit(0)
    for k in range(1, MAX_LEVEL + 1):
        level = F.when((height <= _side(k)) & (width <= _side(k)), k).otherwise(level)
    return level


def box_tiles(boxes: DataFrame) -> DataFrame:
    """``min_lat, max_lat, min_lon, max_lon, _level, _y, _x``: every different box once for each tile it
    touches. Boxes without an edge, or turned inside out, hold no point and are left out."""
    valid = boxes.select(*_EDGES).filter(
        # NaN is greater than any number
        "min_lat <= max_lat AND min_lon <= max_lon AND NOT isnan(max_lat) AND NOT isnan(max_lon)"
    ).distinct()
    # beyond these no point is looked for, and tile numbers stay small
    cut = valid.withColumns({f"_{c}": F.greatest(F.lit(-360.0), F.least(F.col(c), F.lit(360.0)))
                             for c in _EDGES})
    sized = cut.withColumn("_level", level_of(
        F.col("_max_lat") - F.col("_min_lat"), F.col("_max_lon") - F.col("_min_lon")))
    side = "(360D / shiftleft(1L, _level))"
    for name, low, high in (("_y", "_min_lat", "_max_lat"), ("_x", "_min_lon", "_max_lon")):
        sized = sized.withColumn(name, F.expr(
            f"explode(sequence(floor({low} / {side}), floor({high} / {side})))"))
    return sized.select(*_EDGES, *_TILE)


def coordinate_tiles(coordinates: DataFrame, levels: list[int]) -> DataFrame:
    """Each of ``coordinates (latitude, longitude)`` with its tile on every one of the levels."""
    at = coordinates.withColumn("_level", F.explode(F.array(*map(F.lit, levels))))
    side = "(360D / shiftleft(1L, _level))"
    return at.selectExpr("*", f"coalesce(floor(latitude / {side}), 0L) AS _y",
                         f"coalesce(floor(longitude / {side}), 0L) AS _x")


def keep_in_tiled_boxes(df: DataFrame, boxes: DataFrame, rows_per_task: int = 1_000_000) -> DataFrame:
    """Rows of ``df`` inside at least one closed box ``(min_lat, max_lat, min_lon, max_lon)``; every row
    stays one row, and rows without a place are outside all boxes."""
    points = df.filter(located(F.col("latitude"), F.col("longitude")))
    tiles = box_tiles(boxes)
    # one number a level
    levels = sorted(r[0] for r in tiles.select("_level").distinct().collect())
    if not levels:
        return df.filter("false")
    coordinates = points.select("latitude", "longitude").distinct()
    looked_up = coordinate_tiles(coordinates, levels)
    left, right, on = split_hot(
        looked_up, tiles, _TILE,
        left_hot=hot_keys(looked_up, _TILE, rows_per_task), left_deal=["latitude", "longitude"],
        right_hot=hot_keys(tiles, _TILE, rows_per_task), right_deal=_EDGES)
    p, b = left.alias("p"), right.alias("b")
    inside = [F.col(f"p.{c}") == F.col(f"b.{c}") for c in on] + [in_box(
        F.col("p.latitude"), F.col("p.longitude"), *(F.col(f"b.{c}") for c in _EDGES))]
    hit = p.join(b, inside, "left_semi").select("latitude", "longitude").distinct()
    place = ["latitude", "longitude"]
    rows, found, on = split_hot(
        points, hit, place, left_hot=hot_keys(points, place, rows_per_task), left_deal=df.columns)
    return rows.join(found, on, "left_semi").select(*df.columns)
