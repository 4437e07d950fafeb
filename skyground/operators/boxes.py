"""Bounding boxes: region pulls, membership in a fixed list or in a table of boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions.geo import in_any_box, in_box, located
from .skew import hot_keys, split_hot


def keep_in_boxes(df: DataFrame, boxes=V.COUNTRY_BOXES) -> DataFrame:
    """Rows inside at least one box of a short fixed list."""
    return df.filter(in_any_box(F.col("latitude"), F.col("longitude"), boxes))


def pull_regions(df: DataFrame, regions=V.REGION_BOXES) -> DataFrame:
    """A copy of each row for every region it lies in, with the region's label.

    Overlapping regions give duplicates, as separate pulls of the feed do.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    labels = F.array(*[
        F.when(in_box(lat, lon, south, north, west, east), F.lit(label))
        for label, west, south, east, north in regions
    ])
    return df.withColumn("region", F.explode(F.array_compact(labels)))


def keep_in_box_table(
    df: DataFrame, boxes: DataFrame, cell_deg: float = 1.0, rows_per_task: int = 1_000_000
) -> DataFrame:
    """Rows inside at least one box of a table ``(min_lat, max_lat, min_lon, max_lon)``.

    Boxes are laid over a grid and points look up their own cell, so the semi join has keys and
    any number of boxes can be shuffled. Crowded cells are split. Every point stays one row.
    """
    tiles = (
        boxes.select("min_lat", "max_lat", "min_lon", "max_lon").distinct()
        .withColumn("_y", F.expr(
            f"explode(sequence(floor(min_lat / {cell_deg}D), floor(max_lat / {cell_deg}D)))"))
        .withColumn("_x", F.expr(
            f"explode(sequence(floor(min_lon / {cell_deg}D), floor(max_lon / {cell_deg}D)))"))
    )
    points = df.filter(located(F.col("latitude"), F.col("longitude"))).selectExpr(
        "*", f"coalesce(floor(latitude / {cell_deg}D), 0L) AS _y",
        f"coalesce(floor(longitude / {cell_deg}D), 0L) AS _x")
    points, tiles, on = split_hot(
        points, tiles, ["_y", "_x"],
        left_hot=hot_keys(points, ["_y", "_x"], rows_per_task), left_deal=df.columns)
    p, b = points.alias("p"), tiles.alias("b")
    inside = [F.col(f"p.{c}") == F.col(f"b.{c}") for c in on] + [in_box(
        F.col("p.latitude"), F.col("p.longitude"),
        F.col("b.min_lat"), F.col("b.max_lat"), F.col("b.min_lon"), F.col("b.max_lon"))]
    return p.join(b, inside, "left_semi").select(*df.columns)
