"""Reads of the map view: filter, date range, marker and popup columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import display as D


def visible(
    rows: DataFrame,
    min_score: float = 0.0,
    air: bool = True,
    shell: bool = True,
    date_from: str = "",
    date_to: str = "",
) -> DataFrame:
    """Rows of the export that pass the page's filter. Dates are compared as text; an empty bound
    is open, and a row without a date fails any lower bound."""
    kind = F.lower(F.coalesce("event_sub_event_type", F.lit("")))
    date = D.date_prefix(F.col("event_datetime"))
    rows = rows.filter(F.coalesce("score_display", F.lit(0.0)) >= min_score)
    if not air:
        rows = rows.filter(~kind.contains("air"))
    if not shell:
        rows = rows.filter(~kind.contains("shell"))
    if date_from:
        rows = rows.filter(date >= date_from)
    if date_to:
        rows = rows.filter(date <= date_to)
    return rows


def date_range(rows: DataFrame) -> DataFrame:
    """First and last date and month with any date, and the header text; NULLs when none."""
    dates = rows.select(D.date_prefix(F.col("event_datetime")).alias("d")).filter("d <> ''")
    ends = dates.agg(F.min("d").alias("first_date"), F.max("d").alias("last_date"))
    return ends.select(
        "first_date", "last_date",
        F.substring("first_date", 1, 7).alias("first_month"),
        F.substring("last_date", 1, 7).alias("last_month"),
        D.range_text(F.substring("first_date", 1, 7), F.substring("last_date", 1, 7))
        .alias("header_range"),
    )


def marker_style(rows: DataFrame) -> DataFrame:
    """Adds marker colour and radius."""
    return rows.withColumns({
        "colour": D.marker_colour(F.col("fire_confidence")),
        "radius": D.marker_radius(F.col("score_display")),
    })


def popup_text(rows: DataFrame) -> DataFrame:
    """Adds the texts shown for a marker."""
    return rows.withColumns({
        "score_text": D.score_text(F.col("score_display")),
        "confidence_text": D.confidence_text(F.col("fire_confidence")),
        "frp_text": D.frp_text(F.col("fire_frp")),
        "sources_text": D.sources_text(F.col("event_num_sources")),
        "distance_text": D.distance_text(F.col("distance_m")),
        "source_list": D.source_list_text(F.col("event_source")),
        "date_text": D.date_prefix(F.col("event_datetime")),
    })
