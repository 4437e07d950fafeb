"""Text and style columns of the map page."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as V
from .parsing import source_names


def date_prefix(text: Column, length: int = 10) -> Column:
    """First characters of a date text ('' when missing): 10 for the day, 7 for the month."""
    return F.substring(F.coalesce(text, F.lit("")), 1, length)


def one_decimal(number: Column) -> Column:
    """One digit after the point, rounded on the exact binary value (ties up, away from zero for
    negative numbers); NULL stays NULL.

    Ten times the number is taken as a rounded product and its exact error (by splitting the number
    into two halves of its digits). Only where the product ends in one half does the error decide.
    """
    size = F.abs(number.cast("double"))
    times = size * 10
    high = size * 134217729.0 - (size * 134217729.0 - size)
    error = (high * 10 - times) + (size - high) * 10
    part = times - F.floor(times)
    up = (part > 0.5) | ((part == 0.5) & (error >= 0))
    tenths = F.floor(times) + F.when(up, 1).otherwise(0)
    sign = F.when(number.cast("double") < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(number.isNotNull(), F.concat(
        sign, F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string")))


def score_text(score: Column) -> Column:
    return F.when(score.isNull(), F.lit(V.MISSING_TEXT)).otherwise(one_decimal(score))


def confidence_text(confidence: Column) -> Column:
    high = F.coalesce(confidence == V.HIGH_CONFIDENCE, F.lit(False))
    return F.when(high, F.lit("High confidence")).otherwise(F.lit("Nominal"))


def frp_text(frp: Column) -> Column:
    return F.concat(F.lit("FRP "), one_decimal(frp), F.lit(" MW"))


def sources_text(count: Column) -> Column:
    """'1 source', '3 sources'; a missing count shows as 'null source', as the page has it."""
    shown = F.coalesce(count.cast("string"), F.lit("null"))
    return F.concat(shown, F.lit(" source"), F.when(count > 1, F.lit("s")).otherwise(F.lit("")))


def distance_text(distance_m: Column) -> Column:
    return F.concat(one_decimal(distance_m.cast("double") / 1000), F.lit(" km apart"))


def source_list_text(text: Column) -> Column:
    return F.array_join(source_names(text), V.SOURCE_SEPARATOR)


def marker_colour(confidence: Column) -> Column:
    high = F.coalesce(confidence == V.HIGH_CONFIDENCE, F.lit(False))
    return F.when(high, F.lit(V.COLOUR_HIGH)).otherwise(F.lit(V.COLOUR_OTHER))


def marker_radius(score: Column) -> Column:
    """Between 6 and 22 pixels; a missing or zero score is drawn as 2."""
    seen = F.coalesce(F.nullif(score.cast("double"), F.lit(0.0)), F.lit(2.0))
    return F.greatest(F.least(F.sqrt(seen) * 1.8 + 6.0, F.lit(22.0)), F.lit(6.0))


def range_text(first: Column, last: Column) -> Column:
    """One month, or 'first – last'."""
    return F.when(first == last, first).otherwise(
        F.concat(first, F.lit(V.RANGE_SEPARATOR), last))
