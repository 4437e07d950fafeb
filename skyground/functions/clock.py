"""Time as whole UTC seconds, independent of the session time zone where the input allows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_s(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 UTC, rounded down. NTZ input reads as session time."""
    return F.unix_seconds(ts.cast("timestamp"))


def midnight_s(day: Column) -> Column:
    """UTC midnight of a DATE, as epoch seconds."""
    return F.unix_date(day).cast("bigint") * 86_400


def hours_between(start_s: Column, end_s: Column) -> Column:
    """Signed hours from start to end, as FLOAT."""
    return ((end_s - start_s) / 3600.0).cast("float")


def bucket(sec: Column, width_s: int) -> Column:
    return F.coalesce(F.floor(sec / width_s), F.lit(0))


def buckets(from_s: Column, to_s: Column, width_s: int) -> Column:
    """Every bucket of a closed interval, as an array."""
    return F.sequence(bucket(from_s, width_s), bucket(to_s, width_s))


def batch_days(today, lag_days: int = 0, lookback_days: int = 1, extra_day: bool = False):
    """(first, last) day of a rolling batch.

    The detection feed counts the last day itself, the report feed (``extra_day``) adds one.
    """
    from datetime import timedelta

    last = today - timedelta(days=lag_days)
    return last - timedelta(days=lookback_days - (0 if extra_day else 1)), last


def explicit_days(start=None, end=None):
    """Both ends of an archive range, or neither."""
    if (start is None) != (end is None):
        raise ValueError("start and end must be given together")
    if start is not None and end < start:
        raise ValueError("end lies before start")
    return start, end
