"""Which parts of the landed feeds a batch takes: date chunks, request list, batch window."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V


def date_chunks(
    df: DataFrame, start: str, end: str, max_days: int = V.MAX_DAYS_PER_REQUEST
) -> DataFrame:
    """Splits the closed day range of every row into ``(chunk_start, chunk_days)`` rows."""
    chunk = F.explode(F.sequence(F.col(start), F.col(end), F.expr(f"INTERVAL {max_days} DAYS")))
    # an empty range has no chunk; sequence() would count down instead
    return df.filter(F.col(start) <= F.col(end)).withColumn("chunk_start", chunk).withColumn(
        "chunk_days",
        F.least(F.date_diff(F.col(end), F.col("chunk_start")) + 1, F.lit(max_days)))


def products_for(lag_days: int) -> tuple[str, ...]:
    """The archive products serve days the recent ones no longer hold."""
    return V.ARCHIVE_PRODUCTS if lag_days > V.ARCHIVE_AFTER_DAYS else V.RECENT_PRODUCTS


def request_list(
    days: DataFrame, products: tuple[str, ...] = V.RECENT_PRODUCTS, regions=V.REGION_BOXES
) -> DataFrame:
    """Region x product x chunk for each row of ``days(first_day, last_day)``.

    The two short lists are expanded in place, so no join is needed.
    """
    def each(values) -> Column:
        return F.explode(F.array(*[F.lit(v) for v in values]))

    return date_chunks(days, "first_day", "last_day").withColumn(
        "region", each(r[0] for r in regions)).withColumn("product", each(products))


def in_days(df: DataFrame, day: Column, first: date | str, last: date | str) -> DataFrame:
    """Rows of a closed day range."""
    return df.filter(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
