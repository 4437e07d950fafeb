"""Which planned pulls of a feed have landed, and which days are missing.

A pull that failed leaves nothing behind, and a batch made without it looks whole. The ledger holds
what is there: the days of every chunk with a landed file, from its path alone, and the days that
rows have. What was planned and is in neither is missing, and neighbouring days are one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .. import fixed_values as V
from .requests import date_chunks

KEYS = ("region", "product")


def file_ledger(spark: SparkSession, path: str, suffix: str = "*.csv",
                keys: Sequence[str] = KEYS) -> DataFrame:
    """``<keys>, chunk_start, chunk_days, files, size`` of landed files under
    ``.../<key>=<value>/.../chunk_start=<day>/chunk_days=<n>/``. Files are listed, not opened, so an
    answer without rows, which has its header, is there as well. A file without a byte is a pull that
    failed, and files whose path does not tell their chunk are left out."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", suffix).option(
        "recursiveFileLookup", True).load(path).select("path", "length")

    def part(name: str):
        return F.url_decode(F.nullif(
            F.regexp_extract("path", rf"/{name}=([^/]*)/", 1), F.lit("")))

    told = listed.select(
        *[part(k).alias(k) for k in keys], part("chunk_start").try_cast("date").alias("chunk_start"),
        part("chunk_days").try_cast("int").alias("chunk_days"), "length")
    return told.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in (*keys, "chunk_start", "chunk_days"))
                       ).groupBy(*keys, "chunk_start", "chunk_days").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("size"))


def row_ledger(rows: DataFrame, day: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """``<keys>, day, rows``: the days that landed rows have; counted map side."""
    return rows.filter(F.col(day).isNotNull()).groupBy(*keys, F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"))


def days_of(chunks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``<keys>, day`` for every day of ``chunks (chunk_start, chunk_days)``, each once."""
    return chunks.filter("chunk_days > 0").select(*keys, F.explode(F.sequence(
        "chunk_start", F.date_add("chunk_start", F.col("chunk_days").cast("int") - 1))
    ).alias("day")).distinct()


def missing_days(planned: DataFrame, *ledgers: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``<keys>, day``: days of the planned chunks that no ledger has. A ledger has ``day``, or
    ``chunk_start`` and ``chunk_days``."""
    landed = None
    for ledger in ledgers:
        own = ledger.select(*keys, "day") if "day" in ledger.columns else days_of(ledger, keys)
        landed = own if landed is None else landed.unionByName(own)
    wanted = days_of(planned, keys)
    return wanted if landed is None else wanted.join(landed, [*keys, "day"], "left_anti")


def ranges(days: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``<keys>, first_day, last_day, days``: neighbouring days as one range. ``days`` has each day
    once for its keys.

    A day less its number in the order of days is the same all along a range. A window holds the days of
    one key, as many as the plan has days.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("day"))
    return days.withColumn("island", F.date_sub("day", number)).groupBy(*keys, "island").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("days")).drop("island")


def missing_ranges(planned: DataFrame, *ledgers: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The ranges of days to pull again."""
    return ranges(missing_days(planned, *ledgers, keys=keys), keys)


def requests_for(missing: DataFrame, keys: Sequence[str] = KEYS,
                 max_days: int = V.MAX_DAYS_PER_REQUEST) -> DataFrame:
    """The chunks that pull missing ranges again: ``<keys>, chunk_start, chunk_days``."""
    return date_chunks(missing, "first_day", "last_day", max_days).select(
        *keys, "chunk_start", "chunk_days")
