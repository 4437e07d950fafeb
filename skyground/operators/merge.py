"""Insert-only merge: rows whose key the target does not hold yet; the first value stays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.stages import observed
from .skew import hot_keys, split_hot


# The keys of a batch are sent to all executors if they take no more than this.
SMALL_KEYS_BYTES = 32 << 20
ROW_BYTES = 16  # beside the key text itself


def new_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    small_source: bool = False,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Source rows to insert.

    A NULL key matches nothing, so such rows are always new; they skip the join, where they would
    all meet in one task. Several source rows with one new key are all kept.

    The target is first reduced to the keys the source has. With ``small_source`` (its size has
    been checked) that needs no shuffle of the target at all; otherwise both sides are combined
    to distinct keys map side, and source keys that hold very many rows are split.
    """
    keys = list(keys)
    missing = reduce(or_, [F.col(k).isNull() for k in keys])
    keyed = source.filter(~missing)
    wanted = keyed.select(*keys).distinct()
    if small_source:
        known = target.select(*keys).join(F.broadcast(wanted), keys, "left_semi").distinct()
        # at most the distinct keys of the source
        fresh = keyed.join(F.broadcast(known), keys, "left_anti")
    else:
        known = target.select(*keys).distinct().join(wanted, keys, "left_semi")
        left, right, on = split_hot(
            keyed, known, keys,
            left_hot=hot_keys(keyed, keys, rows_per_task), left_deal=source.columns)
        fresh = left.join(right, on, "left_anti")
    return fresh.select(*source.columns).unionByName(source.filter(missing))


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """The target after the merge, as a DataFrame."""
    return target.unionByName(new_rows(source, target, keys, **options))


def insert_new(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    implied_time: str | None = None,
) -> dict[str, int]:
    """Appends the new rows to a table; returns the source and the inserted row counts.

    ``source`` should be a stored stage, since it is read for its size as well as merged. The write
    counts what it inserts, so the target is not counted. Running the merge again inserts nothing:
    the anti join sees the committed rows, and a write that failed has committed none.

    ``implied_time`` names a column that equal keys always share, as when the key is a hash of it.
    Only the part of the target in the batch's time range is then read, so a daily merge does not
    scan the history.
    """
    target = spark.table(table)
    source = source.select(*target.columns)
    key_bytes = " + ".join(f"coalesce(octet_length(CAST(`{k}` AS STRING)), 0)" for k in keys)
    ends = [] if implied_time is None else [F.min(implied_time), F.max(implied_time)]
    rows, size, *span = source.agg(
        F.count(F.lit(1)), F.expr(f"coalesce(sum({key_bytes}), 0)"), *ends).first()
    small = size + rows * ROW_BYTES <= SMALL_KEYS_BYTES
    known = target
    if implied_time is not None:
        first, last = span
        when = F.col(implied_time)
        known = target.filter(when.isNull() if first is None else
                              when.between(first, last) | when.isNull())
    found = observed(
        new_rows(source, known, keys, small_source=small),
        lambda df: df.write.insertInto(table), inserted=F.count(F.lit(1)))
    return {"source": rows, "inserted": found["inserted"]}
