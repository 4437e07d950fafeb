"""Splitting hot join keys.

A key that holds a large share of all rows would send them to one task. Its rows are dealt over
several pieces and the matching rows of the other side are copied to each piece, so the join
result is the same. Only balance depends on which keys are found hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.stages import stored

# Hot keys are looked for in 64 hash classes with at most 256 each: 16,384 keys of 16 bytes, so the
# broadcast list stays under 1 MB whatever the size of the data.
_CLASSES = 64
_PER_CLASS = 256


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    rows_per_task: int,
    per_class: int = _PER_CLASS,
) -> DataFrame:
    """``(_hash, _pieces)`` for key hashes with more than ``rows_per_task`` rows.

    A frequent-items sketch per hash class finds them in one pass over the key columns. Sketches
    have a fixed size and are merged map side, so no key column is shuffled; the classes spread
    the merging of many tasks' sketches over as many reducers.
    """
    keyed = df.selectExpr(f"xxhash64({', '.join(f'`{k}`' for k in keys)}) AS _hash")
    sketches = keyed.groupBy(F.expr(f"pmod(_hash, {_CLASSES})").alias("_class")).agg(
        F.expr(f"approx_top_k(_hash, {per_class}, {4 * per_class})").alias("top"))
    return sketches.select(F.explode("top").alias("hot")).filter(
        F.col("hot.count") > rows_per_task
    ).selectExpr(
        "hot.item AS _hash",
        f"ceil(hot.count / {rows_per_task}) AS _pieces",
    )


def _dealt(row_columns: Sequence[str], pieces: str) -> Column:
    # never NULL: pieces is at least 1
    names = ", ".join(f"`{c}`" for c in row_columns)
    return F.expr(f"coalesce(pmod(xxhash64({names}), {pieces}), 0L)")


def split_hot(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    left_deal: Sequence[str] = (),
    right_deal: Sequence[str] = (),
    left_hot: DataFrame | None = None,
    right_hot: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with piece columns added, and the longer key list to join on.

    Rows of a key hot on the left are dealt by the hash of ``left_deal``; the right rows of that
    key are copied to every piece. The same goes the other way round, and a key hot on both sides
    becomes a matrix of pieces.
    """
    for key in keys:
        # equal keys of different types have different hashes, and would get different pieces
        types = left.schema[key].dataType, right.schema[key].dataType
        if types[0] != types[1]:
            raise ValueError(f"join key {key} has types {types[0]} and {types[1]}; cast one side")
    lists = []
    if left_hot is not None:
        lists.append(left_hot.selectExpr("_hash", "_pieces AS _lp", "1L AS _rp"))
    if right_hot is not None:
        lists.append(right_hot.selectExpr("_hash", "1L AS _lp", "_pieces AS _rp"))
    hot = lists[0] if len(lists) == 1 else (
        lists[0].unionByName(lists[1]).groupBy("_hash")
        .agg(F.max("_lp").alias("_lp"), F.max("_rp").alias("_rp")))
    # merging sketches in another order can give other counts: the list is written once, so that
    # both sides read the same one
    hot = stored(hot, "hot-keys")

    def tagged(df: DataFrame) -> DataFrame:
        # at most 16,384 rows per list
        df = df.withColumn("_hash", F.xxhash64(*keys))
        return df.join(F.broadcast(hot), "_hash", "left").selectExpr(
            "* EXCEPT (_hash, _lp, _rp)", "coalesce(_lp, 1L) AS _lp", "coalesce(_rp, 1L) AS _rp")

    left, right = tagged(left), tagged(right)
    every = lambda pieces: F.expr(f"explode(sequence(0L, {pieces} - 1))")
    on = list(keys)
    if left_hot is not None:
        left = left.withColumn("_left_piece", _dealt(left_deal, "_lp"))
        right = right.withColumn("_left_piece", every("_lp"))
        on.append("_left_piece")
    if right_hot is not None:
        right = right.withColumn("_right_piece", _dealt(right_deal, "_rp"))
        left = left.withColumn("_right_piece", every("_rp"))
        on.append("_right_piece")
    return left.drop("_lp", "_rp"), right.drop("_lp", "_rp"), on
