"""Exact dedup on a composite key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    null_keys_differ: bool = False,
) -> DataFrame:
    """One row per key: the first by ``order``, then by the other columns.

    A minimum over a struct, so copies of a key are combined before the shuffle and the result
    does not depend on arrival order. A value comes before NULL, so of two copies the fuller one
    stays. NULL keys count as equal unless ``null_keys_differ``.
    """
    names = df.columns
    rest = [*order, *(c for c in names if c not in keys and c not in order)]
    if not rest:
        return df.distinct()
    unkeyed = None
    if null_keys_differ:
        missing = F.lit(False)
        for key in keys:
            missing = missing | F.col(key).isNull()
        unkeyed, df = df.filter(missing), df.filter(~missing)
    # a struct orders NULL first; whether a value is missing is therefore compared before the value
    missing_last = [c for i, r in enumerate(rest)
                    for c in (F.col(f"`{r}`").isNull().alias(f"n{i}"), F.col(f"`{r}`").alias(f"v{i}"))]
    kept = (
        df.groupBy(*keys).agg(F.min(F.struct(*missing_last)).alias("_first"))
        .select(*keys, *[F.col(f"_first.v{i}").alias(r) for i, r in enumerate(rest)])
        .select(*names)
    )
    return kept if unkeyed is None else kept.unionByName(unkeyed)
