"""Counts per feed part with running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def counts_running(df: DataFrame, column: str, listed: Sequence[str]) -> DataFrame:
    """``(position, <column>, n, running)`` for every listed value, in list order, zeros included.

    Rows are counted map side first, so the running total sees one row per listed value.
    """
    parts = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(v).alias(column))
                      for i, v in enumerate(listed)])
    # the list joins the counts as one more union branch: no join for a fixed list
    zeros = df.sparkSession.range(1).select(F.explode(parts).alias("part")).select(
        f"part.{column}", F.lit(0).cast("bigint").alias("n"), "part.position")
    found = df.filter(F.col(column).isin(*listed)).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")).withColumn("position", F.lit(None).cast("int"))
    counted = zeros.unionByName(found).groupBy(column).agg(
        F.max("position").alias("position"), F.sum("n").alias("n"))
    so_far = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return counted.select("position", column, "n", F.sum("n").over(so_far).alias("running"))
