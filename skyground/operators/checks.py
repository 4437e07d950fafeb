"""Counts, statistics and pass/fail checks as DataFrames; one function raises."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as V
from .proximity import residual_pairs


class CheckFailed(RuntimeError):
    """Raised with every failed check, not only the first."""


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """``(stage, n)`` for each named frame."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        for name, df in stages.items()
    ])


def removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row ``removed``: how many rows a step took away."""
    marks = [df.agg((F.count(F.lit(1)) * sign).alias("m"))
             for df, sign in ((before, 1), (after, -1))]
    return marks[0].unionByName(marks[1]).agg(F.sum("m").alias("removed"))


def score_stats(pairs: DataFrame) -> DataFrame:
    """Least, mean and greatest score, raw and as displayed; NULLs when there are no pairs."""
    score = F.col("score").cast("double")
    return pairs.agg(
        F.min(score).alias("score_min"), F.avg(score).alias("score_avg"),
        F.max(score).alias("score_max"),
    ).select("*", *[
        (F.col(f"score_{s}") * V.DISPLAY_SCALE).alias(f"display_{s}") for s in ("min", "avg", "max")
    ])


def bad_scores(pairs: DataFrame) -> DataFrame:
    """One row ``n``: scores outside [0, 1]. A NULL score is not counted."""
    return pairs.agg(F.count_if((F.col("score") < 0) | (F.col("score") > 1)).alias("n"))


def contract_checks(silver: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(check_name, value, passed)`` of the job's own contract."""
    filled = silver.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("silver_rows").alias("check_name"), "value", (F.col("value") > 0).alias("passed"))
    left_over = residual_pairs(silver).select(
        F.lit("residual_pairs").alias("check_name"),
        F.col("residual").cast("double").alias("value"), (F.col("residual") == 0).alias("passed"))
    ends = score_stats(pairs).select(F.explode(F.array(
        F.struct(F.lit("score_min").alias("check_name"), F.col("score_min").alias("value"),
                 F.coalesce(F.col("score_min") >= 0, F.lit(True)).alias("passed")),
        F.struct(F.lit("score_max").alias("check_name"), F.col("score_max").alias("value"),
                 F.coalesce(F.col("score_max") <= 1, F.lit(True)).alias("passed")),
    )).alias("row")).select("row.*")
    return filled.unionByName(left_over).unionByName(ends)


def observed_contract(
    spark: SparkSession, silver_rows: int, residual: DataFrame | None,
    score_min: float | None, score_max: float | None,
) -> DataFrame:
    """:func:`contract_checks` from what the writes have observed; ``residual`` is one row of
    :func:`~.proximity.residual_pairs`, or None where it is not audited."""
    rows = [("silver_rows", float(silver_rows), silver_rows > 0),
            ("score_min", score_min, score_min is None or score_min >= 0),
            ("score_max", score_max, score_max is None or score_max <= 1)]
    seen = spark.createDataFrame(rows, "check_name string, value double, passed boolean")
    return seen if residual is None else seen.unionByName(residual.select(
        F.lit("residual_pairs").alias("check_name"),
        F.col("residual").cast("double").alias("value"), (F.col("residual") == 0).alias("passed")))


def verification_summary(silver: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(item, value)``: rows of both tables, near-duplicates left, score statistics.

    The best pairs that complete the summary are :func:`~.ranking.top_pairs`.
    """
    counts = row_counts({"silver_rows": silver, "pair_rows": pairs}).select(
        F.col("stage").alias("item"), F.col("n").cast("double").alias("value"))
    left_over = residual_pairs(silver).select(
        F.lit("residual_pairs").alias("item"), F.col("residual").cast("double").alias("value"))
    stats = score_stats(pairs)
    return counts.unionByName(left_over).unionByName(stats.unpivot(
        [], [F.col(c) for c in stats.columns], "item", "value"))


def table_health(tables: dict[str, DataFrame], pairs_name: str) -> DataFrame:
    """Every table non-empty and no score outside [0, 1]: ``(check_name, value, passed)``."""
    sizes = row_counts(tables).select(
        F.concat("stage", F.lit("_rows")).alias("check_name"),
        F.col("n").alias("value"), (F.col("n") > 0).alias("passed"))
    scores = bad_scores(tables[pairs_name]).select(
        F.lit("bad_scores").alias("check_name"), F.col("n").alias("value"),
        (F.col("n") == 0).alias("passed"))
    return sizes.unionByName(scores)


def require(checks: DataFrame) -> None:
    """Raises :class:`CheckFailed` naming every failed check. There are a handful of rows."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r.check_name} = {r.value}" for r in failed))
