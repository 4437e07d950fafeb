"""Points written in a space-filling order, so that a box is read from the few files that touch it."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as V
from ..functions.geo import in_box
from ..functions.morton import morton, ranges

CODE = "morton"


def write_clustered(df: DataFrame, path: str, files: int, lat: str = "latitude", lon: str = "longitude"
                    ) -> None:
    """Replaces ``path`` by the rows in order of their codes, in about ``files`` files, and notes the
    codes of each file beside them.

    Ranges are cut by a sample of the codes, so files are even where points are crowded; a code with
    very many rows is spread over several by a hash. Rows without a place are in files of their own.
    """
    spark = df.sparkSession
    coded = df.withColumn(CODE, morton(F.col(lat), F.col(lon)))
    coded.withColumn("_deal", F.xxhash64(*df.columns)).repartitionByRange(
        files, CODE, "_deal").sortWithinPartitions(CODE).drop("_deal").write.mode(
        "overwrite").parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(CODE).alias("first"), F.max(CODE).alias("last"),
        F.bool_or(F.col(CODE).isNull()).alias("unplaced"), F.count(F.lit(1)).alias("n")).coalesce(
        1).write.mode("overwrite").parquet(f"{path}/files")


def _touched(codes: list[tuple[int, int]], first: Column, last: Column) -> Column:
    return reduce(or_, [(first <= b) & (last >= a) for a, b in codes], F.lit(False))


def files_for(spark: SparkSession, path: str, boxes) -> list[str]:
    """The files that can hold points of any of the ``boxes`` (code, south, north, west, east)."""
    codes = [r for _, s, n, w, e in boxes for r in ranges(s, n, w, e)]
    listed = spark.read.parquet(f"{path}/files")
    # names of the files that are going to be read
    return sorted(r.file for r in listed.filter(
        _touched(codes, F.col("first"), F.col("last"))).select("file").collect())


def read_boxes(spark: SparkSession, path: str, boxes=V.COUNTRY_BOXES, lat: str = "latitude",
               lon: str = "longitude") -> DataFrame:
    """The rows inside at least one closed box. Other files are not opened; within files, the ranges of
    codes let whole row groups be skipped, and the exact test decides."""
    codes = [r for _, s, n, w, e in boxes for r in ranges(s, n, w, e)]
    whole = spark.read.parquet(f"{path}/rows")
    files = files_for(spark, path, boxes)
    if not files:
        return whole.filter("false").drop(CODE)
    inside = reduce(or_, [in_box(F.col(lat), F.col(lon), s, n, w, e) for _, s, n, w, e in boxes])
    return spark.read.schema(whole.schema).parquet(*files).filter(
        _touched(codes, F.col(CODE), F.col(CODE))).filter(inside).drop(CODE)
