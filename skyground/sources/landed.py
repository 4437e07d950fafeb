"""Landed files of the two feeds, and the batches written from them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import RAW_DETECTIONS, RAW_REPORT_PAGE, STAMPS, conform


#: Columns that tell a record that is not of its header's form, and where it is: its text, the file,
#: and the byte at which the part of the file begins that holds it.
MALFORMED = ("malformed", "file", "position")


def landed_files(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.csv*"
) -> DataFrame:
    """``path, folder, size`` of every file of that name, from the listing; no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option(
        "recursiveFileLookup", True).load(paths)
    return listed.select(
        "path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.col("length").alias("size"))


def read_detection_files(
    spark: SparkSession, paths: str | Sequence[str], malformed: bool = False, mixed: bool = False,
    pattern: str = "*.csv*",
) -> DataFrame:
    """CSV files with a header, every field text. All chunks and regions in one read.

    Columns are taken by header name; those a product does not have are NULL. Products differ in
    their headers, so each has a folder: the header is read from one file of each folder, folders of
    one header are read together, and a file that breaks its folder's header fails the read. With ``mixed``,
    or where files are named one by one, each goes by its own header; finding the first lines then reads
    all files once more.

    A record with too few or too many fields is padded or cut to its header. With ``malformed`` the
    columns :data:`MALFORMED` tell such records, so that routing can leave them out; they are NULL for others.
    """
    files = landed_files(spark, paths, pattern)
    named = [paths] if isinstance(paths, str) else list(paths)
    if mixed or any(re.search(r"\.csv[^/]*$", p) for p in named):
        units = files.select("path", F.col("path").alias("unit"))
    else:
        units = files.filter("size > 0").groupBy("folder").agg(F.min("path").alias("path")).select(
            "path", F.col("folder").alias("unit"))
    # a row a folder, or with ``mixed`` a file
    unit_of = {r.path: r.unit for r in units.collect()}
    found = None
    for header, own in sorted(_headers(spark, list(unit_of)).items()):
        names = [n.strip() for n in header.lstrip("\ufeff").split(",")]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, "_record")])
        raw = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option(
            "mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record").option(
            "pathGlobFilter", pattern).csv([unit_of[path] for path in own])
        # a blank field is an empty text, as a blank time is midnight; only a column the product does
        # not have is NULL
        fields = [F.coalesce(F.col(f"`{f.name}`"), F.lit("")).alias(f.name) if f.name in names
                  else F.lit(None).cast("string").alias(f.name) for f in RAW_DETECTIONS.fields]
        told = [F.col("_record").alias("malformed"), *[
            F.when(F.col("_record").isNotNull(), F.col(f"_metadata.{c}")).alias(n)
            for c, n in (("file_path", "file"), ("file_block_start", "position"))]]
        rows = raw.select(*fields, *(told if malformed else ()))
        found = rows if found is None else found.unionByName(rows)
    if found is not None:
        return found
    none = [T.StructField("malformed", T.StringType()), T.StructField("file", T.StringType()),
            T.StructField("position", T.LongType())] if malformed else []
    return spark.createDataFrame([], T.StructType([*RAW_DETECTIONS.fields, *none]))


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The first line of each file, and the files that have it."""
    if not paths:
        return {}
    first = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"), "value").filter("at = 0")
    headers: dict[str, list[str]] = {}
    by_name = {_plain(path): path for path in paths}
    for row in first.groupBy("path").agg(F.min_by("value", "line").alias("header")).collect():
        headers.setdefault(row.header, []).append(by_name[_plain(row.path)])
    return {header: sorted(own) for header, own in headers.items()}


def _plain(path: str) -> str:
    """A path without differences in how its beginning is written (``file:/``, ``file:///``)."""
    return re.sub(r"^([a-z0-9+.-]+):/*", r"\1:/", unquote(path), flags=re.IGNORECASE)


def read_report_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """JSON pages ``{"data": [...]}``; a page without ``data`` has no rows. A page that is no JSON,
    such as one cut off or an error page, fails the read."""
    pages = spark.read.schema(RAW_REPORT_PAGE).option("multiLine", True).option(
        "mode", "FAILFAST").json(paths)
    return pages.select(F.explode("data").alias("r")).select("r.*")


def read_batch(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One landed Parquet batch, in the table's types whatever the writer's."""
    return conform(spark.read.parquet(path), schema, absent=STAMPS)


def write_batch(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Replaces a batch: table column order, microsecond timestamps."""
    spark = df.sparkSession
    setting = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "TIMESTAMP_MICROS")
    try:
        conform(df, schema, absent=STAMPS).write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(setting, before)
