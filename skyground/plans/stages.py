"""Stored intermediate stages."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``. Where that is unset, a folder of the
    warehouse takes its place if every task can reach it: in a local session, or when the warehouse
    is in a store. On a cluster a plain or ``file:`` warehouse is local to one machine, and the
    call fails."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = (spark.conf.get("spark.sql.warehouse.dir", None) or "spark-warehouse").rstrip("/")
    in_store = "://" in warehouse and not warehouse.startswith("file:")
    if not in_store and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse}/stages"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed once, lineage cut,
    columns still prunable. Survives the loss of executors; the files are left to the folder's own
    clean-up."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the actions of a block; what was there before comes back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Writes ``df`` over the partitions of a table that it has rows for, and no others. ``df`` may
    read other partitions of the same table."""
    # the option of the writer is not heeded by insertInto
    with setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.write.mode("overwrite").insertInto(table)


def observed(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict:
    """Aggregates of the rows that ``write`` writes, gathered by the write itself: no further scan.

    The rows are observed in the stage that writes them, where Spark counts every partition once, in the
    attempt that was committed; a task that ran twice, or a lost executor, changes nothing. What is
    computed from shuffled rows further up is not observed, since such stages may be repeated.
    """
    seen = Observation()
    write(df.observe(seen, *[column.alias(name) for name, column in metrics.items()]))
    return seen.get


def stored_observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`stored` with aggregates of the stored rows."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{name}-{uuid.uuid4().hex}"
    found = observed(df, lambda rows: rows.write.parquet(path), **metrics)
    return spark.read.schema(df.schema).parquet(path), found
