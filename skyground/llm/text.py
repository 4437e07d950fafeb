"""Words as the operators see them, in Python tasks and in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.stages import shared_folder

#: What separates words: ASCII blanks only. ``bytes.split()`` cuts at the same six characters.
BLANKS = r"[ \t-\r]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BLANKS}+"), "")


def map_batches(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
) -> DataFrame:
    """``work`` on pieces of Arrow batches with at most 16 MB of text each (one row at least), so
    that neither long texts nor many rows fill a task's memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield work(piece)

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batch cut between rows."""
    if batch.num_rows == 0:
        return
    rows = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def spare(columns: Sequence[str], name: str) -> str:
    """A name like ``name`` that none of ``columns`` has, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_row(docs: DataFrame, row: str, name: str) -> DataFrame:
    """``docs`` with a unique long ``row``, stored in buckets by it.

    Every later join on that column takes the documents where they lie and moves only the other
    side, so texts cross the network once, however many steps look some of them up. The table's entry in
    the catalog is that of this run; its files are in the shared folder, like all stages.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = f"stage_{name}_{uuid.uuid4().hex}"
    docs.withColumn(row, F.monotonically_increasing_id()).repartition(parts, row).write.bucketBy(
        parts, row).option("path", f"{shared_folder(spark)}/{table}").saveAsTable(table)
    return spark.table(table)
