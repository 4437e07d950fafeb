"""Arrays of fixed size summed over all rows of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def summed(
    df: DataFrame,
    fold: Callable[[Iterator[pa.RecordBatch]], dict[str, np.ndarray]],
    sizes: dict[str, int],
) -> dict[str, np.ndarray]:
    """The sum over all tasks of what ``fold`` makes of each task's batches.

    ``fold`` gives a flat array for some of the names in ``sizes``, of that length. Sums are by name
    and place, so as many numbers as ``sizes`` has reach the driver, however many rows or tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, values in fold(batches).items():
            at = np.flatnonzero(values)
            for start in range(0, len(at), 1 << 16):
                some = at[start:start + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(some), pa.string()), pa.array(some, pa.int64()),
                     pa.array(values[some], pa.float64())], names=["name", "place", "value"])

    parts = df.mapInArrow(run, "name string, place bigint, value double")
    rows = parts.groupBy("name", "place").agg(F.sum("value").alias("value")).toPandas()
    found = {name: np.zeros(size) for name, size in sizes.items()}
    for name, own in rows.groupby("name"):
        found[name][own["place"].to_numpy(dtype=np.int64)] = own["value"].to_numpy(dtype=float)
    return found


def upper(matrix: np.ndarray) -> np.ndarray:
    """The upper half of a symmetric matrix, flat."""
    return matrix[np.triu_indices(len(matrix))]


def symmetric(flat: np.ndarray, width: int) -> np.ndarray:
    """The symmetric matrix of an upper half."""
    matrix = np.zeros((width, width))
    matrix[np.triu_indices(width)] = flat
    return matrix + np.triu(matrix, 1).T
