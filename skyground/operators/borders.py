"""Near-duplicate removal over batches that come one after the other.

Two rows of different batches can only meet where their batches do: within the time radius of the
ends of both. These few rows of every batch are kept, and a batch is compared with those of the others.
Batches whose times do not overlap then give what one dedup of all of them gives, in any order of
arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions.clock import epoch_s
from .proximity import dominated_ids

POINT = ("id", "latitude", "longitude", "acq_datetime")


def near_ends(df: DataFrame, first_s: int, last_s: int, window_s: int = V.DEDUP_WINDOW_S) -> DataFrame:
    """The rows within ``window_s`` of a batch's first or last second."""
    second = epoch_s(F.col("acq_datetime"))
    return df.filter((second <= first_s + window_s) | (second >= last_s - window_s))


def dominated_across(batch: DataFrame, neighbours: DataFrame, **options) -> DataFrame:
    """Ids of ``batch`` and of ``neighbours``, the kept ends of other batches, that a higher id of either
    dominates. Options are those of :func:`~.proximity.dominated_ids`."""
    return dominated_ids(
        batch.select(*POINT).unionByName(neighbours.select(*POINT)), **options)


def split_dominated(batch: DataFrame, neighbours: DataFrame, gone: DataFrame
                    ) -> tuple[DataFrame, DataFrame]:
    """The rows of ``batch`` that stay, and the ids of earlier batches that are to be taken back:
    rows of ``neighbours`` that had been kept and that this batch dominates. ``gone`` is a stored
    result of :func:`dominated_across`."""
    gone = gone.hint("merge")  # most rows of a crowded batch
    kept = batch.join(gone, "id", "left_anti")
    back = neighbours.filter("kept").select("id").distinct().join(gone, "id", "left_semi")
    return kept, back
