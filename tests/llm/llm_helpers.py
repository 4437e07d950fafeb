"""Small tables with the awkward cases every text operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, fp string"

PROSE = ("The old harbour lay quiet in the morning, and the boats moved slowly with the tide. "
         "Gulls cried over the roofs; nobody answered them. A man walked along the wall, counting "
         "his steps aloud, until he reached the lamp at its end. There he sat down and waited.")


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and blank texts, a very long one, repeated rows and ids, and
    columns named like the operators' own."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    rows = [
        (1, PROSE, "en", "a", 1), (1, PROSE, "en", "a", 1), (1, PROSE + " Again.", "en", "a", 1),
        (2, None, "en", "a", None), (3, "", "fr", None, 0), (4, " \n\t ", None, "b", 4),
        (None, PROSE, "en", "b", None), (None, None, None, None, None), (5, long, "de", "c", 5),
        (6, "é😀 " * 30, "fr", "b", 6), (7, PROSE, None, "c", 7), (8, "one", "en", "c", 8),
    ]
    return spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")
