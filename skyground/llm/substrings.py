"""Removal of passages that an earlier document holds, with a count-min prefilter.

A window is ``WINDOW`` consecutive words of one document. Counting all windows exactly would send
one row per word over the network. Instead

1. every window is represented by its anchor, the sequence of ``ANCHOR`` words in it with the least
   hash. Equal windows have equal anchors, and neighbouring windows mostly share one, so a document
   has one anchor for about ten words. Each task counts the documents of its anchors in count-min
   sketches, of which it sends the counters it touched; these are merged block by block.
2. The merged sketch only overestimates. Windows whose anchor it counts once have no equal in
   another document; all others are grouped exactly, by 128-bit hashes of their words.

Documents with equal words are represented by the one with the smallest id throughout, so a large
group of copies is counted once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..plans.stages import stored
from .text import pieces

WINDOW, ANCHOR = 50, 32
#: The sketch has ``_ROWS`` rows of a power of two counters, four for each
#: anchor that the input's size lets expect, but at most 2**26, so that the merged sketch, with
#: one bit a counter left, is 24 MB to broadcast. A fuller sketch lets more windows through to the
#: exact grouping; the result is the same.
_ROWS, _LEAST_BITS, _MOST_BITS, _BLOCK = 3, 16, 26, 1 << 16
#: Anchors a task holds before it sends their counters: neither a task nor a row it sends grows with
#: the sketch, which no task has whole.
_HELD_ANCHORS = 1 << 19
#: Ids of copies that may be broadcast: 16 MB.
_LISTED_IDS = 1 << 21
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))


def sequence_hashes(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """Polynomial hashes modulo 2**64 of all sequences of ``length`` words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, dtype=np.uint64)
        value, power, step = words, np.uint64(base), 1
        # by doubling: value holds the hashes of ``step`` words, total those of the first ``done``
        done = 0
        while True:
            if length & step:
                total = total * power + value[done:done + n]
                done += step
            if 2 * step > length:
                return total ^ (total >> np.uint64(32))
            value = value[:-step] * power + value[step:]
            power, step = power * power, 2 * step


def anchors(words: np.ndarray, window: int, size: int) -> np.ndarray:
    """For each window the hash of its anchor, the least of its ``size``-word sequences."""
    hashes = sequence_hashes(words, size, _BASES[0]) * np.uint64(_BASES[1])
    width = window - size + 1
    least, step = hashes, 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[:len(least) - (width - step)], least[width - step:])
    return least


def _cells(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """The counter of each value in every row of the sketch."""
    spread = values * np.uint64(0xFF51AFD7ED558CCD)
    spread ^= spread >> np.uint64(33)
    low = spread & np.uint64((1 << bits) - 1)
    high = (spread * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(64 - bits)
    other = (spread * np.uint64(0x165667B19E3779F9)) >> np.uint64(64 - bits)
    return [cells.astype(np.int64) for cells in (low, high, other)]


def _touched(values: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """``block, places``: the counters of the values, by the row's blocks, as 16-bit places in the
    block; a counter of two values or more is there twice."""
    width = min(_BLOCK, 1 << bits)
    for r, cells in enumerate(_cells(values, bits)):
        cells, counts = np.unique(cells, return_counts=True)
        cells = np.repeat(cells, np.minimum(counts, 2))
        blocks = cells // width
        starts = np.flatnonzero(np.diff(blocks, prepend=-1))
        places = (cells % width).astype("<u2")
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks[starts] + r * ((1 << bits) // width), pa.int64()),
             pa.array([own.tobytes() for own in np.split(places, starts[1:])], pa.binary())],
            names=["block", "places"])


def _sketches(firsts: DataFrame, bits: int, window: int, size: int) -> DataFrame:
    """``block, places`` of :func:`_touched` for the anchors of all texts, some at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in (part for whole in batches for part in pieces(whole, 4 << 20)):
            for text in batch.column("text").to_pylist():
                words = _words(text)
                if len(words) < window:
                    continue
                # a document counts once for an anchor, however often it has it
                held.append(np.unique(anchors(word_hashes(words), window, size)))
                count += len(held[-1])
                if count >= _HELD_ANCHORS:
                    yield from _touched(np.concatenate(held), bits)
                    held, count = [], 0
        if held:
            yield from _touched(np.concatenate(held), bits)

    return firsts.select("text").mapInArrow(run, "block bigint, places binary")


def _merged(sketches: DataFrame, bits: int) -> list[np.ndarray]:
    """For each row of the sketch, whether each counter is 2 or more, as packed bits."""
    width = min(_BLOCK, 1 << bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()),
                 pa.array([np.packbits(total >= 2).tobytes()], pa.binary())],
                names=["block", "often"])

        # rows come by block, so one block is held at a time
        block, total = -1, np.zeros(width, dtype=np.int64)
        for batch in batches:
            blocks, places = batch.column("block").to_numpy(), batch.column("places")
            starts = np.flatnonzero(np.diff(blocks, prepend=-1)).tolist()
            for start, end in zip(starts, [*starts[1:], len(blocks)]):
                if blocks[start] != block:
                    if block >= 0:
                        yield packed()
                    block, total = int(blocks[start]), np.zeros(width, dtype=np.int64)
                own = np.frombuffer(b"".join(places[start:end].to_pylist()), dtype="<u2")
                total += np.bincount(own, minlength=width)
        if block >= 0:
            yield packed()

    often = [np.zeros((1 << bits) // 8, dtype=np.uint8) for _ in range(_ROWS)]
    blocks = (1 << bits) // width
    # the size of the sketch bounds what comes here: at most 24 MB
    for block, packed in sketches.repartition("block").sortWithinPartitions("block").mapInArrow(
            merge, "block bigint, often binary").collect():
        row, at = divmod(block, blocks)
        often[row][at * width // 8:(at + 1) * width // 8] = np.frombuffer(packed, dtype=np.uint8)
    return often


def _estimated_twice(values: np.ndarray, often: list[np.ndarray], bits: int) -> np.ndarray:
    found = np.ones(len(values), dtype=bool)
    for row, cells in zip(often, _cells(values, bits)):
        found &= (row[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
    return found


def _suspects(firsts: DataFrame, often, bits: int, window: int, size: int) -> DataFrame:
    """``doc_id, sha256, text, windows`` of the texts with windows whose anchor is estimated in two
    texts or more; ``windows`` has place and hashes of these."""
    shared = firsts.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in (part for whole in batches for part in pieces(whole, 2 << 20)):
            rows, shas, counts, parts = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = _words(text)
                if len(words) < window:
                    continue
                hashes = word_hashes(words)
                at = np.flatnonzero(
                    _estimated_twice(anchors(hashes, window, size), often, bits))
                if len(at):
                    rows.append(i)
                    shas.append(_sha256(words))
                    counts.append(len(at))
                    parts.append((at.astype(np.int32), *(
                        sequence_hashes(hashes, window, base)[at].view(np.int64)
                        for base in _BASES)))
            if rows:
                windows = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*parts)], names=["at", "h1", "h2"])
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(taken), pa.array(shas),
                     batch.column("text").take(taken),
                     pa.ListArray.from_arrays(
                         pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), windows)],
                    names=["doc_id", "sha256", "text", "windows"])

    id_type = firsts.schema["doc_id"].dataType.simpleString()
    return firsts.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, sha256 string, text string, "
             "windows array<struct<at: int, h1: bigint, h2: bigint>>")


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _sha256(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _summaries(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, sha256`` (of the words joined by one blank) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces(whole, 4 << 20)):
            counts, shas = [], []
            for text in batch.column("text").to_pylist():
                words = _words(text)
                counts.append(len(words))
                shas.append(_sha256(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(shas, pa.string())], names=["doc_id", "n_words", "sha256"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_words bigint, sha256 string")


def _without(suspects: DataFrame, window: int) -> DataFrame:
    """``sha256, rank, n_removed, kept`` from texts and the places of repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces(whole, 4 << 20)):
            removed, kept = [], []
            for text, starts in zip(
                    batch.column("text").to_pylist(), batch.column("starts").to_pylist()):
                words = _words(text)
                change = np.zeros(len(words) + 1, dtype=np.int64)
                starts = np.unique(np.array(starts, dtype=np.int64))
                change[starts] += 1
                change[starts + window] -= 1
                covered = np.cumsum(change[:-1]) > 0
                removed.append(int(covered.sum()))
                kept.append(b" ".join(
                    [w for w, gone in zip(words, covered.tolist()) if not gone]).decode(
                        "utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sha256"), batch.column("rank"), pa.array(removed, pa.int64()),
                 pa.array(kept)], names=["sha256", "rank", "n_removed", "kept"])

    return suspects.select("sha256", "rank", "text", "starts").mapInArrow(
        run, "sha256 string, rank bigint, n_removed bigint, kept string")


def removals(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, sha256, n_removed, kept`` for every row.

    A word goes if a window covers it whose words also start in a document with a smaller doc_id;
    windows are judged on the input. ``sha256`` is that of all words joined by one blank, ``kept``
    the words that stay, joined likewise, and null where all stay. Null and empty texts have no
    words. Rows of one id never remove from each other; rows without an id come after all others
    and do not remove from each other. Empty tables give empty results.
    """
    # rows without an id come last
    rank = "coalesce(cast(doc_id AS bigint), 9223372036854775807L) AS rank"
    rows = stored(_summaries(docs).selectExpr("*", rank), "substring-words")
    long_enough = rows.filter(f"n_words >= {window}")
    leasts = long_enough.groupBy("sha256").agg(F.min("rank").alias("least"))
    ranked = stored(rows.join(leasts, "sha256", "left").selectExpr(
        "*", "coalesce(least < rank, false) AS copy"), "substring-ranked")
    # ids that only have copies need not be searched; a repeated id with another text stays in
    copied = stored(ranked.groupBy("doc_id").agg(
        F.expr("bool_and(copy)").alias("all_copies")).filter("all_copies").select("doc_id"),
        "substring-copies")
    # a list of bounded size goes to the texts; a longer one meets them in a shuffle
    if copied.count() <= _LISTED_IDS:
        copied = F.broadcast(copied)
    firsts = docs.select("doc_id", "text").alias("d").join(
        copied.alias("c"), F.expr("d.doc_id <=> c.doc_id"), "left_anti")
    n_words = ranked.filter("NOT copy").agg(F.sum("n_words")).first()[0] or 0
    expected = 2 * n_words // (window - anchor + 2)
    bits = min(_MOST_BITS, max(_LEAST_BITS, (4 * expected).bit_length()))
    often = _merged(_sketches(firsts, bits, window, anchor), bits)
    suspects = stored(_suspects(firsts, often, bits, window, anchor).withColumn(
        "text_no", F.monotonically_increasing_id()), "substring-suspects")
    windows = suspects.selectExpr("text_no", rank, "explode(windows) AS w").selectExpr(
        "text_no", "rank", "w.at", "w.h1", "w.h2")
    least = windows.groupBy("h1", "h2").agg(F.min("rank").alias("least"))
    repeated = windows.join(least, ["h1", "h2"]).filter("least < rank")
    # bounded by the length of one text
    starts = repeated.groupBy("text_no").agg(F.collect_list("at").alias("starts"))
    partly = _without(suspects.selectExpr("text_no", "sha256", rank, "text").join(
        starts, "text_no"), window)
    # rows of one id may have equal words
    partly = partly.groupBy("sha256", "rank").agg(
        F.first("n_removed").alias("part_removed"), F.first("kept").alias("part_kept"))
    return ranked.join(partly, ["sha256", "rank"], "left").select(
        "doc_id", "n_words", "sha256",
        F.expr("CASE WHEN copy THEN n_words ELSE coalesce(part_removed, 0) END AS n_removed"),
        F.expr("CASE WHEN copy THEN '' ELSE part_kept END AS kept"))


def op5_substrings(spark, sf_dir: str) -> DataFrame:
    """What remains of every document."""
    found = removals(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_words", "n_removed",
        F.expr("CASE WHEN kept IS NULL THEN sha256 ELSE sha2(kept, 256) END AS kept_sha256"))
