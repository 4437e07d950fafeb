"""Document fingerprints by randomised edit embedding.

All texts take the same random walk: at step j the character under the reader is written out, and
a random bit of (j, character) says whether the reader moves on. Two texts with few edits between
them fall into step again soon after each edit, so their edit distance becomes a Hamming distance
between what the walks write.

A fingerprint samples that output: ``SAMPLES`` fixed steps of every octave [2**o, 2**(o+1)) of
steps, from the last the walk reaches down to the first step (octave -1), one hexadecimal digit (a
hash of the character) a sample. The octaves make texts of different lengths comparable, and weigh every part
of a text by its length. Likeness is the weighted share of equal samples.

Near pairs are found by bit-sampled bands: equality on a few sampled bits of one octave makes a
candidate, and the likeness of the whole fingerprints verifies it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans.stages import stored
from .text import pieces

SAMPLES, SEED = 64, 7
#: Near pairs are at least this alike. At this likeness 95 % of them share a band if samples are
#: independent: 1 - (1 - 0.7 ** 6) ** 24; above it more.
LIKE = 0.7
#: Bands: so many of the last octaves, bands in each, samples in a band.
BAND_OCTAVES, BANDS, BAND_SAMPLES = 2, 12, 6
#: Octave -1 is step 0 alone.
_FIRST_OCTAVE, _LAST_OCTAVE = -1, 40
#: Lines of a fingerprint at most: all octaves.
OCTAVES = _LAST_OCTAVE - _FIRST_OCTAVE + 1
#: Octaves before have too few steps for bands.
_FIRST_BAND_OCTAVE = 3
_PERIOD, _CLASSES = 1 << 14, 1 << 8
#: Texts walk side by side while so many are left; longer ones then go on one by one.
_TOGETHER = 128
#: Characters taken at once; a longer text is taken alone.
_BATCH_CHARS = 8 << 20
_DIGITS = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)

_random = np.random.Generator(np.random.PCG64(SEED))
#: Whether the reader moves on, by step (repeated after a period) and class of character.
_MOVES = _random.integers(0, 2, size=(_PERIOD, _CLASSES), dtype=np.uint8)
_DIGIT_OF = _random.integers(0, 16, size=_CLASSES, dtype=np.uint8)
#: The sampled steps of each octave, as shares of it.
_SHARES = np.sort(_random.random((_LAST_OCTAVE + 1, SAMPLES)), axis=1)
_BAND_OF = np.array([[_random.choice(SAMPLES, BAND_SAMPLES, replace=False)
                      for _ in range(BANDS)] for _ in range(BAND_OCTAVES)])


def _classes(text: str) -> np.ndarray:
    """A class from 0 to 255 for each code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return ((points * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)


def _octave(steps: int) -> int:
    return max(_FIRST_OCTAVE, steps.bit_length() - 1)


def _walks(texts: list[str]) -> list[np.ndarray]:
    """For each text the step at which each character was last read. What the walk writes at step
    j is the first character whose last step is j or later."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    chars = np.concatenate([_classes(t) for t in texts])
    last = np.empty(len(chars), dtype=np.int32 if len(chars) < 1 << 29 else np.int64)
    order = np.argsort(-sizes, kind="stable")[:int((sizes > 0).sum())]
    at, end, step = starts[order], (starts + sizes)[order], 0
    while len(at) > _TOGETHER:
        # written again and again until the reader moves on, so the last step stays
        last[at] = step
        at = at + _MOVES[step % _PERIOD][chars[at]]
        step += 1
        go = at < end
        if not go.all():
            at, end = at[go], end[go]
    rows = [row.tobytes() for row in _MOVES] if len(at) else []
    for a, e in zip(at.tolist(), end.tolist()):
        _walk_alone(chars, last, a, e, step, rows)
    return [last[s:s + n] for s, n in zip(starts, sizes)]


def _walk_alone(chars, last, at, end, step, rows) -> None:
    block = 1 << 16
    while at < end:
        upto = min(end, at + block)
        own, steps = chars[at:upto].tobytes(), []
        for c in own:
            while not rows[step % _PERIOD][c]:
                step += 1
            steps.append(step)
            step += 1
        last[at:upto] = steps
        at = upto


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text: the octave of its last step in two digits, then the samples of
    its octaves, the newest first; ``-`` marks a step behind the end. An empty text has only
    ``-``."""
    if not texts:
        return []
    found = []
    for text, last in zip(texts, _walks(texts)):
        chars = _classes(text)
        steps = int(last[-1]) + 1 if len(last) else 0
        top = _octave(steps)
        octaves = np.arange(top, max(_FIRST_OCTAVE - 1, top - OCTAVES), -1)
        wanted = (2.0 ** octaves[:, None] * (1 + _SHARES[octaves])).astype(np.int64)
        place = np.searchsorted(last, wanted)
        there = place < len(last)
        digits = np.full(wanted.shape, ord("-"), dtype=np.uint8)
        digits[there] = _DIGITS[_DIGIT_OF[chars[place[there]]]]
        found.append(f"{top:02d}" + digits.tobytes().decode())
    return found


def _parts(fingerprint: str) -> tuple[int, np.ndarray]:
    return int(fingerprint[:2]), np.frombuffer(
        fingerprint[2:].encode(), dtype=np.uint8).reshape(-1, SAMPLES)


def likeness(a: str | None, b: str | None) -> float:
    """Share of equal samples, octaves weighed by their length; steps behind both ends do not count,
    and those behind one end differ. Equal fingerprints give 1, a missing one 0."""
    if a is None or b is None:
        return 0.0
    if a == b:
        return 1.0
    (top, x), (other, y) = _parts(a), _parts(b)
    if top < other:
        (top, x), (other, y) = (other, y), (top, x)
    # the first lines are behind the end of the other text
    gap = top - other
    n = max(0, min(len(x) - gap, len(y)))
    weight = 2.0 ** (top - np.arange(len(x)))
    mine, theirs = x[gap:gap + n], y[:n]
    counted = (mine != 45) | (theirs != 45)
    equal = (counted & (mine == theirs)).sum(axis=1) @ weight[gap:gap + n]
    total = counted.sum(axis=1) @ weight[gap:gap + n] + (x[:gap] != 45).sum(axis=1) @ weight[:gap]
    return float(equal / total) if total else 0.0


def bands(fingerprint: str | None) -> list[str]:
    """The band keys: octave, band and its sampled digits, of the newest octaves that are at least
    half full. Equal texts share all of them; an empty text has none."""
    if fingerprint is None:
        return []
    top, parts = _parts(fingerprint)
    keys, used = [], 0
    for k, line in enumerate(parts):
        if used == BAND_OCTAVES or top - k < _FIRST_BAND_OCTAVE:
            break
        if 2 * (line != 45).sum() < SAMPLES:
            continue
        for n, chosen in enumerate(_BAND_OF[(top - k) % BAND_OCTAVES]):
            keys.append(f"{top - k}:{n}:{line[chosen].tobytes().decode()}")
        used += 1
    return keys


def _in_blocks(docs: DataFrame) -> DataFrame:
    """``block, kind, doc_id, text``, each block in one partition and in order: its documents (kind
    0) by doc_id and text, then the first of the next block (kind 1), then rows without an id (2).

    Blocks are ranges of doc_id, four for each shuffle partition, cut at ids that exist, so that
    each block's first id is known. Only these few ids are sent to the tasks.
    """
    ids = docs.select("doc_id", "text")
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = ids.agg(F.min("doc_id").alias("least"), F.percentile_approx(
        "doc_id", [i / n for i in range(1, n)], 100 * n).alias("cuts")).first()
    heads = np.array(sorted({found.least, *found.cuts} if found.cuts else []), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces(whole)):
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            values = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            block = np.searchsorted(heads, values, side="right") - 1
            block[~known] = np.arange((~known).sum()) % max(1, len(heads))
            head = np.flatnonzero(known & (heads[block] == values) if len(heads) else known)
            rows = np.concatenate((np.arange(len(values)), head))
            where = np.concatenate((block, (block[head] - 1) % max(1, len(heads))))
            kind = np.concatenate((np.where(known, 0, 2), np.ones(len(head), dtype=np.int64)))
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int64()), pa.array(kind, pa.int64()),
                 batch.column("doc_id").take(taken), batch.column("text").take(taken)],
                names=["block", "kind", "doc_id", "text"])

    schema = "block bigint, kind bigint, doc_id bigint, text string"
    return ids.withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(
        run, schema).repartition("block").sortWithinPartitions("block", "kind", "doc_id", "text")


def edited(text: str, after: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of ``after``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + after[:cut]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    edited_found, next_found`` for every row: its likeness to its edited text and to the next
    document (ascending doc_id, then text; after the last the first), and whether banding and
    verification would report these pairs.

    A null text is empty. A row without an id has no next document: nothing replaces its last
    quarter, and ``near_next`` is 0. Rows of one id follow each other by text. The documents cross
    the network once.
    """
    def describe(rows: list[tuple]) -> Iterator[dict]:
        # the last row only serves as the next one
        texts = [r[3] for r in rows]
        changed = []
        for k, (block, kind, _, text) in enumerate(rows[:-1]):
            after = texts[k + 1] if kind == 0 and rows[k + 1][0] == block else ""
            changed.append(edited(text, after))
        prints = fingerprints(texts + changed)
        own, other = prints[:len(rows)], prints[len(rows):]
        for k, (block, kind, doc_id, text) in enumerate(rows[:-1]):
            if kind == 1:
                continue
            after = own[k + 1] if kind == 0 and rows[k + 1][0] == block else None
            near, next_ = likeness(own[k], other[k]), likeness(own[k], after)
            yield {
                "doc_id": doc_id, "n_chars": len(text),
                "edited_sha256": hashlib.sha256(
                    changed[k].encode("utf-8", "surrogatepass")).hexdigest(),
                "fingerprint": own[k], "edited_fingerprint": other[k],
                "near_edited": near, "near_next": next_,
                "edited_found": near >= LIKE and share_band(own[k], other[k]),
                "next_found": next_ >= LIKE and share_band(own[k], after),
            }

    names = {
        "doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string",
        "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double",
        "near_next": "double", "edited_found": "boolean", "next_found": "boolean"}
    types = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(),
             "boolean": pa.bool_()}
    schema = pa.schema([(name, types[kind]) for name, kind in names.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        chars = 0
        for batch in (part for whole in batches for part in pieces(whole)):
            columns = [batch.column(c).to_pylist() for c in ("block", "kind", "doc_id", "text")]
            for block, kind, doc_id, text in zip(*columns):
                waiting.append((block, kind, doc_id, text or ""))
                chars += len(text or "")
                if chars > _BATCH_CHARS:
                    yield pa.RecordBatch.from_pylist(list(describe(waiting)), schema)
                    waiting, chars = waiting[-1:], len(waiting[-1][3])
        if waiting:
            waiting.append((-1, 1, None, ""))
            yield pa.RecordBatch.from_pylist(list(describe(waiting)), schema)

    return _in_blocks(docs).mapInArrow(run, ", ".join(f"{k} {v}" for k, v in names.items()))


def share_band(a: str | None, b: str | None) -> bool:
    return not set(bands(a)).isdisjoint(bands(b))


def near_pairs(prints: DataFrame, like: float = LIKE) -> DataFrame:
    """``a, b, likeness`` with a < b for pairs of different ``fingerprint`` strings that share a band
    and are alike by ``like`` or more; which documents have them is the caller's table.

    Equal fingerprints are taken once, so that copies are no pairs. Empty texts have no bands.
    """
    once = stored(prints.select("fingerprint").filter("fingerprint IS NOT NULL").distinct(), "prints")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(p, key) for p in batch.column("fingerprint").to_pylist() for key in bands(p)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)],
                names=["fingerprint", "band"])

    banded = once.mapInArrow(keys, "fingerprint string, band string")
    pairs = banded.selectExpr("band", "fingerprint AS a").join(
        banded.selectExpr("band", "fingerprint AS b"), "band").filter("a < b").select(
        "a", "b").distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"),
                 pa.array([likeness(x, y) for x, y in zip(a, b)], pa.float64())],
                names=["a", "b", "likeness"])

    return pairs.mapInArrow(verify, "a string, b string, likeness double").filter(
        F.col("likeness") >= like)


def op3_editprint(spark, sf_dir: str) -> DataFrame:
    """Fingerprints and likeness of every document."""
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
