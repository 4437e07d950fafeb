"""Text quality learnt from trusted documents and unlabelled ones.

Only documents known to be good are taken as labelled; all others are a mixture of good and bad in
unknown shares. With a share ``pi`` of good documents, the risk of a classifier ``g`` over everything is

    R = pi E_good[loss(g)] + max(0, E_all[loss(-g)] - pi E_good[loss(-g)]),

the risk on bad documents being what is left of the whole when the good part is taken away. That
part cannot be negative, and where its estimate would be, the classifier has begun to fit the trusted
documents themselves; the maximum stops it there.

With the squared loss the risk depends on the documents through first and second moments of their
features alone. Every text of the learning part therefore counts, in one pass of partial sums, and the minimum is found exactly:
``max(0, x)`` is the greatest ``mu x`` with ``mu`` from 0 to 1, for each ``mu`` the minimum has a
closed form, and bisection finds the ``mu`` at which the negative part is nil.

The share of good documents is estimated as well, from a first classifier on one half of the trusted documents:
above any threshold lies a share of all texts that is at least ``pi`` times the share of the other
half; the threshold with the least upper bound gives the estimate.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.stages import stored
from .language import held_out
from .sums import summed, symmetric, upper
from .text import pieces

GOOD, THRESHOLD = 1, 0.3
#: Trusted documents to fit on, the first by a hash of their ids: 100,000 ids, which are broadcast.
MOST_TRUSTED = 100_000
#: Weight of the squared coefficients: a part of its own, and one that falls with the trusted rows.
RIDGE, RIDGE_ROWS = 0.1, 30.0
#: Standardised features are cut off here, so that one strange text moves the moments little.
CUT = 6.0
#: First classifier: the share it assumes; the estimate takes the place of it. Chance of error and
#: slack of the estimate's bound, and its thresholds from -RANGE to RANGE.
FIRST_SHARE, CHANCE, SLACK, BINS, RANGE = 0.5, 0.1, 0.01, 4_096, 3.0
#: Bytes looked at together; longer texts are taken in stretches cut at a blank.
_STRETCH = 1 << 20


def _classes() -> np.ndarray:
    """The class of each byte of UTF-8."""
    kinds = ["\n", " \t\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "0123456789", ".,;:", "!?", "#*$%&|<>=+~^_\\/@{}[]`", "'\"()-"]
    of = np.full(256, len(kinds), dtype=np.uint8)  # other control characters
    for k, chars in enumerate(kinds):
        of[np.frombuffer(chars.encode(), dtype=np.uint8)] = k
    of[128:192], of[192:] = len(kinds) + 1, len(kinds) + 2
    return of


_CLASS = _classes()
_KINDS = int(_CLASS.max()) + 1
WIDTH = _KINDS * _KINDS + 11


def features(text: str | None) -> np.ndarray:
    """Shares of all pairs of neighbouring byte classes, as square roots, and measures of length and
    repetition. A null text is an empty one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    pairs = np.zeros(_KINDS * _KINDS, dtype=np.int64)
    last, n_words, different, again, before = 0, 0, set(), 0, None
    start = 0
    while start < len(raw):
        end = raw.find(b" ", start + _STRETCH)
        part = raw[start:end + 1] if end >= 0 else raw[start:]
        start += len(part)
        classes = _CLASS[np.frombuffer(part, dtype=np.uint8)].astype(np.int64)
        follows = np.concatenate(([last], classes[:-1])) * _KINDS + classes
        pairs += np.bincount(follows, minlength=len(pairs))
        last = int(classes[-1])
        words = part.split()
        if words:
            again += sum(map(operator.eq, words, words[1:])) + (words[0] == before)
            before = words[-1]
        n_words += len(words)
        different.update(words)
    pairs[last * _KINDS] += 1
    lines = [line for line in raw.split(b"\n") if line.strip()]
    per_word, per_line = max(n_words, 1), max(len(lines), 1)
    return np.concatenate((np.sqrt(pairs / (len(raw) + 1)), [
        np.log1p(len(raw)) / 10, np.log1p(n_words) / 10, min(len(raw) / per_word, 40) / 10,
        len(different) / per_word, again / per_word, np.sqrt(again / per_word),
        len(set(lines)) / per_line, np.log1p(len(lines)) / 5, min(n_words / per_line, 100) / 50,
        float(n_words == 0), float(n_words < 20)])).astype(np.float32)


def with_features(docs: DataFrame, learning: Column) -> DataFrame:
    """``doc_id, learning, features`` for every row, the features as bytes. Read once; all that
    follows reads these rows, a fraction of the texts in size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces(whole)):
            found = [features(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("learning"), pa.array(found, pa.binary())],
                names=["doc_id", "learning", "features"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", learning.alias("learning"), "text").mapInArrow(
        run, f"doc_id {id_type}, learning boolean, features binary")


def trusted_ids(labels: DataFrame, most: int = MOST_TRUSTED) -> DataFrame:
    """``doc_id, half`` (0 or 1) of the ids whose every label says good, ``most`` of them at most.
    Null ids and labels count as none."""
    good = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("low"), F.max("quality").alias("high")).filter(
        f"low = {GOOD} AND high = {GOOD}")
    return good.select("doc_id", F.xxhash64("doc_id").alias("mix")).orderBy("mix", "doc_id").limit(
        most).select("doc_id", F.expr("cast(pmod(mix, 2) AS int)").alias("half"))


# The risk

@dataclass(frozen=True)
class Moments:
    """Mean of the products and of the values of rows of features that begin with a 1."""

    products: np.ndarray
    n: float

    @property
    def mean(self) -> np.ndarray:
        return self.products[0]


def _moments(products: np.ndarray) -> Moments:
    return Moments(products / max(products[0, 0], 1.0), float(products[0, 0]))


def negative_part(w: np.ndarray, share: float, good: Moments, every: Moments) -> float:
    """The risk on bad documents: that on all as bad ones, less that of the good ones among them."""
    as_bad = lambda m: (1 + 2 * w @ m.mean + w @ m.products @ w) / 4
    return float(as_bad(every) - share * as_bad(good))


def risk(w: np.ndarray, share: float, good: Moments, every: Moments, ridge: float) -> float:
    """The non-negative risk, with the weight of the coefficients (the constant is free)."""
    as_good = (1 - 2 * w @ good.mean + w @ good.products @ w) / 4
    return float(share * as_good + max(0.0, negative_part(w, share, good, every))
                 + ridge / 4 * (w[1:] @ w[1:]))


def minimise(share: float, good: Moments, every: Moments, ridge: float) -> np.ndarray:
    """The coefficients of the least non-negative risk."""
    weight = np.diag([1e-9] + [ridge] * (len(good.mean) - 1))

    def at(mu: float) -> np.ndarray:
        matrix = share * (1 - mu) * good.products + mu * every.products + weight
        return np.linalg.solve(matrix, share * (1 + mu) * good.mean - mu * every.mean)

    w = at(1.0)
    if negative_part(w, share, good, every) >= 0:
        return w
    low, high = 0.0, 1.0
    for _ in range(60):
        mu = (low + high) / 2
        low, high = (low, mu) if negative_part(at(mu), share, good, every) < 0 else (mu, high)
    return at(low)


def share_of_good(every: np.ndarray, good: np.ndarray) -> float:
    """The share of good documents from counts of scores, bins rising: the ratio of the shares
    above the threshold where the upper bound of that ratio is least."""
    n_every, n_good = every.sum(), good.sum()
    above_every = np.cumsum(every[::-1])[::-1] / n_every
    above_good = np.cumsum(good[::-1])[::-1] / n_good
    doubt = np.log(4 / CHANCE) / 2
    doubt = np.sqrt(doubt / n_every) + np.sqrt(doubt / n_good)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = above_every / above_good
        bound = np.where(above_good > 0, ratio + (1 + SLACK) * doubt / above_good, np.inf)
    return float(np.clip(ratio[int(bound.argmin())], 0.01, 0.99))


# The operator

@dataclass(frozen=True)
class Classifier:
    """How features are standardised, the coefficients, and the estimated share of good texts."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    share: float

    def values(self, raw: np.ndarray) -> np.ndarray:
        return standardised(raw, self.mean, self.scale) @ self.weights


def standardised(raw: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features less their mean in units of their spread, cut off, after a constant 1."""
    return np.column_stack((np.ones(len(raw)), np.clip((raw - mean) / scale, -CUT, CUT)))


def _raw(batch: pa.RecordBatch) -> np.ndarray:
    found = batch.column("features").to_pylist()
    return np.frombuffer(b"".join(found), dtype=np.float32).reshape(len(found), WIDTH).astype(float)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (part for whole in batches for part in pieces(whole, 4 << 20))


def fit(rows: DataFrame, trusted: DataFrame) -> Classifier | None:
    """The classifier for ``rows`` of :func:`with_features`, from those of the learning part, and the
    :func:`trusted_ids` among them. None if there is no trusted row."""
    # MOST_TRUSTED ids at most
    learning = rows.filter("learning").join(F.broadcast(trusted), "doc_id", "left").select(
        "features", F.coalesce("half", F.lit(-1)).alias("half"))

    def spread(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        out = {"n": np.zeros(1), "sum": np.zeros(WIDTH), "square": np.zeros(WIDTH)}
        for batch in _parts(batches):
            x = _raw(batch)
            out["n"] += len(x)
            out["sum"] += x.sum(axis=0)
            out["square"] += (x * x).sum(axis=0)
        return out

    found = summed(learning, spread, {"n": 1, "sum": WIDTH, "square": WIDTH})
    n = max(found["n"][0], 1.0)
    mean = found["sum"] / n
    scale = np.sqrt(np.maximum(found["square"] / n - mean ** 2, 0.0)) + 1e-3

    def moments(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        totals = {k: np.zeros((WIDTH + 1, WIDTH + 1)) for k in ("every", "0", "1")}
        for batch in _parts(batches):
            x, half = standardised(_raw(batch), mean, scale), batch.column("half").to_numpy()
            totals["every"] += x.T @ x
            for k in (0, 1):
                own = x[half == k]
                totals[str(k)] += own.T @ own
        return {k: upper(v) for k, v in totals.items()}

    size = (WIDTH + 1) * (WIDTH + 2) // 2
    sums = {k: symmetric(v, WIDTH + 1) for k, v in summed(
        learning, moments, {k: size for k in ("every", "0", "1")}).items()}
    every, both = _moments(sums["every"]), _moments(sums["0"] + sums["1"])
    if not both.n:
        return None
    halves = [_moments(sums[k]) for k in ("0", "1")]
    # with too few trusted rows for halves, all serve for both
    split = all(m.n for m in halves)
    ridge = lambda m: RIDGE + RIDGE_ROWS / m.n
    early = halves[0] if split else both
    first = Classifier(mean, scale, minimise(FIRST_SHARE, early, every, ridge(early)), FIRST_SHARE)

    def scores(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        out = {"every": np.zeros(BINS), "good": np.zeros(BINS)}
        for batch in _parts(batches):
            half = batch.column("half").to_numpy()
            value = np.clip((first.values(_raw(batch)) + RANGE) / (2 * RANGE), 0.0, 1.0)
            bins = np.minimum((value * BINS).astype(np.int64), BINS - 1)
            out["every"] += np.bincount(bins, minlength=BINS)
            out["good"] += np.bincount(bins[half == 1 if split else half >= 0], minlength=BINS)
        return out

    counts = summed(learning, scores, {"every": BINS, "good": BINS})
    share = share_of_good(counts["every"], counts["good"])
    return Classifier(mean, scale, minimise(share, both, every, ridge(both)), share)


def score(rows: DataFrame, model: Classifier | None) -> DataFrame:
    """``doc_id, learning, score`` for all rows of :func:`with_features`: the estimated chance that a
    text is good, from 0 to 1. 0.5 for all if nothing could be learnt."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in _parts(batches):
            raw = _raw(batch)
            # the least squared loss is met by twice the chance less one
            value = np.full(len(raw), 0.5) if model is None else np.clip(
                (1 + model.values(raw)) / 2, 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("learning"), pa.array(value)],
                names=["doc_id", "learning", "score"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, learning boolean, score double")


def classify(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Classifier | None]:
    """``doc_id, learning, score`` for every row of ``docs``, and the classifier.

    Labels are read only for ids of the learning part, and only those that say good. Null and empty
    texts have a score like any other. Repeated rows count as often as they are there; rows with
    a null id belong to the learning part and are never trusted; other columns play no part."""
    rows = stored(with_features(docs, ~held_out()), "text-features")
    model = fit(rows, stored(trusted_ids(labels.filter(~held_out())), "trusted"))
    return score(rows, model), model


def op12_quality_pu(spark, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    scored, _ = classify(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", (~F.col("learning")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
