"""Language identification as a mixture: expectation-maximisation estimates the share of each
language in a document from n-gram likelihoods, and a penalised likelihood selects which languages
it has at all.

The model is trained here: counts of character sequences of ``ORDERS`` letters, hashed into a fixed
number of classes, over all labelled documents of the learning part. A text is read in lower case,
with everything that is no letter as one blank.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.stages import stored
from .text import pieces

ORDERS, CLASSES = (3,), 1 << 15
FOLDS, HELD_OUT = 5, 0
ROUNDS, TOLERANCE = 30, 1e-3
#: An added language must gain this many times log(n)/2 in log-likelihood. Overlapping n-grams are
#: no independent draws, hence more than the 1 of the usual criterion.
PENALTY = 3.0
_NO_LETTERS = re.compile(r"[\W\d_]+")
#: Characters of a text looked at together; counts of longer texts are summed over stretches.
_STRETCH = 1 << 20
NONE = "und"
#: The model takes 128 KB a language on the driver and in every worker.
MOST_LANGS = 1_000


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _letters(text: str) -> str:
    return f" {_NO_LETTERS.sub(' ', text.lower()).strip()} "


def _classes(plain: str, k: int) -> np.ndarray:
    """The class of every n-gram of the order with number ``k``."""
    order = ORDERS[k]
    points = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = len(points) - order + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    value = np.zeros(n, dtype=np.uint64)
    for i in range(order):
        value = value * np.uint64(0x100000001B3) + points[i:i + n]
    value *= np.uint64(0x9E3779B97F4A7C15)
    return (value >> np.uint64(64 - 15)).astype(np.int64) + k * CLASSES


def ngram_classes(text: str) -> np.ndarray:
    """The class of every n-gram. Classes of one order are a range of their own."""
    plain = _letters(text)
    return np.concatenate([_classes(plain, k) for k in range(len(ORDERS))])


def ngram_counts(text: str) -> np.ndarray:
    """How often each class occurs. Stretches of a long text overlap by what an n-gram needs, so its
    counts are those of the whole."""
    plain, total = _letters(text), np.zeros(len(ORDERS) * CLASSES, dtype=np.int64)
    for k, order in enumerate(ORDERS):
        for start in range(0, max(1, len(plain) - order + 1), _STRETCH):
            total += np.bincount(_classes(plain[start:start + _STRETCH + order - 1], k),
                                 minlength=len(total))
    return total


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages in order and the log-probabilities of the classes, one row a language.

    ``docs`` has ``text`` and ``lang``; rows without one of them are left out. Every task sums its
    counts, so that a row for each language, class and task is shuffled at most. The model is a row of
    fixed size a language and comes to the driver; more than ``MOST_LANGS`` different labels raise an
    error. Without labelled texts there are no languages.
    """
    width = len(ORDERS) * CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in (part for whole in batches for part in pieces(whole)):
            for lang, text in zip(
                    batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                totals.setdefault(lang, np.zeros(width, dtype=np.int64))
                totals[lang] += ngram_counts(text)
        for lang, counts in totals.items():
            touched = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(touched)), pa.array(touched), pa.array(counts[touched])],
                names=["lang", "class", "n"])

    counted = docs.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(
        run, "lang string, class bigint, n bigint")
    summed = stored(counted.groupBy("lang", "class").agg(F.sum("n").alias("n")), "ngrams")
    known = summed.select("lang").distinct().count()
    if known > MOST_LANGS:
        raise ValueError(f"{known} languages are labelled; at most {MOST_LANGS} can be told apart")
    # as many rows as languages times classes at most
    rows = summed.toPandas()
    langs = sorted(rows["lang"].unique())
    counts = np.full((len(langs), width), 0.5)
    at = {lang: i for i, lang in enumerate(langs)}
    counts[rows["lang"].map(at).to_numpy(dtype=np.int64), rows["class"].to_numpy(dtype=np.int64)] += (
        rows["n"].to_numpy())
    logs = np.log(counts).reshape(len(langs), len(ORDERS), CLASSES)
    logs -= np.log(counts.reshape(logs.shape).sum(axis=2, keepdims=True))
    return langs, logs.reshape(len(langs), width).astype(np.float32)


def _mixture(likely: np.ndarray, weight: np.ndarray, first: int = 0,
             enough: float = -np.inf) -> tuple[np.ndarray, float]:
    """Shares of the rows of ``likely`` and the log-likelihood, by expectation-maximisation.

    The greatest factor by which a round changes a share bounds what all further rounds can gain;
    it ends when they cannot lift the log-likelihood above ``enough``, or when no share moves."""
    n = len(likely)
    shares = np.full(n, 0.2 / max(1, n - 1), dtype=np.float32)
    shares[first] = 0.8
    weight = (weight / weight.sum()).astype(np.float32)
    for k in range(ROUNDS):
        whole = shares @ likely
        factor = likely @ (weight / whole)
        if k % 3 == 1 and float(weight @ np.log(whole)) + np.log(factor.max()) <= enough:
            break
        before, shares = shares, shares * factor
        if np.abs(shares - before).max() < TOLERANCE:
            break
    shares = shares / shares.sum()
    return shares, float(weight @ np.log(shares @ likely))


def proportions(text: str, logs: np.ndarray) -> np.ndarray:
    """The share of each language. Languages join in the order of their shares in the mixture of
    all, while each raises the penalised likelihood; where not even all together gain the price of
    one, the best single language is taken at once."""
    if len(text) > _STRETCH:
        counts = ngram_counts(text)
        classes = np.flatnonzero(counts)
        weight = counts[classes].astype(np.float64)
    else:
        classes = ngram_classes(text)
        weight = np.ones(len(classes))
    total = weight.sum()
    own = logs[:, classes]
    own = own - own.max(axis=0)
    likely = np.exp(own)
    single = (own @ weight.astype(np.float32)) / total
    first = int(single.argmax())
    result = np.zeros(len(logs))
    result[first] = 1.0
    if len(logs) == 1:
        return result
    price = PENALTY * 0.5 * np.log(max(total, 2.0)) / total
    shares, value = _mixture(likely, weight, first, float(single[first]) + price)
    if value - single[first] <= price:
        return result
    chosen, best = [first], float(single[first])
    for k in sorted(set(range(len(logs))) - {first}, key=lambda k: (-shares[k], k)):
        found, value = _mixture(likely[[*chosen, k]], weight)
        if value - best <= price:
            break
        chosen, best = [*chosen, k], value
        result[:] = 0.0
        result[chosen] = found
    return result


def languages(docs: DataFrame, langs: list[str], logs: np.ndarray) -> DataFrame:
    """``doc_id, lang_pred, score, shares`` for every row: the language with the greatest share (the
    first of equals), this share, and all shares above zero. ``und``, 0 and none if the text is null
    or has no letter, or if nothing was learnt."""
    shared = docs.sparkSession.sparkContext.broadcast((langs, logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logs = shared.value
        for batch in (part for whole in batches for part in pieces(whole)):
            names, scores, all_shares = [], [], []
            for text in batch.column("text").to_pylist():
                if not langs or not text or not has_letter(text):
                    names.append(NONE)
                    scores.append(0.0)
                    all_shares.append({})
                    continue
                shares = proportions(text, logs)
                best = int(shares.argmax())
                names.append(langs[best])
                scores.append(min(1.0, float(shares[best])))
                all_shares.append({langs[k]: float(shares[k]) for k in np.flatnonzero(shares)})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64()),
                 pa.array([list(s.items()) for s in all_shares],
                          pa.map_(pa.string(), pa.float64()))],
                names=["doc_id", "lang_pred", "score", "shares"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double, shares map<string, double>")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is left out of learning; a null id is not."""
    return F.coalesce(
        F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def op6_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    langs, logs = train(docs.filter(~held_out()))
    return languages(docs, langs, logs).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
