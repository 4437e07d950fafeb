"""Whitening of embeddings by their leading principal components.

Entries become whole numbers, so that equal vectors can be told exactly: every different vector is
fitted once, however many copies it has. Their number and sums come first, exact; a second pass adds
up the covariance of the centred vectors, a partial sum a task. What reaches the driver has the size
of the covariance, whatever the number of vectors. There it is made tridiagonal by Householder
reflections, Sturm counts bisect its leading eigenvalues, and inverse iteration, made orthogonal
again within clusters, gives their vectors. All rows are then projected with the broadcast
components, and the covariance of the projected fit list is compared with the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..plans.stages import stored
from .sums import summed, symmetric, upper
from .text import pieces

COMPONENTS = 16
#: Fixed values of the whole-number form: floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: The most dimensions: the covariance then takes 32 MB on the driver.
MAX_DIMENSIONS = 2_048
#: Components whose eigenvalue is below this share of the greatest are left out: beside it, double
#: precision does not tell them from nothing well enough to divide by.
LEAST_SHARE = 1e-10
_LONG = (1 << 63) - 1
_EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """What the fit found; ``components`` has one unit vector a row, by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0


# Vectors as whole numbers

def whole_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the usable rows of a list column, and their vectors as whole numbers. Null and empty
    vectors, and those with a null, NaN or infinite entry, are not usable."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = column.flatten()
    # a null entry reads as NaN
    entries = pc.cast(values, pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(lengths)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(entries))))
    usable = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    scaled = np.floor(np.where(np.isfinite(entries), entries, 0.0) * SCALE)
    kept = np.repeat(usable, lengths)
    if (np.abs(scaled[kept]) >= 2.0 ** 62).any():
        raise OverflowError("an entry of a vector is too large for a 64-bit whole number")
    scaled[~kept] = 0.0
    whole = scaled.astype(np.int64) + SHIFT
    return np.flatnonzero(usable), [whole[e - n:e] for e, n in zip(
        ends[usable].tolist(), lengths[usable].tolist())]


def fit_list(vectors: DataFrame) -> DataFrame:
    """``x``, every different usable vector of the column ``vector`` once, as bytes of longs. Copies
    are combined in the tasks that read them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces(whole)):
            _, found = whole_vectors(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes() for x in found], pa.binary())], names=["x"])

    return vectors.select("vector").mapInArrow(run, "x binary").distinct()


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in (part for whole in batches for part in pieces(whole, 4 << 20)):
        found = batch.column("x").to_pylist()
        yield np.frombuffer(b"".join(found), dtype=np.int64).reshape(len(found), width)


def offsets(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n x - S``, exact: 64-bit where that holds it, else whole numbers of any length."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if n * most + max(map(abs, sums)) < _LONG:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``x - S/n``, rounded once."""
    return (offsets(x, n, sums) / n).astype(np.float64)


def deviations(offset: np.ndarray) -> list[int]:
    """The exact sums of squares of the rows; an error if one is no long."""
    most = max((abs(int(v)) for v in (offset.max(initial=0), offset.min(initial=0))), default=0)
    if offset.shape[1] * most * most > _LONG:
        found = (offset.astype(object) ** 2).sum(axis=1).tolist()
        if max(found, default=0) > _LONG:
            raise OverflowError("a deviation is too large for a 64-bit whole number")
        return found
    return (offset.astype(np.int64) ** 2).sum(axis=1).tolist()


# Sums over the fit list

def _totals(fit: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    """Number and exact sums of the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for x in _matrices(batches, width):
            n += len(x)
            most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
            own = x if most * len(x) < _LONG else x.astype(object)
            sums = [a + int(b) for a, b in zip(sums, own.sum(axis=0))]
        rows = [n, *sums]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.decimal128(38, 0))],
            names=["place", "value"])

    parts = fit.mapInArrow(run, "place int, value decimal(38, 0)")
    # one row a dimension
    found = dict(map(tuple, parts.groupBy("place").agg(F.sum("value")).collect()))
    if not found:
        return 0, (0,) * width
    return int(found[0]), tuple(int(found[k + 1]) for k in range(width))


def _products(fit: DataFrame, width: int, columns: int, form) -> np.ndarray:
    """The sum of ``f f'`` over the fit list, ``f`` being ``form(x)``."""

    def fold(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        total = np.zeros((columns, columns))
        for x in _matrices(batches, width):
            f = form(x)
            total += f.T @ f
        return {"products": upper(total)}

    size = columns * (columns + 1) // 2
    return symmetric(summed(fit, fold, {"products": size})["products"], columns)


# Leading eigenvalues and vectors of a symmetric matrix

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, second diagonal, and the unit vectors of the Householder reflections."""
    a, mirrors = matrix.astype(float).copy(), []
    for k in range(len(a) - 2):
        v = a[k + 1:, k].copy()
        length = float(np.linalg.norm(v))
        v[0] += length if v[0] >= 0 else -length
        size = float(np.linalg.norm(v))
        if size > 0:
            v /= size
            a[k + 1, k] = a[k, k + 1] = float(a[k + 1, k] - 2 * v[0] * (v @ a[k + 1:, k]))
            p = a[k + 1:, k + 1:] @ v
            w = p - (v @ p) * v
            a[k + 1:, k + 1:] -= 2 * (np.outer(v, w) + np.outer(w, v))
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def counts_below(diagonal: np.ndarray, second: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are below each of ``at``."""
    tiny = _EPS * max(1e-300, float(np.abs(diagonal).max(initial=0) + np.abs(second).max(initial=0)))
    below, q = np.zeros(len(at), dtype=np.int64), np.ones(len(at))
    square = np.concatenate(([0.0], second ** 2))
    for a, b in zip(diagonal.tolist(), square.tolist()):
        q = a - at - b / q
        q = np.where(np.abs(q) < tiny * _EPS, -tiny * _EPS, q)
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, second: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` greatest eigenvalues, falling, by bisection down to neighbouring numbers."""
    around = np.abs(np.concatenate(([0.0], second))) + np.abs(np.concatenate((second, [0.0])))
    low = np.full(k, float((diagonal - around).min()))
    high = np.full(k, float((diagonal + around).max()))
    wide = _EPS * max(abs(low[0]), abs(high[0]), 1e-300)
    low, high = low - wide, high + wide
    wanted = len(diagonal) - np.arange(k)  # so many are below anything above it
    while True:
        middle = low + (high - low) / 2
        if not ((low < middle) & (middle < high)).any():
            return high
        enough = counts_below(diagonal, second, middle) >= wanted
        low, high = np.where(enough, low, middle), np.where(enough, middle, high)


def _solve(diagonal: np.ndarray, second: np.ndarray, value: float, right: np.ndarray,
           tiny: float) -> np.ndarray:
    """``(T - value) z = right`` by elimination with row exchanges."""
    n = len(diagonal)
    u, v, w = (diagonal - value).tolist(), [*second.tolist(), 0.0], [0.0] * n
    low, z = second.tolist(), right.tolist()
    for i in range(n - 1):
        if abs(u[i]) >= abs(low[i]):
            factor = low[i] / (u[i] or tiny)
            u[i + 1] -= factor * v[i]
        else:
            factor = u[i] / low[i]
            u[i], v[i], u[i + 1], below = low[i], u[i + 1], v[i] - factor * u[i + 1], v[i + 1]
            w[i], v[i + 1] = below, -factor * below
            z[i], z[i + 1] = z[i + 1], z[i]
        z[i + 1] -= factor * z[i]
    for i in range(n - 1, -1, -1):
        total = z[i] - (v[i] * z[i + 1] if i + 1 < n else 0.0) - (w[i] * z[i + 2] if i + 2 < n else 0.0)
        pivot = u[i] if abs(u[i]) > tiny else tiny
        z[i] = total / pivot
        if abs(z[i]) > 1e200:  # scale what is there; only the direction counts
            z = [x * 1e-200 for x in z]
    return np.array(z)


def eigenvectors(diagonal: np.ndarray, second: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit vector a row for the falling ``values``, by inverse iteration. Vectors of values close
    to each other are kept orthogonal to those before them."""
    n = len(diagonal)
    norm = float(np.abs(diagonal).max(initial=0) + 2 * np.abs(second).max(initial=0)) or 1.0
    random, found, first, before = np.random.Generator(np.random.PCG64(11)), [], 0, np.inf
    for k, value in enumerate(values.tolist()):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k
        # equal values are solved a little apart, or their systems would be the same
        before = value = min(value, before - 10 * _EPS * norm)
        z = random.standard_normal(n)
        for _ in range(6):
            z = _solve(diagonal, second, value, z / np.linalg.norm(z), _EPS * norm)
            z /= np.abs(z).max()
            for _ in range(2):
                for other in found[first:k]:
                    z = z - (other @ z) * other
        found.append(z / np.linalg.norm(z))
    return np.array(found).reshape(len(found), n)


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, at most ``k``, and their unit eigenvectors, one a row."""
    k = min(k, len(matrix))
    scale = float(np.trace(matrix))
    if k == 0 or not scale > 0:
        return np.empty(0), np.empty((0, len(matrix)))
    diagonal, second, mirrors = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, second, k)
    vectors = eigenvectors(diagonal, second, values)
    for place, v in reversed(list(enumerate(mirrors))):
        part = vectors[:, place + 1:]
        part -= 2 * np.outer(part @ v, v)
    return values * scale, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


# The operator

def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of the different usable vectors of the column ``vector``.

    Fewer components come where the vectors have fewer dimensions or span fewer (``LEAST_SHARE``);
    none where they do not vary or there are none. Vectors of different lengths raise an error.
    """
    listed = stored(fit_list(vectors), "fit-list")
    size = listed.select(F.octet_length("x").alias("b")).agg(F.min("b"), F.max("b")).first()
    if size[0] is None:
        return Whitening(0, (), np.empty((0, 0)), np.empty(0), 0.0)
    if size[0] != size[1]:
        raise ValueError(f"vectors have from {size[0] // 8} to {size[1] // 8} entries")
    width = size[0] // 8
    if width > MAX_DIMENSIONS:
        raise ValueError(f"vectors have {width} entries; at most {MAX_DIMENSIONS} can be whitened")
    n, sums = _totals(listed, width)
    covariance = _products(listed, width, width, lambda x: centred(x, n, sums)) / n
    values, found = leading_components(covariance, components)
    kept = values > LEAST_SHARE * values.max(initial=0)
    values, found = values[kept], found[kept]
    error = 0.0
    if len(values):
        projection = found.T / np.sqrt(values)

        def projected(x: np.ndarray) -> np.ndarray:
            own = centred(x, n, sums) @ projection
            return np.column_stack((own, np.ones(len(own))))

        total = _products(listed, width, len(values) + 1, projected) / n
        mean = total[:-1, -1]
        error = float(np.abs(total[:-1, :-1] - np.outer(mean, mean) - np.eye(len(values))).max())
    return Whitening(n, sums, found, values, float(np.trace(covariance)), error)


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """``id, deviation, whitened`` for the rows ``(id, vector)`` whose vector is usable: the sum of
    the squares of ``n x - S``, exact, and the whitened vector. Every row is projected, also
    copies; ids may repeat or be null."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        width = len(model.sums)
        projection = model.components.T / np.sqrt(model.eigenvalues)
        for batch in (part for whole in batches for part in pieces(whole, 4 << 20)):
            places, found = whole_vectors(batch.column("vector"))
            if not len(places):
                continue
            if any(len(x) != width for x in found):
                raise ValueError(f"a vector has not the {width} entries of the fit")
            x = np.array(found).reshape(len(found), width)
            offset = offsets(x, model.n, model.sums)
            own = (offset / model.n).astype(np.float64) @ projection
            ends = np.arange(0, own.size + 1, max(1, own.shape[1]), dtype=np.int32)[:len(own) + 1]
            if not own.shape[1]:
                ends = np.zeros(len(own) + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(places)), pa.array(deviations(offset), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(own.ravel()))],
                names=["id", "deviation", "whitened"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "vector").mapInArrow(
        run, f"id {id_type}, deviation bigint, whitened array<double>")


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """Every usable embedding with its leading whitened components, one row a component."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    model = fit(rows)
    shares = [float(e / model.trace) for e in model.eigenvalues]
    # components are at most 16, so their shares can stand in the plan
    explained = F.array(*[F.lit(s) for s in shares]) if shares else F.array(F.lit(0.0))
    return project(rows, model).select(
        F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"))
