"""Whitening against whole-number sums in Python and an independent eigensolver."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyground.llm import whitening as W

SCHEMA = "id bigint, vector array<float>"


def whole(vector):
    """The vector as whole numbers, or None where it is not usable."""
    if not vector or any(v is None or not math.isfinite(v) for v in vector):
        return None
    return tuple(math.floor(64 * float(v)) + 1_000_000 for v in vector)


def expected(rows, components=16):
    """``id -> [(n, deviation, whitened, explained)]`` by component, with NumPy's own solver."""
    usable = [(i, x) for i, v in rows if (x := whole(v)) is not None]
    fit = sorted({x for _, x in usable})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    offset = np.array([[n * v - s for v, s in zip(x, sums)] for x in fit], dtype=object)
    centre = (offset / n).astype(float)
    values, vectors = np.linalg.eigh(centre.T @ centre / n)
    order = np.argsort(-values)[:components]
    out = []
    for i, x in usable:
        own = [n * v - s for v, s in zip(x, sums)]
        flat = np.array([v / n for v in own])
        out.append((i, n, sum(v * v for v in own), [
            (float(flat @ vectors[:, k] / math.sqrt(values[k])), values[k] / values.sum())
            for k in order]))
    return out


def agree(rows, want, components=16):
    """Query rows against the expected ones, up to one sign a component."""
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, []).append(r)
    assert sorted(got, key=str) == sorted({w[0] for w in want}, key=str)
    signs = np.zeros(components)
    for i, n, deviation, by_component in want:
        mine = sorted(got[i], key=lambda r: r.component)[:components]
        assert [r.component for r in mine] == list(range(1, len(by_component) + 1))
        for r, (value, share) in zip(mine, by_component):
            assert (r.n, r.deviation) == (n, deviation)
            assert r.explained == pytest.approx(share, rel=1e-6) and r.identity_error < 1e-9
            assert abs(r.whitened) == pytest.approx(abs(value), abs=1e-6)
            if abs(value) > 1e-3:
                sign = np.sign(r.whitened * value)
                assert signs[r.component - 1] in (0, sign)
                signs[r.component - 1] = sign


def test_query(spark, smallest):
    table = spark.read.parquet(f"{smallest}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = W.op11_whitening(spark, smallest)
    assert got.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
        ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    found = got.collect()
    assert len(found) == 16 * len(rows)
    agree(found, expected(rows))


@pytest.fixture
def table(spark, tmp_path):
    """Writes rows as the embeddings table of a folder, with columns named like the operator's."""

    def write(rows, kind="array<float>"):
        df = spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}").withColumns(
            {c: F.lit(7) for c in ("id", "vector", "x", "whitened", "component", "label")})
        path = tmp_path / f"{len(list(tmp_path.iterdir()))}"
        df.repartition(3).write.parquet(f"{path}/embeddings.parquet")
        return str(path)

    return write


def test_awkward_rows(spark, table):
    """Nulls, gaps, no entries, NaN, infinities, copies under one or several ids, a null id."""
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=3).astype(np.float32).tolist()) for i in range(40)]
    rows += [(50 + i, rows[0][1]) for i in range(30)]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [math.nan, 0.0, 1.0]),
           (94, [math.inf, 0.0, 1.0]), (95, [0.0, 1.0, -math.inf])]
    got = W.op11_whitening(spark, table(rows + bad + [(None, rows[1][1])])).collect()
    want = expected(rows + [(None, rows[1][1])], 3)
    assert want[0][1] == 40 and len(got) == 3 * 71
    agree(got, want, 3)


@pytest.mark.parametrize("rows", [
    [], [(1, None), (2, [])], [(1, [1.0, 2.0])] * 3, [(1, [1.0, 2.0]), (2, [1.001, 2.0])]])
def test_without_variation_there_are_no_rows(spark, table, rows):
    assert W.op11_whitening(spark, table(rows)).count() == 0


def test_fewer_dimensions_spanned(spark, table):
    random = np.random.default_rng(5)
    flat = random.integers(-40, 40, size=(60, 2)) @ np.array([[1, 0, 2, 1], [0, 1, -1, 3]])
    got = W.op11_whitening(spark, table(
        [(i, (v / 64).tolist()) for i, v in enumerate(flat)], "array<double>")).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 120
    assert sum(r.explained for r in got if r.vec_id == 0) == pytest.approx(1.0)


def test_vectors_of_other_lengths_fail(spark, table):
    with pytest.raises(ValueError, match="from 2 to 3"):
        W.op11_whitening(spark, table([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])]))


def test_exact_deviation_and_its_limit():
    x = np.array([[10 ** 12, -5], [3, 4]])
    sums = (10 ** 12 + 3, -1)
    assert W.deviations(W.offsets(x[1:], 1, (3, 4))) == [0]
    assert W.deviations(W.offsets(np.array([[3_000_000_000, 7]]), 1, (0, 0))) == [9 * 10 ** 18 + 49]
    with pytest.raises(OverflowError):
        W.deviations(W.offsets(x, 2, sums))


@pytest.mark.parametrize("matrix", [
    np.diag([5.0, 5.0, 5.0, 2.0, 1.0, 0.0]), np.eye(7), np.ones((4, 4)), np.array([[3.0]]),
    np.array([[2.0, 1.0], [1.0, 2.0]]),
    np.kron(np.eye(5), np.array([[4.0, 1.0, 0.5], [1.0, 3.0, 0.2], [0.5, 0.2, 1.0]])),
    np.diag(1.0 + np.arange(30) * 1e-13), np.diag(10.0 ** -np.arange(12))])
def test_clustered_eigenvalues(matrix):
    """Equal and almost equal values have orthogonal vectors that solve the problem."""
    random = np.random.default_rng(len(matrix))
    turn = np.linalg.qr(random.normal(size=matrix.shape))[0]
    for a in (matrix, turn @ matrix @ turn.T):
        a = (a + a.T) / 2
        values, vectors = W.leading_components(a, 16)
        k = min(16, len(a))
        assert values == pytest.approx(np.sort(np.linalg.eigvalsh(a))[::-1][:k], abs=1e-13 * np.trace(a))
        assert np.abs(vectors @ vectors.T - np.eye(k)).max() < 1e-12
        assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-12 * np.trace(a)


def test_random_matrices():
    random = np.random.default_rng(1)
    for d in (3, 10, 64, 200):
        a = random.normal(size=(d, 2 * d)) * 10.0 ** random.uniform(-3, 3, size=(d, 1))
        a = a @ a.T
        values, vectors = W.leading_components(a, 16)
        true = np.sort(np.linalg.eigvalsh(a))[::-1][:16]
        assert values == pytest.approx(true, rel=1e-6, abs=1e-13 * np.trace(a))
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-11
        assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-12 * np.trace(a)
