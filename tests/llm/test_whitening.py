import numpy as np
import pytest

from basketry.llm import whitening
from basketry.llm.common import Cut
from edge_rows import edge, nothing  # noqa: F401


def plain(vectors, components=32):
    """By a dense eigenvalue solver: whitened rows, shares of the trace, exact deviations."""
    x = np.floor(64 * np.array(vectors, float))
    n = len(x)
    away = x - x.mean(axis=0)
    values, q = np.linalg.eigh(away.T @ away / n)
    values, q = values[::-1][:components], q[:, ::-1][:, :components]
    exact = [[int(c) + 1_000_000 for c in row] for row in x]
    sums = [sum(c) for c in zip(*exact, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in exact]
    return away @ q / np.sqrt(values), values / (away**2).sum() * n, deviations


def table(spark, vectors):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(3)


def gather(rows, k):
    rows = sorted(rows, key=lambda r: (r.vec_id, r.component))
    return np.array([r.whitened for r in rows]).reshape(-1, k), rows


def agree(found, want, tolerance):
    return np.abs(found * np.sign((found * want).sum(axis=0)) - want).max() <= tolerance


def test_equals_a_dense_solver(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    found, rows = gather(whitening.report(df).collect(), 32)
    want, shares, deviations = plain([r.embedding for r in df.orderBy("vec_id").collect()])
    assert agree(found, want, 1e-9)
    assert [r.deviation for r in rows[::32]] == deviations
    assert np.allclose([r.explained for r in rows[:32]], shares, rtol=1e-10)
    assert rows[0].identity_error < 1e-10 and rows[0].n == len(deviations)
    assert [r.component for r in rows[:32]] == list(range(1, 33))


def test_filter_finds_the_leading_part_of_a_steep_and_of_a_flat_spectrum(spark):
    random = np.random.default_rng(2)
    for decay in (0.85, 1.0):
        vectors = (random.standard_normal((600, 90)) * 3 * decay ** np.arange(90)).tolist()
        x = Cut(whitening.integers(table(spark, vectors)), "x").df
        fitted = whitening.fit_rows(x, 8)
        rows = whitening.apply_rows(x, fitted, 0.0).collect()
        want, shares, _ = plain(vectors, 8)
        assert agree(gather(rows, 8)[0], want, 1e-8)
        assert np.allclose(fitted.values / fitted.trace, shares, rtol=1e-11)
        assert fitted.passes > whitening.STEPS + whitening.DEGREE  # 16 of 90 columns: it has to iterate


def test_polynomial_damps_the_unwanted_spectrum():
    values = np.linspace(10, 1, 40)

    class Dense:
        def times(self, block):
            return values[:, None] * block

    block = np.eye(40)
    out = np.diag(whitening.chebyshev(Dense(), block, values[:, None] * block, 1.0, 5.0, 10.0, 8))
    assert abs(out[0]) == pytest.approx(1)
    assert np.abs(out[values <= 5]).max() < 1e-3 and (np.abs(out[values > 8]) > 0.05).all()


def test_equal_eigenvalues(spark):
    """A cross of axes: four equal eigenvalues; any basis of their space will do."""
    vectors = [[s * (i == j) for j in range(4)] for i in range(4) for s in (1.0, -1.0)]
    rows = whitening.report(table(spark, vectors)).collect()
    found, rows = gather(rows, 4)
    assert np.allclose(found.T @ found / 8, np.eye(4)) and rows[0].identity_error < 1e-12


def test_nulls_lengths_and_repeated_rows(spark):
    good = np.random.default_rng(1).standard_normal((20, 3)).tolist()
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 1.0, 2.0], [1.0, 2.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [(3, good[3]), (None, good[4])] + [(100 + i, v) for i, v in enumerate(bad)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, x int, n int")
    found = whitening.report(df).collect()
    assert len(found) == 22 * 3 and {r.n for r in found} == {22}
    assert len([r for r in found if r.vec_id == 3]) == 6 and len([r for r in found if r.vec_id is None]) == 3


def test_nothing_to_scale(spark, nothing):
    same = table(spark, [[1.0, 2.0]] * 5)
    assert whitening.report(same).collect() == []
    assert whitening.report(same.filter("vec_id < 0")).collect() == []
    flat = table(spark, [[float(i), 2.0] for i in range(5)])
    assert {r.component for r in whitening.report(flat).collect()} == {1}


def test_deviations_are_exact_or_an_error():
    x = np.array([[2**40, 1], [3, 5]], np.int64)
    sums = [int(c) for c in x.sum(axis=0)]
    assert whitening._deviations(x, 2, sums) == [sum((2 * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
