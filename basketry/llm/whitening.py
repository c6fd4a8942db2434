"""Embedding whitening: leading eigenvectors by Chebyshev-filtered subspace iteration over distributed passes.

1. Entries become integers, ``floor(scale * c) + OFFSET``. One pass gives the number of rows and the sum of each
   dimension, exactly. From there on rows are centred in integers first (the rounded mean) and the rest of the
   mean, at most a half, is taken off in double precision, so nothing is lost to the offset.
2. A pass computes ``X'X Q / n`` for a block Q of ``components + GUARD`` columns: every task multiplies its
   centred rows and adds up a matrix of dimension x block, Spark sums these by dimension, and the driver receives
   one such matrix, whatever the number of rows or tasks.
3. A few Lanczos steps with one column bound the spectrum from below. Then, in turn: QR of the block, a pass,
   Rayleigh-Ritz, and a polynomial of degree ``DEGREE`` in the covariance, by the three-term Chebyshev recurrence
   (one pass a step, the first is the one that Rayleigh-Ritz has made), which damps what lies between the lower
   bound and the least Ritz value of the block and lets the wanted part grow.
4. Certified: for every wanted pair the residual ``|Vq - eq|`` is at most ``TOLERANCE`` of the largest eigenvalue.
   Below that rounding decides; iteration ends too when residuals stop falling after ``GOOD`` was reached. If
   ``ROUNDS`` rounds do not get there, it raises.
5. Rows are projected in a last pass, and one more pass measures the covariance of what came out.

Each pass is a job over the stored integers: lost executors cost tasks, and nothing but matrices of the dimension
reach the driver.

A row whose vector is null, holds null or non-finite entries, or is empty, is dropped. The dimension is the most
frequent length (the longest of equally frequent ones); vectors of other lengths are dropped too. Components with an
eigenvalue below ``FLOOR`` of the largest have nothing to be scaled to and are left out, so a table of equal vectors,
like an empty one, gives no rows. Repeated rows count as often as they come, and null ids stay null. Where equal
eigenvalues leave a choice of vectors, the block's are taken. An integer out of the range of a long is an error,
never a wrong number. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Cut, ship

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: Columns beyond the wanted ones, degree of the filter, Lanczos steps of the bound, most rounds.
GUARD, DEGREE, STEPS, ROUNDS = 8, 10, 10, 60
TOLERANCE, GOOD, FLOOR = 2e-15, 1e-11, 1e-12


@dataclass(frozen=True)
class Whitening:
    """What was fitted. ``vectors`` has a column for each component, by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    passes: int

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        return _centre(self.n, self.sums)


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rounded mean of each dimension, and what is left of the mean."""
    whole = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(whole, np.int64), np.array([(s - w * n) / n for s, w in zip(sums, whole, strict=True)])


def integers(df: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, x``: the rows that count, as integers, of the most frequent length."""
    v = F.col(f"`{column}`")
    entries = F.transform(v, lambda c: c.cast("double"))
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    good = df.filter(v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))
    # floor() of Spark gives a long; entries beyond it are an error there.
    x = F.transform(entries, lambda c: F.floor(c * SCALE) + F.lit(OFFSET).cast("long"))
    rows = good.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), x.alias("x"))
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == (length.d if length else 0))


def _matrix(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _sums(x: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and sum of each dimension; exact."""
    dims = x.select(F.posexplode("x").alias("j", "c")).groupBy("j").agg(F.count("*").alias("n"), F.sum("c").alias("s"))
    rows = sorted(dims.collect())
    return (rows[0].n, [r.s for r in rows]) if rows else (0, [])


class Passes:
    """Products of the covariance with blocks; each is one job over the stored rows."""

    def __init__(self, x: DataFrame, n: int, sums: list[int]):
        self.x, self.n, self.dimension, self.made = x, n, len(sums), 0
        self.centre = _centre(n, sums)

    def _summed(self, width: int, of_rows) -> np.ndarray:
        """Sum over all tasks of matrices of ``dimension`` rows at most and ``width`` columns."""
        dimension, (whole, rest) = self.dimension, self.centre
        schema = "j int, " + ", ".join(f"c{i} double" for i in range(width))

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                part = of_rows((_matrix(batch, dimension) - whole) - rest)
                total = part if total is None else total + part
            if total is not None:
                columns = [pa.array(np.arange(len(total), dtype=np.int32)), *map(pa.array, np.ascontiguousarray(total.T))]
                yield pa.RecordBatch.from_arrays(columns, names=["j", *(f"c{i}" for i in range(width))])

        parts = self.x.mapInArrow(multiply, schema)
        rows = sorted(parts.groupBy("j").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(width)]).collect())
        self.made += 1
        return np.array([r[1:] for r in rows])

    def variances(self) -> np.ndarray:
        return self._summed(1, lambda rows: (rows * rows).sum(axis=0)[:, None])[:, 0] / self.n

    def times(self, block: np.ndarray) -> np.ndarray:
        """Covariance times ``block``."""
        return self._summed(block.shape[1], lambda rows: rows.T @ (rows @ block)) / self.n

    def gram(self, project: np.ndarray) -> np.ndarray:
        """Covariance of the rows after ``project``."""
        wide = np.vstack([project, np.zeros((1, project.shape[1]))])[: self.dimension]

        def both(rows: np.ndarray) -> np.ndarray:
            y = rows @ wide
            return np.vstack([y.T @ y, y.sum(axis=0)])

        found = self._summed(project.shape[1], both)
        mean = found[-1] / self.n
        return found[:-1] / self.n - np.outer(mean, mean)


def lower_bound(passes: Passes, seed: int = 3) -> float:
    """A value that the least eigenvalue is hardly below: the least Ritz value of some Lanczos steps less its residual."""
    d = passes.dimension
    q = np.random.default_rng(seed).standard_normal(d)
    basis, alpha, beta = [q / np.linalg.norm(q)], [], []
    for _ in range(min(STEPS, d)):
        w = passes.times(basis[-1][:, None])[:, 0]
        alpha.append(float(basis[-1] @ w))
        for v in [*basis, *basis]:  # twice, against all: the steps are few
            w = w - (v @ w) * v
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-14 * max(alpha):
            break
        basis.append(w / beta[-1])
    k = len(alpha)
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[: k - 1], 1) + np.diag(beta[: k - 1], -1))
    return max(0.0, float(values[0] - beta[-1] * abs(vectors[-1, 0])))


def chebyshev(passes: Passes, block: np.ndarray, product: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The polynomial of ``degree`` that is small on [low, high] and one at ``top``, applied to ``block``;
    ``product`` is the covariance times the block."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - middle)
    before, now = block, (product - middle * block) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (passes.times(now) - middle * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def fit_rows(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on stored rows ``vec_id, x``; None when no row or no spread is there."""
    n, sums = _sums(x)
    if not n:
        return None
    passes = Passes(x, n, sums)
    trace = float(passes.variances().sum())
    if trace <= 0:
        return None
    d = len(sums)
    wanted, width = min(components, d), min(d, components + GUARD)
    low = lower_bound(passes) if width < d else 0.0
    block = np.linalg.qr(np.random.default_rng(5).standard_normal((d, width)))[0]
    best, stale = np.inf, 0
    for _ in range(ROUNDS):
        product = passes.times(block)
        ritz, turn = np.linalg.eigh((block.T @ product + product.T @ block) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        residual = float(np.linalg.norm(product - block * ritz, axis=0)[:wanted].max() / ritz[0])
        if residual < best / 2:
            stale, best = 0, residual
            held = (ritz.copy(), block.copy())
        else:
            stale += 1
        if best <= TOLERANCE or (best <= GOOD and stale >= 2):
            break
        # What is above the block's least value grows; the span never closes, or nothing would be damped.
        high = max(float(ritz[-1]), low + 1e-6 * ritz[0])
        if high < ritz[0]:
            block = chebyshev(passes, block, product, min(low, high * (1 - 1e-3)), high, float(ritz[0]), DEGREE)
        block = np.linalg.qr(block)[0]
    else:
        if best > GOOD:
            raise ArithmeticError(f"no convergence: residual {best:.1e} after {passes.made} passes")
    ritz, block = held
    keep = ritz[:wanted] > FLOOR * ritz[0]
    vectors = block[:, :wanted][:, keep]
    # One sign for all rows and runs: the largest entry is positive.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return Whitening(n, sums, ritz[:wanted][keep], vectors, trace, best, passes.made)


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int] | np.ndarray:
    """Sum over dimensions of (n*x - S)**2 of each row, exact."""
    low, high = x.min(axis=0), x.max(axis=0)
    reach = sum(max(abs(n * int(a) - s), abs(n * int(b) - s)) ** 2 for a, b, s in zip(low, high, sums, strict=True))
    if reach < 2**62 and max(n * max(abs(int(a)), abs(int(b))) for a, b in zip(low, high, strict=True)) < 2**62:
        away = n * x - np.array(sums, np.int64)
        return (away * away).sum(axis=1)
    return [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist()]


def apply_rows(x: DataFrame, fitted: Whitening, identity_error: float) -> DataFrame:
    """A row for each vector and component."""
    dimension, (whole, rest) = len(fitted.sums), fitted.centre
    project = fitted.vectors / np.sqrt(fitted.values)
    explained = fitted.values / fitted.trace
    n, sums, k = fitted.n, fitted.sums, project.shape[1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, dimension)
            y = ((x - whole) - rest) @ project
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, n)),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(each),
                    pa.array(y.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(x) * k, identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return x.mapInArrow(rows, RESULT)


def identity_error(x: DataFrame, fitted: Whitening) -> float:
    """Largest entry of the whitened rows' covariance less the identity."""
    found = Passes(x, fitted.n, fitted.sums).gram(fitted.vectors / np.sqrt(fitted.values))
    return float(np.abs(found - np.eye(len(found))).max())


def report(df: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit on all rows of ``df`` and project them: ``vec_id, component, n, deviation, whitened, explained,
    identity_error``."""
    ship(df.sparkSession)
    x = Cut(integers(df, id_column, column), "integers").df
    fitted = fit_rows(x, components)
    if fitted is None or not len(fitted.values):
        return df.sparkSession.createDataFrame([], RESULT)
    return apply_rows(x, fitted, identity_error(x, fitted))
