"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

The distinct vectors are centred rows of a matrix X that stays where Spark has dealt it. A step takes a pass over them: each task forms its part of
u = Xw and then of X'u, and the parts of X'u are summed. w is the next right vector less what the left vectors so far hold of it, so u comes out
orthogonal to them; both sides are reorthogonalised in full. The driver holds some vectors of the dimension's length for each step, and nothing that
grows with the rows. The singular values of the small bidiagonal matrix are the deviations, its right singular vectors turn the right vectors into
components.

Defined results: a vector that is null, empty or holds a null, NaN or infinite entry takes no part; nor does one of another length than the most
frequent (ties: the longer). Repeated vectors count once in the fit and are whitened each; ids may be null or repeated, further columns are not read.
Entries are held to +-2^40 once they are whole numbers. A deviation beyond 64 bits is null. Components without any deviation (fewer distinct vectors or
dimensions than components) are left out, so that a table with one distinct vector, or none, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, written

#: Vectors are whole multiples of 1 / SCALE.
SCALE = 256
#: Whole numbers are held to this size, so that sums over a batch of rows fit in 64 bits.
MOST = 1 << 40
#: A singular triplet has converged when its residual is so small against the largest singular value.
TOLERANCE = 4e-16
#: A deviation of this share of the largest is rounding.
NOTHING = 1e-9
#: Vectors of a block, and blocks that go to Python at once.
BLOCK_ROWS, BLOCKS = 4096, 4
OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors with the exact sums of their whole numbers, the components (rows) with their variances, and what was measured."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float
    steps: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def usable(df: DataFrame, column: str = "embedding") -> DataFrame:
    """df's usable vectors with x, their whole numbers."""
    fine = F.size(column) > 0
    entries = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(F.col(column), lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(MOST))), F.lit(float(-MOST)))))
    # Another step after the filter, so that no floor is taken of what is not finite.
    good = df.filter(F.coalesce(fine & entries, F.lit(False)))
    lengths = good.groupBy(F.size(column).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return good.filter(F.size(column) == (lengths.n if lengths else 0)).withColumn("x", whole)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an Arrow list column."""
    return np.asarray(column.flatten()).reshape(len(column), dims)


def packed(rows: DataFrame) -> DataFrame:
    """The stored table of rows' x in blocks of rows: block (little-endian 32-bit numbers, or 64-bit ones where they need it), n and d. Every pass reads it."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = np.asarray(batch.column(0).flatten())
                small = flat.min() >= -(1 << 31) and flat.max() < 1 << 31
                yield pa.RecordBatch.from_arrays([
                    pa.array([flat.astype("<i4" if small else "<i8").tobytes()]), pa.array([batch.num_rows], pa.int32()), pa.array([len(flat) // batch.num_rows], pa.int32()),
                ], ["block", "n", "d"])

    return written(rows.select("x").mapInArrow(each, "block binary, n int, d int"), "fit-vectors", arrow_rows=BLOCK_ROWS)


def blocks(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The rows of each block of a batch (block, n, d)."""
    for block, n, d in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
        data = block.as_buffer()
        yield np.frombuffer(data, "<i4" if len(data) == 4 * n * d else "<i8").reshape(n, d)


def summed(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all blocks of rows of part(block), an array of `size` doubles."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for block in blocks(batch):
                total += part(block)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "value"])

    with arrow_batches(fit.sparkSession, BLOCKS):
        rows = fit.mapInArrow(each, "i bigint, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r.i] = r.value
    return out


def exact_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows, and the sum of each dimension as whole numbers of any size."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            for block in blocks(batch):
                n += len(block)
                total = [a + b for a, b in zip(total, block.sum(axis=0, dtype=np.int64).tolist(), strict=True)]
        # Low and high parts, as a sum may need over 64 bits.
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dims), pa.int32()), pa.array([n & 0x7FFFFFFF, *[t & 0x7FFFFFFF for t in total]], pa.int64()), pa.array([n >> 31, *[t >> 31 for t in total]], pa.int64())], ["i", "low", "high"])

    with arrow_batches(fit.sparkSession, BLOCKS):
        rows = fit.mapInArrow(each, "i int, low bigint, high bigint").groupBy("i").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).collect()
    found = {r.i: (r.high << 31) + r.low for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(dims)]


class _Steps:
    """The bidiagonalisation of the centred rows, as far as it has come: right vectors V, coefficients W of the left vectors (U = XW), P = X'U, alpha, beta."""

    def __init__(self, fit: DataFrame, mean: np.ndarray, without: np.ndarray):
        self.fit, self.mean, self.without = fit, mean, without
        self.dims, self.random = len(mean), np.random.default_rng(7)
        self.V: list[np.ndarray] = []
        self.W: list[np.ndarray] = []
        self.P: list[np.ndarray] = []
        self.alpha: list[float] = []
        self.beta: list[float] = []
        self.next = self.fresh()

    def apart(self, r: np.ndarray) -> np.ndarray:
        """r less what lies in the right vectors and in the components left out; twice is enough."""
        for _ in range(2):
            for basis in (self.without, np.array(self.V).reshape(-1, self.dims)):
                r = r - basis.T @ (basis @ r)
        return r

    def fresh(self) -> np.ndarray | None:
        """A random unit vector apart from all others, or None where there is none."""
        if len(self.V) + len(self.without) >= self.dims:
            return None
        r = self.apart(self.random.standard_normal(self.dims))
        r = self.apart(r / np.linalg.norm(r))
        return r / np.linalg.norm(r)

    def step(self) -> bool:
        """One pass over the rows; whether there was one more direction."""
        v = self.next
        if v is None:
            return False
        w = v.copy()
        W, P = np.array(self.W).reshape(-1, self.dims), np.array(self.P).reshape(-1, self.dims)
        for _ in range(2):
            w = w - W.T @ (P @ w)
        mean = self.mean

        def product(block: np.ndarray) -> np.ndarray:
            rows = block - mean
            u = rows @ w
            return np.append(u @ rows, u @ u)

        found = summed(self.fit, product, self.dims + 1)
        alpha, xu = float(np.sqrt(max(found[-1], 0.0))), found[:-1]
        self.V.append(v)
        self.alpha.append(alpha)
        if alpha > NOTHING * max(self.alpha):
            self.W.append(w / alpha)
            self.P.append(xu / alpha)
            r = self.apart(xu / alpha - alpha * v)
        else:  # the rows hold nothing in this direction
            r = np.zeros(self.dims)
        beta = float(np.linalg.norm(r))
        if beta > 1e-14 * max(self.alpha):
            self.next = self.apart(r / beta)
            self.next /= np.linalg.norm(self.next)
        else:  # all that the start reaches is found; go on in a direction of its own
            beta, self.next = 0.0, self.fresh()
        self.beta.append(beta)
        return True

    def triplets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values, right singular vectors as rows, and the residual of each, by the small bidiagonal matrix."""
        left, values, right = np.linalg.svd(np.diag(self.alpha) + np.diag(self.beta[:-1], 1))
        return values, right @ np.array(self.V), abs(self.beta[-1] * left[-1])

    def done(self, many: int) -> bool:
        values, _, residual = self.triplets()
        return self.next is None or len(values) >= many and bool((residual[:many] <= TOLERANCE * values[0]).all())


def bidiagonalise(fit: DataFrame, mean: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The `many` largest singular values of the centred rows, their right singular vectors as rows, and the passes it took.

    Steps go on until those values have converged, or there is no direction left. One start reaches one vector of each singular value, so where steps
    ended before that, what is apart from the vectors found is bidiagonalised as well, until it holds nothing as large.
    """
    dims = len(mean)
    values, vectors, passes = np.zeros(0), np.zeros((0, dims)), 0
    while True:
        steps = _Steps(fit, mean, vectors)
        while steps.step():
            passes += 1
            if steps.done(many if not len(vectors) else 1):
                break
        if not steps.V:
            break
        new, rows, _ = steps.triplets()
        least = values[many - 1] if len(values) >= many else 0.0
        larger = new > least * (1 + 1e-9)
        whole = steps.next is None and not len(vectors)
        keep = larger[:many] if not len(vectors) else larger[:1]
        at = np.flatnonzero(keep)
        values, vectors = np.append(values, new[at]), np.vstack([vectors, rows[at]])
        order = np.argsort(-values, kind="stable")[:many]
        values, vectors = values[order], vectors[order]
        if whole or not len(at):
            break
    return values, vectors, passes


def train(df: DataFrame, many: int = 4, column: str = "embedding") -> tuple[DataFrame, Whitening | None]:
    """(the usable rows of df with x, the whitening that their distinct vectors give; None if there is no deviation at all)."""
    rows = usable(df, column)
    fit = packed(rows.select("x").distinct())
    first = fit.select("d").first()
    if first is None:
        return rows, None
    dims = first.d
    n, sums = exact_sums(fit, dims)
    mean = np.array([s / n for s in sums])
    trace = float(summed(fit, lambda block: np.array([((block - mean) ** 2).sum()]), 1)[0]) / n
    values, vectors, passes = bidiagonalise(fit, mean, many)
    seen = values > NOTHING * max(values, default=0.0) if trace > 0 else np.zeros(len(values), bool)
    values, vectors = values[seen], vectors[seen]
    if not len(values):
        return rows, None
    k, to = len(values), vectors.T * (np.sqrt(n) / values)

    def moments(block: np.ndarray) -> np.ndarray:
        y = (block - mean) @ to
        return np.append(y.sum(axis=0), (y.T @ y).ravel())

    found = summed(fit, moments, k + k * k) / n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    return rows, Whitening(n, tuple(sums), vectors, values**2 / n, trace, float(abs(covariance - np.eye(k)).max()), passes)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """The sum of (n x - S)^2 of each row, exactly; null beyond 64 bits."""
    most = n * int(abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most**2 * x.shape[1] < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(d) if d < 1 << 63 else None for d in exact]


def whiten(rows: DataFrame, model: Whitening | None, key: str = "vec_id") -> DataFrame:
    """A row for each usable row and component."""
    if model is None:
        return rows.sparkSession.createDataFrame([], OUT)
    mean, k = model.mean, len(model.variances)
    to, explained = model.components.T / np.sqrt(model.variances), model.variances / model.trace

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), len(mean)) if batch.num_rows else np.zeros((0, len(mean)), np.int64)
            m = len(x)
            twice = lambda values: pa.array(values).take(pa.array(np.repeat(np.arange(m), k)))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                twice(pa.array(deviations(x, model.n, model.sums), pa.int64())), pa.array(((x - mean) @ to).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, model.identity_error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col(key).cast("bigint").alias("vec_id"), "x").mapInArrow(each, OUT)
