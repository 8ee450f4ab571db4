"""Embedding whitening with a covariance by polarisation.

Entries are integers (floor of 256 times the entry), so every sum of the fit is exact. Tasks add up the
squares of n * x - S for each dimension and for the sum of each two dimensions; what the variance of
a sum has beyond its two variances is twice their covariance. Sums leave a task as numbers of 30
bits, which Spark adds up place by place. Only the dimensions' sums come to the driver, D * (D + 1) / 2
numbers for D dimensions whatever the number of rows, and are put together for the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.session import stored

SCALE, COMPONENTS = 256, 4
#: Bits of a number that Spark adds up; bits of a factor whose products add up over BLOCK rows in 64 bits; rows at a time.
PLACE, LIMB, BLOCK = 30, 21, 1 << 12
#: Numbers below this can be added to one another, and squared by limbs, in 64 bits.
SAFE = 1 << 61


@dataclass(frozen=True)
class Whitening:
    """n and sums of the distinct vectors, exact; unit eigenvectors as columns, their eigenvalues and shares of
    the trace; how far the whitened vectors' covariance is from the identity."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None


def integer_vectors(rows: DataFrame, key: str | None = None, vector: str = "embedding") -> DataFrame:
    """``rows`` with a vector of finite entries as (key and) x, an array of long; the others are left out."""
    entry = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    fit = rows.filter(F.col(vector).isNotNull()).filter(~F.exists(F.col(vector).cast("array<double>"), entry))
    x = F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(c * SCALE)).cast("array<bigint>").alias("x")
    return fit.select(*([key] if key else []), x)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, in 64 bits where that is exact, else as Python's numbers."""
    most = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
    if 2 * n * most + max(map(abs, sums), default=0) < SAFE:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def square_sums(y: np.ndarray) -> list[int]:
    """Exact sum of squares of each column, of at most BLOCK rows."""
    if y.dtype == object:
        return [int(v) for v in (y * y).sum(axis=0)]
    size = np.abs(y)
    parts = [(size >> s) & ((1 << LIMB) - 1) for s in range(0, max(1, int(size.max(initial=0)).bit_length()), LIMB)]
    total = [0] * y.shape[1]
    for a, left in enumerate(parts):
        for b, right in enumerate(parts[a:], a):
            shift = LIMB * (a + b) + (a != b)
            total = [t + (int(v) << shift) for t, v in zip(total, np.einsum("rk,rk->k", left, right))]
    return total


def pair_squares(y: np.ndarray) -> Iterator[int]:
    """Sums of squares of the dimensions, then of the sums of dimensions 0 and 1, 0 and 2, ..., 1 and 2, ..."""
    yield from square_sums(y)
    for i in range(y.shape[1] - 1):
        yield from square_sums(y[:, i : i + 1] + y[:, i + 1 :])


def places(value: int) -> list[int]:
    """Digits of 30 bits, lowest first; the sign is the last one's."""
    found = []
    while not -(1 << PLACE) < value < 1 << PLACE:
        found.append(value & ((1 << PLACE) - 1))
        value >>= PLACE
    return [*found, value]


def _added(fit: DataFrame, dims: int, numbers: int, each: Callable[[np.ndarray], Iterable[int]]) -> list[int]:
    """Exact totals of the numbers that ``each`` gives for blocks of vectors; one row per number and place reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for at in range(0, len(x), BLOCK):
                found = each(x[at : at + BLOCK])
                total = list(found) if total is None else [t + v for t, v in zip(total, found)]
        if total is not None:
            rows = [(i, p, v) for i, t in enumerate(total) for p, v in enumerate(places(t))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64()))], ["i", "p", "v"])

    total = [0] * numbers
    for r in fit.mapInArrow(run, "i int, p int, v bigint").groupBy("i", "p").agg(F.sum("v").alias("v")).collect():
        total[r.i] += r.v << (PLACE * r.p)
    return total


def covariance(n: int, squares: list[int], dims: int) -> np.ndarray:
    """From sums of squares of n * x - S: each entry is exact until its one division."""
    v = np.empty((dims, dims))
    at = dims
    for i in range(dims):
        v[i, i] = squares[i] / n**3
        for j in range(i + 1, dims):
            v[i, j] = v[j, i] = (squares[at] - squares[i] - squares[j]) / (2 * n**3)
            at += 1
    return v


def _projected(y: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened values; NaN for a component without variance."""
    scale = np.where(model.values > 0, np.sqrt(np.maximum(model.values, 0)), np.nan)
    return (y / model.n).astype(np.float64) @ model.vectors / scale


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """A whitening by the distinct integer vectors of ``rows``; None without any.

    Vectors count whose number of dimensions is the commonest, the larger of two as common. An
    eigenvalue within rounding of 0 is 0.
    """
    x = integer_vectors(rows, vector=vector).filter("size(x) > 0")
    sizes = x.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if sizes is None:
        return None
    dims = sizes.dims
    once = stored(x.filter(F.size("x") == dims).distinct(), "vectors")
    n = once.count()
    sums = _added(once, dims, dims, lambda x: map(int, x.astype(object).sum(axis=0)))
    squares = _added(once, dims, dims * (dims + 1) // 2, lambda x: pair_squares(centred(x, n, sums)))
    v = covariance(n, squares, dims)
    value, vectors = np.linalg.eigh(v)
    value, vectors = value[::-1], vectors[:, ::-1]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(dims)])
    value = np.where(value > dims * np.finfo(float).eps * value[0], value, 0.0)
    trace, k = np.trace(v), min(components, dims)
    share = value[:k] / trace if trace > 0 else np.full(k, np.nan)
    found = Whitening(n, sums, np.ascontiguousarray(vectors[:, :k]), value[:k], share, None)
    return Whitening(n, sums, found.vectors, found.values, share, _identity_error(once, found))


def _identity_error(once: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over components with variance."""
    used = int((model.values > 0).sum())
    if not used:
        return None
    n, dims = model.n, len(model.sums)
    schema = "i int, j int, a double, c double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean = np.zeros((used, used)), np.zeros(used)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for at in range(0, len(x), BLOCK):
                w = _projected(centred(x[at : at + BLOCK], n, model.sums), model)[:, :used]
                total, mean = total + w.T @ w, mean + w.sum(axis=0)
        rows = [(i, j, mean[i], total[i, j]) for i in range(used) for j in range(used)]
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["i", "j", "a", "c"])

    # projections of centred vectors are centred, but for the rounding that their mean shows
    cells = {(r.i, r.j): r for r in once.mapInArrow(run, schema).groupBy("i", "j").agg(F.sum("a").alias("a"), F.sum("c").alias("c")).collect()}
    return max(abs(r.c / n - r.a / n * (cells[j, i].a / n) - (i == j)) for (i, j), r in cells.items())


def whiten(rows: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per remaining row and component: key, component (from 1), n, deviation (sum over dimensions of
    (n * x - S) ** 2, exact; null where it exceeds 64 bits), whitened, explained and identity_error.

    A row goes whose vector is null, holds a null or non-finite entry, or has another number of
    dimensions than the model. Without variance in a component (one distinct vector, or fewer than
    components) whitened is null; explained and identity_error are null where all are equal. Null keys and
    repeated rows stay; an empty table gives no rows. Other columns may have any name.
    """
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    dims, k = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                y = centred(_matrix(part.column(1), dims), model.n, model.sums)
                w, m = _projected(y, model), part.num_rows
                exact = y if int(np.abs(y).max(initial=0)) ** 2 * dims < 1 << 63 else y.astype(object)
                deviation = [v if v < 1 << 63 else None for v in map(int, (exact * exact).sum(axis=1))]
                made = [
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array([v for v in deviation for _ in range(k)], pa.int64()),
                    pa.array(w.ravel(), from_pandas=True),
                    pa.array(np.tile(model.explained, m), from_pandas=True),
                    pa.array([model.identity_error] * (m * k), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(made, [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return integer_vectors(rows, key, vector).filter(F.size("x") == dims).mapInArrow(run, schema)
