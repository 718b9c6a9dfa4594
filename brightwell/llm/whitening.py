"""Embedding whitening by mixed-precision refinement of eigenvectors.

Vectors become whole numbers x = floor(64 c) + 1,000,000. Each distinct x is
fitted once: Spark counts them, sums them exactly and adds up the covariance of
the centred vectors by blocks, first 256 partitions at a time, so no task gets
more than that many rows of the matrix. The matrix itself, as large as the
dimension squared, is solved on the driver: eigenvectors in float32, corrected by
Ogita and Aishima's iteration, which needs matrix products only, first in double
and then in extended precision. Eigenvalues too close for the iteration to part
form a cluster; a cluster's span is right before its vectors are, so the matrix
projected on it, shifted and scaled, is solved again in float32 and its basis
turned, after which the iteration goes on.

Rows are left out if the vector is null, empty, or holds nulls or numbers that
are not finite, or is not as long as most vectors (of equally common lengths the
longest). Numbers beyond 2^52 count as 2^52. Repeated rows are fitted once and
each returned. Components with less than 1e-11 of the largest eigenvalue have no
whitened values and are left out; so a table of one distinct vector, or an
empty one, gives no rows. A null vec_id stays. Other columns are ignored.
``deviation`` is null where it does not fit into 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightwell.llm.common import cut_lineage

SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0 ** 52
COMPONENTS = 16
#: Components below this share of the largest eigenvalue are noise of the arithmetic.
LEAST = 1e-11
#: Partitions whose partial matrices are added in one task.
TOGETHER = 256


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, x (whole numbers as an array) of all rows with a usable vector."""
    entry = F.col("embedding")
    whole = embeddings.where(F.size(entry) > 0).where(
        F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))))
    def step(c):
        scaled = c.cast("double") * SCALE
        return F.floor(F.least(F.greatest(scaled, F.lit(-LARGEST)), F.lit(LARGEST))).cast("long") + SHIFT
    return whole.select("vec_id", F.transform(entry, step).alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


@dataclass(frozen=True)
class Centre:
    """Number of fitted vectors and their exact sums."""

    n: int
    sums: tuple[int, ...]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: int64, or Python numbers where that is too small."""
        if self.n * (int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0) // self.n + 1) < 2 ** 62:
            return x * self.n - np.array(self.sums, dtype="i8")
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.scaled(x) / self.n).astype("f8")

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum of (n x - S)^2 of each row, exact, as whole numbers or None."""
        y = self.scaled(x)
        if y.dtype == object or int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] >= 2 ** 63:
            return np.array([v if v < 2 ** 63 else None for v in (y.astype(object) ** 2).sum(axis=1)], dtype=object)
        return (y * y).sum(axis=1)


def centre(fit: DataFrame, dims: int) -> Centre:
    """Exact sums of ``fit`` (x): partial sums in each task, added as decimals."""
    def run(batches):
        total, n = [0] * dims, 0
        for x in _blocks(batches, dims):
            n += len(x)
            high, low = x >> 26, x & (1 << 26) - 1
            total = [t + (int(h) << 26) + int(r) for t, h, r in zip(total, high.sum(axis=0), low.sum(axis=0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(dims)], pa.int32()), pa.array([Decimal(v) for v in (n, *total)], pa.decimal128(38, 0))], ["dim", "total"])
    rows = fit.mapInArrow(run, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total")).collect()
    sums = {r.dim: int(r.total) for r in rows}
    return Centre(sums.get(-1, 0), tuple(sums.get(i, 0) for i in range(dims)))


def _added(df: DataFrame, rows: int, width: int, make) -> np.ndarray:
    """Sum over all partitions of the (rows x width) matrices that ``make(batches)`` gives."""
    def run(batches):
        made = make(batches)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(rows, dtype="i4")), pa.array(np.full(rows, part, dtype="i4")),
             pa.array([r.tobytes() for r in np.ascontiguousarray(made)], pa.binary())], ["row", "part", "line"])

    def add(group):
        group = group.sort_values("part")
        total = np.stack([np.frombuffer(line, dtype="f8") for line in group["line"]]).sum(axis=0)
        return group.iloc[:1].assign(line=[total.tobytes()])
    kind = "row int, part int, line binary"
    first = df.mapInArrow(run, kind).groupBy("row", F.floor(F.col("part") / TOGETHER)).applyInPandas(lambda g: add(g), kind)
    lines = {r.row: np.frombuffer(r.line, dtype="f8") for r in first.groupBy("row").applyInPandas(lambda g: add(g), kind).collect()}
    return np.stack([lines[i] for i in range(rows)]) if lines else np.zeros((rows, width))


def covariance(fit: DataFrame, at: Centre) -> np.ndarray:
    """Covariance of ``fit`` (x), divisor n, centred before multiplying."""
    dims = len(at.sums)

    def make(batches):
        total = np.zeros((dims, dims))
        for x in _blocks(batches, dims):
            y = at.centred(x)
            total += y.T @ y
        return total
    found = _added(fit, dims, dims, make) / at.n
    return (found + found.T) / 2


# The eigenproblem

def _clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Runs of two or more eigenvalues, each within ``near`` of the next."""
    order = np.argsort(values)
    runs = np.split(order, np.nonzero(np.diff(values[order]) > near)[0] + 1)
    return [run for run in runs if len(run) > 1]


def _low(matrix: np.ndarray) -> np.ndarray:
    """Eigenvectors by float32, as columns."""
    scale = np.abs(matrix).max()
    return np.linalg.eigh((matrix / scale if scale > 0 else matrix).astype("f4"))[1]


def _turn(a: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The basis of a cluster turned to eigenvectors of ``a`` within its span."""
    shift = np.einsum("ij,ij->", basis, a @ basis) / basis.shape[1]
    inner = basis.T @ (a @ basis - shift * basis)
    turn = _low((inner + inner.T) / 2).astype(a.dtype)
    for _ in range(3):  # float32 vectors are not orthogonal enough for the next round
        turn = turn + turn @ (np.eye(turn.shape[1], dtype=a.dtype) - turn.T @ turn) / 2
    return basis @ turn


def refined(matrix: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix.

    Starts from float32 and corrects by products in double, then in extended
    precision until the corrections are below it. The largest entry of each vector
    is positive."""
    x = _low(matrix).astype("f8")
    for kind, most, enough in ((np.float64, 3, 1e-13), (np.longdouble, rounds, 1e-18)):
        a, x = matrix.astype(kind), x.astype(kind)
        one, size = np.eye(len(a), dtype=kind), np.sqrt((a * a).sum())
        for _ in range(most):
            r, s = one - x.T @ x, x.T @ (a @ x)
            values = np.diag(s) / (1 - np.diag(r))
            off = s - np.diag(values)
            near = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
            gap = values[None, :] - values[:, None]
            close = np.abs(gap) <= near
            step = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gap))
            x = x + x @ step
            runs = _clusters(values, near)
            for run in runs:
                x[:, run] = _turn(a, x[:, run])
            if np.abs(step).max() < enough and not runs:
                break
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x * np.sign(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])])
    return values[order].astype("f8"), x.astype("f8")


# Whitening

@dataclass(frozen=True)
class Whitener:
    """A fitted transformation: ``values`` and ``vectors`` of the kept components."""

    at: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.at.centred(x) @ self.vectors / np.sqrt(self.values)


def common_length(vectors: DataFrame) -> int:
    """Length of most vectors; 0 if there are none."""
    sizes = vectors.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("dims")).first()
    return first.dims if first else 0


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit ``quantised`` vectors of one length; None if there is nothing to fit."""
    dims = common_length(vectors)
    distinct = cut_lineage(vectors.where(F.size("x") == dims).select("x").distinct())
    at = centre(distinct, dims)
    if not at.n:
        return None
    matrix = covariance(distinct, at)
    values, columns = refined(matrix)
    kept = [i for i in range(min(components, dims)) if values[i] > LEAST * values[0] and values[i] > 0]
    if not kept:
        return None
    found = Whitener(at, values[kept], columns[:, kept], math.fsum(np.diag(matrix)), 0.0)
    return Whitener(at, found.values, found.vectors, found.trace, identity_error(distinct, found))


def identity_error(distinct: DataFrame, whitener: Whitener) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    dims, k = len(whitener.at.sums), len(whitener.values)

    def make(batches):
        total = np.zeros((k + 1, k))
        for x in _blocks(batches, dims):
            w = whitener.apply(x)
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        return total
    sums = _added(distinct, k + 1, k, make) / whitener.at.n
    return float(np.abs(sums[:k] - np.outer(sums[k], sums[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, whitener: Whitener | None) -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation, whitened,
    explained, identity_error. Vectors of another length than the fitted ones are left out."""
    schema = T.StructType([vectors.schema["vec_id"]]).add("component", T.IntegerType()).add("n", T.LongType()).add(
        "deviation", T.LongType()).add("whitened", T.DoubleType()).add("explained", T.DoubleType()).add("identity_error", T.DoubleType())
    if whitener is None:
        return vectors.limit(0).select("vec_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[1:]])
    dims, k = len(whitener.at.sums), len(whitener.values)
    explained = whitener.values / whitener.trace

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            rows = np.repeat(np.arange(len(x)), k)
            deviation = pa.array(whitener.at.deviation(x), pa.int64()).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype="i4"), len(x))),
                pa.array(np.full(len(rows), whitener.at.n)), deviation, pa.array(whitener.apply(x).ravel()),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(len(rows), whitener.identity_error))], schema.names)
    return vectors.where(F.size("x") == dims).mapInArrow(run, schema)
