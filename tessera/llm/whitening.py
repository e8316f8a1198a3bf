"""Operator 12: whitening of embeddings by merged moments.

Each partition computes count, local mean and centred scatter of its vectors,
batch by batch; the pairwise formula of Chan, Golub and LeVeque merges them in
treeReduce, so a mean is taken off before anything is multiplied and no sum of squares of large numbers is
formed. The driver gets one d x d matrix and its eigenvectors (eigh). A second pass over the
whitened vectors computes their covariance in the same way, which must be the
identity; a third returns them.

Vectors are fixed-point: an entry c becomes the long x = floor(64 c) + 1000000. Means, scatters and
projections work on x - 1000000, which leaves them as they are; sums and deviations are
exact integers.

Nulls and empties: a row takes no part if its vector is null, empty, holds a null or non-finite
entry, or has another length than most rows that are left (the shortest of the most frequent lengths). Entries past
2^49 / 64 count as that. Rows may repeat, each is fitted and returned; a null vec_id is kept.
Components whose eigenvalue is not above 1e-12 of the greatest have no whitened
form and are left out, so one row, or equal rows, give an empty result, as does an empty table. deviation is
null where it exceeds a long. Extra columns are ignored. Memory: a task holds one batch and d x d numbers; d is the
vectors' width.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Rows at a time, and the bound of an entry: their sums stay within int64.
ROWS, BOUND = 4096, 1 << 49
#: Least eigenvalue, as a share of the greatest.
LEAST = 1e-12

OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Moments:
    """n vectors: exact sums of their entries (Python integers, or None), mean and centred scatter."""

    n: int
    total: np.ndarray | None
    mean: np.ndarray
    scatter: np.ndarray


def moments(rows: np.ndarray, exact: bool = True) -> Moments:
    """Of a matrix, a vector a row."""
    mean = rows.mean(axis=0, dtype=np.float64)
    centred = rows - mean
    return Moments(len(rows), rows.sum(axis=0).astype(object) if exact else None, mean, centred.T @ centred)


def merge(a: Moments, b: Moments) -> Moments:
    """The moments of both sets together."""
    if not a.n or not b.n:
        return a if a.n else b
    n = a.n + b.n
    gap = b.mean - a.mean
    total = None if a.total is None else a.total + b.total
    return Moments(n, total, a.mean + gap * (b.n / n), a.scatter + b.scatter + np.outer(gap, gap) * (a.n * (b.n / n)))


def fixed(column: pa.ListArray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, x - SHIFT as int64) of parts of a column of vectors without nulls."""
    for at in range(0, len(column), ROWS):
        part = column.slice(at, ROWS)
        c = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
        with np.errstate(over="ignore"):
            yield at, np.clip(np.floor(SCALE * c), -BOUND, BOUND).astype(np.int64)


@dataclass(frozen=True)
class Whitener:
    """What the driver learns: n, exact sums of x - SHIFT, mean, columns that project and scale, shares of the variance."""

    n: int
    total: tuple[int, ...]
    mean: np.ndarray
    project: np.ndarray
    explained: np.ndarray

    def apply(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.mean) @ self.project

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exactly; null past a long."""
        far = np.abs(rows * float(self.n) - np.array(self.total, dtype=np.float64)).max(initial=0.0)
        if far * far * rows.shape[1] < 2.0**62 and self.n * float(np.abs(rows).max(initial=0)) < 2.0**62:
            gap = rows * self.n - np.array(self.total, dtype=np.int64)
            return (gap * gap).sum(axis=1).tolist()
        gap = rows.astype(object) * self.n - np.array(self.total, dtype=object)
        found = (gap * gap).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in found]


def usable(table: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v) of rows whose vector takes part, but for its length."""
    v = F.col(column)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.select("vec_id", v.alias("v")).where(v.isNotNull() & (F.size(v) > 0) & sound)


def width_of(rows: DataFrame) -> int | None:
    """The most frequent length, the shortest of several; None without rows. Only lengths and counts are shuffled."""
    found = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return found[0].d if found else None


def gather(rows: DataFrame, width: int, by: Whitener | None = None) -> Moments:
    """Moments of all vectors, or of their whitened form: one record a partition, merged in treeReduce."""
    def local(batches):
        seen = None
        for batch in batches:
            for _, x in fixed(batch.column(0), width):
                got = moments(x) if by is None else moments(by.apply(x), exact=False)
                seen = got if seen is None else merge(seen, got)
        if seen is not None:
            total = None if seen.total is None else " ".join(map(str, seen.total))
            yield pa.RecordBatch.from_pydict({"n": [seen.n], "total": pa.array([total], pa.string()), "mean": [seen.mean.tobytes()], "scatter": [seen.scatter.tobytes()]})

    def record(r) -> Moments:
        mean = np.frombuffer(r.mean)
        total = None if r.total is None else np.array([int(t) for t in r.total.split()], dtype=object)
        return Moments(r.n, total, mean, np.frombuffer(r.scatter).reshape(len(mean), len(mean)))

    parts = rows.select("v").mapInArrow(local, "n long, total string, mean binary, scatter binary")
    return parts.rdd.map(record).treeReduce(merge)


def learn(rows: DataFrame, width: int, components: int = COMPONENTS) -> Whitener:
    """Fit on all rows(v) of that width."""
    got = gather(rows, width)
    values, vectors = np.linalg.eigh(got.scatter / got.n)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = np.flatnonzero(values > max(values[0], 0.0) * LEAST)[:components]
    # An eigenvector's sign is free: its largest entry is positive.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(width)])
    mean = np.array([t / got.n for t in got.total], dtype=np.float64)
    trace = float(np.trace(got.scatter / got.n))
    return Whitener(got.n, tuple(got.total), mean, vectors[:, keep] / np.sqrt(values[keep]), values[keep] / trace if trace > 0 else values[keep])


def identity_error(rows: DataFrame, width: int, by: Whitener) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over all rows."""
    k = by.project.shape[1]
    if not k:
        return 0.0
    got = gather(rows, width, by)
    return float(np.abs(got.scatter / got.n - np.eye(k)).max())


def whiten(table: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, embedding) to one row for each vector and component."""
    spark = table.sparkSession
    rows = usable(table, column)
    width = width_of(rows)
    if width is None:
        return spark.createDataFrame([], OUT)
    rows = rows.where(F.size("v") == width)
    by = learn(rows, width, components)
    error = identity_error(rows, width, by)
    k = by.project.shape[1]

    def emit(batches):
        for batch in batches:
            ids = batch.column(0)
            for at, x in fixed(batch.column(1), width):
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, m).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, by.n)), pa.array(by.deviations(x), pa.int64()).take(each),
                    pa.array(by.apply(x).reshape(-1)), pa.array(np.tile(by.explained, m)), pa.array(np.full(m * k, error))], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "v").mapInArrow(emit, OUT)
