"""Operator 5: exact top-k inner products by pivot-table elimination.

The distances of a vector to the pivots (and to the origin, its length) fix its coordinates in the space that the pivots span
and the length of what is outside of it. For a query q and a vector x with coordinates c and outer lengths r,
d(q, x)^2 >= |c(q) - c(x)|^2 + (r(q) - r(x))^2: no greater bound follows from these distances, and it is no less than
|d(q, p) - d(x, p)| for any pivot p. As 2 q.x = |q|^2 + |x|^2 - d(q, x)^2, it bounds their
inner product from above by c(q).c(x) + r(q) r(x). The pivot table holds c and r. There are SHARE of the vectors' width
pivots, the vectors of least hash: far fewer distances leave almost nothing out, as vectors without clusters are about equally far from all pivots.

Vectors are sorted by their nearest pivot inside a partition and cut into blocks; a block's middle and radius bound it as a whole. A
task holds a group of vector blocks and one of query blocks. It visits the blocks in the order of their bounds, then a block's
candidates in the order of theirs, and carries the k-th score on, so that what cannot reach it is never evaluated: the result is exact.
The groups have fixed sizes, so vectors are copied once for each QUERY_GROUP * QUERY_BLOCK
queries of the stated query set, and no task's part grows with the table.

Nulls and empties: vectors that are null or hold null or non-finite components take no
part. Vectors of different lengths are compared as if padded with zeros. Ties go to the smaller vec_id.
A row is no candidate for itself; other rows with its vec_id are. A null vec_id
is a candidate, after the others at ties, and no query. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import materialise, partitions

SHARE = 7 / 8
QUERY_BLOCK, BLOCK = 512, 1024
#: Blocks of a group.
QUERY_GROUP, GROUP = 32, 64
SCALE = 256
EVERY = 50
NONE = np.iinfo(np.int64).max


def whole_numbers(df: DataFrame) -> DataFrame:
    """(vec_id, v array<long>): floor(SCALE * x) of valid vectors."""
    fit = "embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(double(x)) < double('Infinity'))"
    return df.where(fit).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long")).alias("v"))


def _matrix(rows: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


class Pivots:
    """An orthonormal basis of the space that the pivots span."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.p = pivots.astype(np.float64)
        self.basis = np.linalg.qr(self.p.T)[0] if len(pivots) else np.zeros((pivots.shape[1], 0))

    def table(self, x: np.ndarray) -> np.ndarray:
        """Coordinates and outer length of each row of x."""
        y = x.astype(np.float64)
        c = y @ self.basis
        return np.concatenate([c, np.sqrt(np.maximum((y**2).sum(1) - (c**2).sum(1), 0))[:, None]], 1)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return np.argmin((self.p**2).sum(1)[None] - 2 * x.astype(np.float64) @ self.p.T, 1) if len(self.p) else np.zeros(len(x), np.int64)


BLOCKS = "n int, ids binary, rids binary, v binary, t binary"


def _blocks(pivots: Pivots, width: int, size: int):
    """Rows (vec_id, rid, v) to blocks with their part of the pivot table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(2).to_pylist(), width)
            ids = np.array([NONE if i is None else i for i in batch.column(0).to_pylist()], np.int64)
            rids = np.array(batch.column(1).to_pylist(), np.int64)
            by = np.argsort(pivots.nearest(v), kind="stable")
            for at in range(0, len(by), size):
                own = by[at : at + size]
                cols = [pa.array([len(own)], pa.int32()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (ids[own], rids[own], v[own], pivots.table(v[own])))]
                yield pa.RecordBatch.from_arrays(cols, names=["n", "ids", "rids", "v", "t"])

    return run


class Block:
    """Vectors with their names and their part of the pivot table."""

    def __init__(self, ids: np.ndarray, rids: np.ndarray, v: np.ndarray, t: np.ndarray) -> None:
        self.ids, self.rids, self.v, self.t = ids, rids, v, t
        self.middle = t[:, :-1].mean(0)
        self.radius = float(np.sqrt(((t[:, :-1] - self.middle) ** 2).sum(1).max()))
        self.outer = float(t[:, -1].max())


def _safe(bound: np.ndarray) -> np.ndarray:
    return bound + 1e-6 * (1 + np.abs(bound))  # more than rounding takes


def search(q: Block, blocks: list[Block], k: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """(query, vec_id, rid, score) of the k best of the blocks for each query, and how many scores were computed."""
    best: list[list[tuple[int, int, int]]] = [[] for _ in range(len(q.ids))]
    kth, done = np.full(len(q.ids), -np.inf), 0
    length = np.sqrt((q.t[:, :-1] ** 2).sum(1))
    whole = np.stack([_safe(q.t[:, :-1] @ b.middle + length * b.radius + q.t[:, -1] * b.outer + 1e-6 * length * (b.radius + np.linalg.norm(b.middle))) for b in blocks], 1)
    for at in np.argsort(-whole.max(0), kind="stable").tolist():
        b = blocks[at]
        live = np.flatnonzero(whole[:, at] >= kth)
        if not len(live):
            continue
        bound = _safe(q.t[live] @ b.t.T)
        for i, row in zip(live.tolist(), bound):
            left = np.flatnonzero((row >= kth[i]) & (b.rids != q.rids[i]))
            left = left[np.argsort(-row[left], kind="stable")]
            size = 4 * k
            while len(left):
                c, left = left[:size], left[size:]
                score = b.v[c] @ q.v[i]
                done += len(c)
                top = np.lexsort((b.rids[c], b.ids[c], -score))[:k].tolist()
                best[i] = sorted([*best[i], *((-int(score[j]), int(b.ids[c[j]]), int(b.rids[c[j]])) for j in top)])[:k]
                if len(best[i]) == k:
                    kth[i] = -best[i][-1][0]
                left, size = left[row[left] >= kth[i]], size * 4
    return [(i, x, rid, -s) for i, found in enumerate(best) for s, x, rid in found], done


def _group(width: int, k: int):
    """Rows (gi, gj, kind, ids, rids, v, t) in order, kind 0 for vectors and 1 for queries, to the k best of each group for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        long = lambda b: np.frombuffer(b, np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                gi, gj, kind, ids, rids, v, t = (batch.column(c)[at].as_py() for c in range(7))
                one = Block(long(ids), long(rids), long(v).reshape(-1, width), np.frombuffer(t).reshape(len(ids) // 8, -1))
                if (gi, gj) != key:
                    key, held = (gi, gj), []
                if not kind:
                    held.append(one)
                elif held:
                    found, _ = search(one, held, k)
                    cols = list(zip(*((one.rids[i], one.ids[i], x, rid, s) for i, x, rid, s in found))) or [[]] * 5
                    yield pa.RecordBatch.from_arrays([pa.array([int(y) for y in c], pa.int64()) for c in cols], names=["qrid", "query_id", "vec_id", "rid", "score"])

    return run


def top_k(df: DataFrame, k: int = 5, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row whose vec_id is divisible by every."""
    spark = df.sparkSession
    rows = materialise(whole_numbers(df).withColumn("rid", F.monotonically_increasing_id()).select("vec_id", "rid", "v"), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0] or 1
    chosen = rows.groupBy("v").agg(F.xxhash64("v").alias("h")).orderBy("h", "v").limit(max(1, int(SHARE * width))).collect()
    pivots = Pivots(_matrix([r["v"] for r in chosen], width))
    asked = rows.where(F.col("vec_id") % every == 0)
    sides = []
    for side, name, size in ((rows, "pivot-table", BLOCK), (asked.coalesce(max(1, partitions(spark) // 8)), "queries", QUERY_BLOCK)):
        blocks = materialise(side.mapInArrow(_blocks(pivots, width, size), BLOCKS), name)
        sides.append((blocks, blocks.count()))
    (table, tables), (queries, many) = sides
    of = lambda n, size: max(1, -(-n // size))
    gi, gj = of(tables, GROUP), of(many, QUERY_GROUP)
    columns = ["gi", "gj", "kind", "ids", "rids", "v", "t"]
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("rids"), F.lit(n)).cast("int")
    both = table.withColumn("gi", dealt(gi)).withColumn("kind", F.lit(0)).withColumn("gj", copies(gj)).select(*columns)
    both = both.unionByName(queries.withColumn("gj", dealt(gj)).withColumn("kind", F.lit(1)).withColumn("gi", copies(gi)).select(*columns))
    found = both.repartition("gi", "gj").sortWithinPartitions("gi", "gj", "kind").mapInArrow(_group(width, k), "qrid long, query_id long, vec_id long, rid long, score long")
    order = W.partitionBy("qrid").orderBy(F.desc("score"), "vec_id", "rid")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("vec_id") < F.lit(int(NONE)), F.col("vec_id")).alias("vec_id"), "score")


SQL = f"""
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.v, x.v) AS BIGINT) AS score
  FROM valid q JOIN valid x ON q.vec_id % {EVERY} = 0 AND q.vec_id <> x.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
