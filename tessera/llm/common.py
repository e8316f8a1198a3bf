"""Shared pieces: the shared folder, materialised tables, ordered buckets."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


#: Rows of a file of a narrow table, about.
FILE_ROWS = 50_000


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application in the one that driver and executors share, spark.checkpoint.dir. Where that is unset, a temporary one on a local master, and an error on a cluster, whose machines do not share such a folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = _own.get(app) or _own.setdefault(app, "file://" + tempfile.mkdtemp(prefix="tessera-"))
    return f"{found.rstrip('/')}/{app}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path by the file system that it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def clean_up(spark: SparkSession) -> None:
    """Delete the tables that this application materialised. Results that are not written yet read them: call this after that."""
    remove(spark, shared_dir(spark))


def materialise(df: DataFrame, name: str, codec: str = "zstd", rows: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    This cuts the lineage: what follows survives lost executors without
    computing the rows again, and several readers share one computation.
    rows: about how many narrow rows there are at most, so that they are not written as many small files.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str, rows: int | None = None) -> tuple[DataFrame, int]:
    """materialise(), and the number of rows, counted as they are written."""
    seen = Observation()
    found = materialise(df.observe(seen, F.count(F.lit(1)).alias("n")), name, rows=rows)
    return found, seen.get["n"]


def whole(df: DataFrame) -> Column:
    """All columns of df as one struct, so that helper columns beside it clash with none of them; select("doc.*") gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def slices(batch: pa.RecordBatch, column: int, rows: int = 512, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, in order, of at most rows rows and about size bytes of that text column, a row at least: a worker makes Python values of one part at a time."""
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    end = np.cumsum(length)
    at = 0
    while at < batch.num_rows:
        done = int(end[at - 1]) if at else 0
        to = max(at + 1, min(at + rows, int(np.searchsorted(end, done + size, side="right"))))
        yield batch.slice(at, to - at)
        at = to


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: Column) -> Column:
    """Number of maximal runs of anything but \\x20 and \\x09-\\x0D; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, keys: list[str], bucket: str, order: list, value: Column, out: str, rank: str | None = None) -> DataFrame:
    """Exclusive running sum of value within keys, in the order (bucket, *order), without one task per key.

    Rows are summed per (keys, bucket) before anything is shuffled by key, the
    few bucket sums get their offsets, and a window runs inside each bucket.
    rank: also the exclusive running count, under that name.
    """
    from pyspark.sql import Window as W

    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    over = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1) if keys else W.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(bucket).alias("_b"),
                          F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_off"), F.coalesce(F.sum("_rows").over(over), F.lit(0)).alias("_roff"))
    on = F.col(bucket).eqNullSafe(F.col("_b"))
    for i, k in enumerate(keys):
        on &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = W.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    got = df.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    if rank:
        got = got.withColumn("_rin", F.count(F.lit(1)).over(inside))
    got = got.join(offsets, on, "left").withColumn(out, F.col("_in") + F.col("_off"))
    if rank:
        got = got.withColumn(rank, F.col("_rin") + F.col("_roff"))
    return got.drop("_in", "_off", "_roff", "_rin", "_b", *[f"_k{i}" for i in range(len(keys))])
