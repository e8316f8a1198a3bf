"""Numbered lines of text files that are read in byte ranges (S-13, S-17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value), line from 1, of each text file under path; blank lines count.

    Spark cuts a file into byte ranges of spark.sql.files.maxPartitionBytes that begin at line starts; lines are
    numbered inside a range as they are read, and a range begins where the line counts of the ranges before it
    in its file add up to. Only those counts, a row a range, are ordered and broadcast; no task reads a whole file.
    """
    at = F.monotonically_increasing_id()  # grows in the order in which a range is read
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_at"), at.alias("_id"), "value")
    ranges = lines.groupBy("file", "_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("file").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = ranges.select("file", "_at", (before - F.col("_first")).alias("_shift"))
    # A row a byte range: 8,000 for a TB at the default size.
    return lines.join(F.broadcast(starts), ["file", "_at"]).select("file", (F.col("_id") + F.col("_shift") + 1).alias("line"), "value")


def read_keyed(spark: SparkSession, path: str, schema: str, key: str = "item_id") -> DataFrame:
    """(file, line, record, error): each line that is not blank, as a struct of schema; error says why there is none."""
    from pyspark.sql.types import StructType

    kind = StructType([*StructType.fromDDL(schema).fields, *StructType.fromDDL("_bad string").fields])
    got = numbered(spark, path).where(F.trim("value") != "").withColumn("_r", F.from_json("value", kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    fields = [F.col(f"_r.`{f.name}`").alias(f.name) for f in StructType.fromDDL(schema).fields]
    error = F.when(F.col("_r").isNull() | F.col("_r._bad").isNotNull(), "not a JSON object of the schema").when(F.col(f"_r.`{key}`").isNull(), f"no {key}")
    return got.withColumn("error", error).select("file", "line", F.when(F.col("error").isNull(), F.struct(*fields)).alias("record"), "error")
