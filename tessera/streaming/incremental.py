"""Incremental twins on Structured Streaming (T-01, T-05, T-08..T-10). The batch forms in operators/ define the results.

The admission window has a high-water mark for each source, which a stream's one watermark
cannot hold, so micro-batches run the batch operators against keyed tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.sources.tables import KeyedTable


def ingest(stream: DataFrame, ledger: KeyedTable, checkpoint: str, key: str = "doc_id", order: str = "feed_ord", then: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Put each item that the ledger does not know into it once; replayed batches add nothing. then: called with the new rows of each batch.

    The first row of a key in a batch wins.
    """
    def batch(df: DataFrame, _: int) -> None:
        from pyspark.sql import Window as W

        first = df.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(order))).where("_r = 1").drop("_r")
        new = first.join(ledger.read().select(key), key, "left_anti").persist()
        try:
            if not new.isEmpty():
                if then:
                    then(new)
                ledger.put_new(new)
        finally:
            new.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


STREAK = "key string, run long, consecutive int, first_seen long"


def streaks(stream: DataFrame) -> DataFrame:
    """Streaming alert streaks: events(key, run, hit) with a row for each evaluated run of a key; hit false closes the streak.

    State of a key: the streak's length and first run.
    """
    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, first = state.get if state.exists else (0, 0)
        out = []
        for r in sorted((x for b in batches for x in b.itertuples(index=False)), key=lambda r: r.run):
            if r.hit:
                n, first = n + 1, first if n else r.run
                out.append((key[0], r.run, n, first))
            else:
                n, first = 0, 0
        state.update((n, first))
        yield pd.DataFrame(out, columns=["key", "run", "consecutive", "first_seen"])

    return stream.groupBy("key").applyInPandasWithState(step, STREAK, "n int, first long", "append", "NoTimeout")


def counts(stream: DataFrame, moment: str, key: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events a window and key with a watermark; rows later than late are dropped. An extra of the engine, no operator of the model."""
    return stream.withWatermark(moment, late).groupBy(F.window(moment, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def files(spark: SparkSession, path: str, schema: str, kind: str = "parquet", most: int = 100) -> DataFrame:
    """A stream of a folder's files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most).format(kind).load(path)
