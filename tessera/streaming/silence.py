"""Silent sources as a stream with timers (T-08); operators/feeds.silence is the batch form."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

OUT = "source string, newest date, silent_from date, seen_on timestamp"

def processor() -> StatefulProcessor:
    """The state machine of a source; made here, so that workers get it by value and need not import the package."""
    epoch, day_ms = date(1970, 1, 1), 86_400_000

    class Silence(StatefulProcessor):
        """State of a source: its newest date and how many days it may be silent. One timer, for the first day on which it counts as silent."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("newest", "day int, most int, due long")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            day, most, due = self.state.get() if self.state.exists() else (None, None, None)
            newest = day
            for batch in rows:
                dated = batch[batch.published.notna()]
                # A date past the day after its own run is no date (P-12).
                dated = dated[pd.to_datetime(dated.published) <= pd.to_datetime(dated.fetched).dt.normalize() + pd.Timedelta(days=1)]
                found = [(d - epoch).days for d in dated.published]
                newest = max([x for x in (newest, *found) if x is not None], default=None)
                most = int(batch.most_days.iloc[-1]) if len(batch) else most
            if newest is not None:
                when = (newest + most + 1) * day_ms
                if when != due:
                    if due is not None and due > timerValues.getCurrentWatermarkInMs():
                        self.handle.deleteTimer(due)
                    # A day that has begun already counts at once, at the next advance of the watermark.
                    self.handle.registerTimer(when)
                self.state.update((newest, most, when))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            newest, most, due = self.state.get()
            if expiredTimerInfo.getExpiryTimeInMs() == due:
                seen = datetime.fromtimestamp(0) + timedelta(milliseconds=timerValues.getCurrentWatermarkInMs())
                yield pd.DataFrame({"source": [key[0]], "newest": [epoch + timedelta(days=newest)], "silent_from": [epoch + timedelta(days=newest + most + 1)], "seen_on": [seen]})

        def close(self) -> None:
            pass

    return Silence()


def silence(stream: DataFrame) -> DataFrame:
    """stream(source, fetched timestamp, published date, most_days int) to a row each time a source falls silent.

    fetched, the moment of the run, drives the watermark: the newest run of any source is today. A source counts as
    silent once its newest date is over most_days old; what it publishes later moves its timer, so that it can fall silent again. The
    state store must be the RocksDB one.
    """
    marked = stream.withWatermark("fetched", "0 seconds")
    return marked.groupBy("source").transformWithStateInPandas(processor(), OUT, "append", "eventTime")


def run(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """What is there now, appended to Parquet under path; goes on where its checkpoint ends."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return silence(stream).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def still_silent(fired: DataFrame, newest: DataFrame) -> DataFrame:
    """fired rows (the stream's output) whose source has published nothing newer: newest(source, newest)."""
    last = fired.groupBy("source").agg(F.max("newest").alias("newest"))
    return last.join(newest, ["source", "newest"])
