"""Papers by id, in batches of one request each (S-09, S-10, J-13)."""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import urls as U
from tessera.sources import feeds

API = "https://export.arxiv.org/api/query"
BATCH = 100
NAME, TAGS = "arXiv (id_list API)", ("paper",)
ANSWERS = feeds.BYTES + ", ids array<string>, attempts int"


def answer(ids: list[str], endpoint: str, transport: Callable, delays: tuple[float, ...], timeout: float) -> tuple:
    """(url, status, http_status, detail, data, attempts): one request for all ids, again after each delay while it fails or has no entry.

    An answer without entries is a failure like any other, since a throttled request looks the same.
    """
    url = f"{endpoint}?id_list={','.join(ids)}&max_results={len(ids)}"
    last = ("network_error", None, "no attempt", None)
    for n, delay in enumerate(delays, 1):
        time.sleep(delay)
        last = feeds.fetch(url, timeout, transport)
        if last[0] == "fetched" and b"<entry" in last[3]:
            return url, *last, n
        if last[0] == "fetched":
            last = ("network_error", last[1], "no entries", None)
    return url, *last, len(delays)


def fetch(wanted: DataFrame, endpoint: str = API, transport: Callable = feeds.http, batch: int = BATCH, delays: tuple[float, ...] = feeds.RETRIES, timeout: float = 20) -> DataFrame:
    """wanted(ord, url) to an answer for each batch of at most batch consecutive ords: ANSWERS, name being the batch's number.

    A batch is a row of its own, so a lost task asks again for its own batches alone. Equal ids of a batch are asked for once.
    """
    ids = wanted.select(F.floor(F.col("ord") / batch).alias("b"), U.arxiv_paper_id(F.col("url")).alias("id"))
    rows = ids.groupBy("b").agg(F.array_sort(F.collect_set("id")).alias("ids"))  # at most batch ids

    def run(batches):
        for part in batches:
            for row in part.to_pylist():
                url, status, code, detail, data, n = answer(row["ids"], endpoint, transport, delays, timeout)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((str(row["b"]), pa.string()), (url, pa.string()), (status, pa.string()), (code, pa.int32()), (detail, pa.string()), (data, pa.binary()), (row["ids"], pa.list_(pa.string())), (n, pa.int32()))],
                                                 names=["name", "url", "status", "http_status", "detail", "data", "ids", "attempts"])

    return rows.mapInArrow(run, ANSWERS)


def items(answers: DataFrame) -> DataFrame:
    """Answers to items (url, title, body, published_at, source_name, tags), a row a paper."""
    spark = answers.sparkSession
    meta = spark.createDataFrame([], "name string, tags array<string>, naive_date_offset string")
    found = feeds.items(feeds.results(answers.select("name", "url", "status", "http_status", "detail", "data"), meta))
    return found.select("url", "title", "body", "published_at", F.lit(NAME).alias("source_name"), F.array(*[F.lit(t) for t in TAGS]).alias("tags"))


def outcome(wanted: DataFrame, answers: DataFrame) -> DataFrame:
    """wanted(ord, url) with paper_id, its batch's status and attempts, and the item, null where the answer leaves it out; in the order of ord."""
    by_id = items(answers).withColumn("paper_id", U.arxiv_paper_id(F.col("url"))).drop("url").dropDuplicates(["paper_id"])
    batches = answers.select("status", "attempts", F.explode("ids").alias("paper_id")).groupBy("paper_id").agg(F.min("status").alias("status"), F.max("attempts").alias("attempts"))
    return wanted.withColumn("paper_id", U.arxiv_paper_id(F.col("url"))).join(batches, "paper_id", "left").join(by_id, "paper_id", "left").orderBy("ord")
