"""A whole run over feed items: state, admission, gate, extraction, loading, report (O-01..O-03, M-01..M-09, T-10).

Model outputs enter as tables keyed by doc_id, or through a client called in
mapInPandas whose rows are written before anything is derived from them, so that no recomputation calls a model twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import urls as U
from tessera.operators import feeds, flow
from tessera.sources.tables import KeyedTable

LEDGER = "doc_id string, source_name string, gate_key string, is_relevant boolean, gate_error string, extract_failures int, quarantined boolean, load_status string, updated_at string"
STORE = "doc_id string, source_name string, url string, title string, body string, published_at date, model string, attempts int, release_type string, impact int, stored_at string"


@dataclass(frozen=True)
class Limits:
    gate: int = 20
    extract: int = 10
    gate_ceiling: int = 200
    extract_ceiling: int = 100


def call_model(items: DataFrame, client: Callable[[dict], dict], schema: str, path: str) -> DataFrame:
    """client(item) -> row, once an item; the rows are on disk before they are used (M-01, M-02, M-07)."""
    import pandas as pd

    def run(batches):
        for df in batches:
            yield pd.DataFrame([client(r) for r in df.to_dict("records")]) if len(df) else pd.DataFrame([client({})][:0])

    items.mapInPandas(run, schema).write.mode("overwrite").parquet(path)
    return items.sparkSession.read.schema(schema).parquet(path)


def run(items: DataFrame, ledger: KeyedTable, store: KeyedTable, gate: Callable[[DataFrame], DataFrame], extract: Callable[[DataFrame], DataFrame], today: Column, cutoff: Column, gate_key: str, now: str, limits: Limits = Limits()) -> dict[str, DataFrame]:
    """items(url, title, body, source_name, feed_ord, published_at). gate(df) gives (doc_id, is_relevant, error); extract(df) gives (doc_id, model, attempts, release_type, impact, error).

    Returns items with what became of them, and the tallies. A second run on the same items makes no calls and writes nothing new.
    """
    keyed = feeds.first_of_each(items.withColumn("doc_id", U.doc_id(F.col("url"))), "doc_id", "source_name", "feed_ord")
    old = ledger.read().drop("source_name")
    state = flow.with_state(keyed, old, store.read())
    verdict = flow.valid_verdict(F.col("gate_key"), F.lit(gate_key), F.col("is_relevant"))
    state = state.withColumn("state", flow.item_state(F.col("stored"), F.col("in_ledger"), F.col("quarantined"), verdict))
    state = flow.admission(state, ["source_name"], "published_at", "feed_ord", today, cutoff, known=F.col("in_ledger") | F.col("stored"))
    open_ = (F.col("state") == "needs_gate") & F.col("admission").isin("known", "in_window", "undated_admitted")
    asked = flow.quota(state, open_, "source_name", ["feed_ord", "doc_id"], F.lit(limits.gate), limits.gate_ceiling).withColumnRenamed("granted", "gate_granted").withColumnRenamed("deferred", "gate_deferred").persist()
    base = ["doc_id", "source_name", "url", "title", "body", "published_at", "feed_ord"]

    verdicts = gate(asked.where("gate_granted").select(*base))
    entries = asked.where("gate_granted").join(verdicts.select("doc_id", F.col("is_relevant").alias("_rel"), F.col("error").alias("_err")), "doc_id")
    ledger.upsert(entries.select("doc_id", "source_name", F.when(F.col("_err").isNull(), F.lit(gate_key)).alias("gate_key"), F.col("_rel").alias("is_relevant"), F.col("_err").alias("gate_error"), F.coalesce("extract_failures", F.lit(0)).alias("extract_failures"), F.coalesce("quarantined", F.lit(False)).alias("quarantined"), F.col("load_status"), F.lit(now).alias("updated_at")))

    passed = verdicts.where("is_relevant and error is null").select("doc_id", F.lit(True).alias("_passed"))
    wants = asked.join(passed, "doc_id", "left").withColumn("_want", (F.col("state") == "needs_extraction") | F.coalesce("_passed", F.lit(False)))
    chosen = flow.quota(wants, F.col("_want"), "source_name", ["feed_ord", "doc_id"], F.lit(limits.extract), limits.extract_ceiling)
    chosen = chosen.withColumnRenamed("granted", "extract_granted").withColumnRenamed("deferred", "extract_deferred").drop("_want", "_passed").persist()
    made = extract(chosen.where("extract_granted").select(*base))
    good = chosen.join(made.where("error is null").select("doc_id", "model", "attempts", "release_type", "impact"), "doc_id")
    store.put_new(good.withColumn("stored_at", F.lit(now)))
    failed = made.where("error = 'schema'").select("doc_id", F.lit(1).alias("_f"))
    hit = ledger.read().join(failed, "doc_id").withColumn("extract_failures", F.coalesce("extract_failures", F.lit(0)) + F.col("_f"))
    ledger.upsert(hit.withColumn("quarantined", F.col("extract_failures") >= 2).withColumn("updated_at", F.lit(now)))

    tallies = chosen.groupBy("source_name", "state", "admission").agg(F.count(F.lit(1)).alias("n"), F.count_if("gate_granted").alias("gate_calls"), F.count_if("gate_deferred").alias("gate_deferred"), F.count_if("extract_granted").alias("extract_calls"), F.count_if("extract_deferred").alias("extract_deferred"), F.sum("duplicates").alias("duplicates"))
    return {"items": chosen, "tallies": tallies}


def to_load(ledger: KeyedTable, store: KeyedTable, notes: DataFrame, policy: str = "skip", rewrite: bool = False) -> DataFrame:
    """Ledger rows with an extraction, their note (doc_id, path) and what loading does with them; no model is called (J-03, O-03)."""
    ready = ledger.read().join(store.read().select("doc_id", "url", "title"), "doc_id").join(notes, "doc_id", "left")
    return ready.withColumn("action", flow.load_action(F.col("path").isNotNull(), F.lit(policy), F.col("load_status"), F.lit(rewrite), F.lit(False)))
