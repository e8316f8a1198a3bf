"""A reported run: windows from history, admission, gate, extraction, backlog, loading, quality, report, marks
(O-01..O-03, S-30, A-02, A-04, A-05, J-03, J-14, W-05, W-09, W-11, T-02, T-06, M-07).

Tallies are counted by source from a stage's table once it is written, so there may be any number of sources. The report is
written whatever happens; a run that fails before its sources are through leaves no windows, so no mark moves.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions import urls as U
from tessera.operators import calls, feeds, flow, usage
from tessera.plans.daily import to_load
from tessera.sources import history as H
from tessera.sources.tables import KeyedTable
from tessera.vocab import EXTRACT_CEILING, GATE_CEILING, UNDATED_MAX

VERDICT = "is_relevant boolean, reason string"
EXTRACTION = "model string, release_type string, impact int, companies array<struct<canonical:string,resolved:boolean>>, prior_art array<string>"
SOURCE_FAILURES = ("source_error", "stale_feed")
FAILURES = (*SOURCE_FAILURES, "gate_error", "extract_schema_failed", "extract_transport_error")
TEXTS = ("url", "title", "body")
#: The cutoff of a run without windows.
OPEN = date(1000, 1, 1)


def _object(response: str) -> dict:
    try:
        found = json.loads(response)
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def is_verdict(response: str) -> bool:
    return isinstance(_object(response).get("is_relevant"), bool)


def is_record(response: str) -> bool:
    found = _object(response)
    return isinstance(found.get("release_type"), str) and found.get("impact") in (1, 2, 3, 4, 5)


@dataclass(frozen=True)
class Source:
    """A configured source with limits; without limits it takes no part in a run."""

    name: str
    gate: int = 20
    extract: int = 10
    max_silence_days: int | None = None
    feed_kind: str = "stream"


@dataclass(frozen=True)
class Inputs:
    """items(source_name, url, title, body, published_at, feed_ord), fetches(source_name, status, detail, depth_hours), notes(doc_id, path)."""

    items: DataFrame
    fetches: DataFrame
    notes: DataFrame


@dataclass(frozen=True)
class Places:
    """Tables that a run reads and writes; work is a folder of this run's own."""

    ledger: KeyedTable
    store: KeyedTable
    marks: H.Marks
    work: str


@dataclass(frozen=True)
class Rules:
    """gate_key: prompt and model that verdicts hold for. window: None admits every date. breaker: one streak for a stage, as calls of all sources come one after another, or one for each source. gate_most, extract_most: calls of the whole run, beside the limits of its sources."""

    gate_key: str
    today: date
    now: str
    window: bool = True
    breaker: str = "stage"
    undated: int = UNDATED_MAX
    policy: str = "skip"
    rewrite: bool = False
    gate_most: int = GATE_CEILING
    extract_most: int = EXTRACT_CEILING


class Tallies:
    """Counts by source of the tables that a run writes. The driver gets a row a source."""

    def __init__(self, sources: list[str]) -> None:
        self.counts = {s: {} for s in sources}

    def write(self, df: DataFrame, path: str, conditions: dict[str, Column]) -> DataFrame:
        """Write df(source_name, ...) and read it back; how many rows of each source meet each condition is added to the counts."""
        df.write.mode("overwrite").parquet(path)
        back = df.sparkSession.read.schema(df.schema).parquet(path)
        for r in back.groupBy("source_name").agg(*[F.count_if(c).alias(n) for n, c in conditions.items()]).collect():
            for n in conditions:
                self.add(r.source_name, n, r[n])
        return back

    def add(self, source: str, name: str, n: int) -> None:
        if n:
            self.counts[source][name] = self.counts[source].get(name, 0) + n

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(s, c) for s, c in self.counts.items()]
        return spark.createDataFrame(rows, "source_name string, tally map<string,bigint>")


@dataclass
class Report:
    """What is known of a run so far."""

    run_id: str
    started_at: str
    tallies: Tallies
    fetch: dict = field(default_factory=dict)
    window: dict = field(default_factory=dict)
    backlog: dict = field(default_factory=dict)
    load: dict = field(default_factory=dict)
    stale: list = field(default_factory=list)
    tripped: list = field(default_factory=list)
    extracted: dict = field(default_factory=dict)
    quality: dict = field(default_factory=dict)
    error: str | None = None

    def row(self, spark: SparkSession, finished: str) -> DataFrame:
        """The report as one row of REPORT; failures, produced, healthy and exit_code follow from the tallies."""
        count = lambda names: sum(t.get(n, 0) for t in self.tallies.counts.values() for n in names)
        failures, of_sources = count(FAILURES) + self.load.get("failed", 0), count(SOURCE_FAILURES)
        produced = count(["extracted"]) + self.load.get("written", 0)
        healthy = sum(1 for s, f in self.fetch.items() if f["status"] in ("ok", "empty") and not self.tallies.counts[s].get("stale_feed"))
        kind = StructType.fromDDL(H.REPORT)
        given = {"run_id": self.run_id, "started_at": self.started_at, "finished_at": finished, "sources": self.tallies.counts, "fetch": self.fetch, "window": self.window, "backlog": self.backlog, "load": self.load, "stale": self.stale,
                 "breaker_tripped": self.tripped, "extracted_ids": self.extracted, "quality": self.quality, "error": self.error, "failures": failures, "produced": produced, "healthy": healthy, "exit_code": None}
        df = spark.createDataFrame([Row(**{f: given[f] for f in kind.names})], kind)
        code = flow.exit_code(F.col("failures"), F.col("produced"), F.lit(failures == of_sources), F.col("healthy"))
        return df.withColumn("exit_code", F.when(F.col("error").isNotNull(), 1).otherwise(code).cast("int"))


def _said(e: Exception) -> str:
    """An error in one line; of one raised in a worker, what the worker raised."""
    raised = re.findall(r"^[A-Za-z_][\w.]*: .*$", str(e), re.M) if type(e).__name__ == "PythonException" else []
    return (raised[-1] if raised else f"{type(e).__name__}: {e}")[:500]


def _ids(df: DataFrame, condition: Column) -> dict[str, list[str]]:
    """Ids of each source that meet the condition, in feed order; they go into the report."""
    rows = df.where(condition).groupBy("source_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("feed_ord", "doc_id"))), lambda x: x.doc_id).alias("ids")).collect()
    return {r.source_name: r.ids for r in rows}


def run(spark: SparkSession, run_id: str, sources: list[Source], inputs: Inputs, places: Places, rules: Rules, gate: calls.Client, extract: calls.Client, write_notes: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """One run; returns its report. gate and extract answer with JSON of VERDICT and EXTRACTION; an answer of another form is asked for once more within its call.

    A second run on the same items makes no calls and writes nothing new.
    """
    report = Report(run_id, rules.now, Tallies([s.name for s in sources]))
    try:
        _stages(spark, report, sources, inputs, places, rules, gate, extract)
        _load(report, inputs, places, rules, write_notes)
    except Exception as e:
        report.error = _said(e)
        raise
    finally:
        H.write_report(report.row(spark, rules.now), places.marks.history, run_id)
        if report.error is None:
            places.marks.settle()
    return H.read_runs(spark, places.marks.history, [run_id])


def _fetched(spark: SparkSession, report: Report, sources: list[Source], inputs: Inputs, rules: Rules) -> DataFrame:
    """Items of the sources that were fetched; outcomes and silence go into the report."""
    tallies, by_name = report.tallies, {s.name: s for s in sources}
    every = spark.createDataFrame([(n,) for n in by_name], "source_name string")
    outcome = {r.source_name: r for r in inputs.fetches.join(F.broadcast(every), "source_name", "left_semi").collect()}  # a row a source
    ok = {n for n in by_name if n in outcome and outcome[n].status in ("ok", "empty")}
    limit = spark.createDataFrame([(n, i, s.gate, s.extract, s.max_silence_days) for i, (n, s) in enumerate(by_name.items()) if n in ok], "source_name string, source_ord int, gate_limit int, extract_limit int, most_days int")
    today = F.lit(rules.today)
    known = inputs.items.join(F.broadcast(limit), "source_name")  # a row a configured source
    silent = {r.source_name: r for r in feeds.silence(known.where("most_days is not null"), ["source_name", "most_days"], "published_at", today, F.col("most_days")).collect()}
    for n, s in by_name.items():
        got = outcome.get(n)
        quiet = silent.get(n)
        report.fetch[n] = {"status": got.status if got else "network_error", "detail": got.detail if got else "not fetched", "feed_kind": s.feed_kind, "depth_hours": got.depth_hours if got else None,
                           "silent": quiet and {"newest": str(quiet.newest), "age_days": quiet.age_days, "max_silence_days": quiet.most_days}}
        tallies.add(n, "source_error", int(n not in ok))
        tallies.add(n, "stale_feed", int(quiet is not None))
    return known.withColumn("doc_id", U.doc_id(F.col("url")))


def _stages(spark: SparkSession, report: Report, sources: list[Source], inputs: Inputs, places: Places, rules: Rules, gate: calls.Client, extract: calls.Client) -> None:
    tallies, work, today = report.tallies, places.work, F.lit(rules.today)
    fetched = _fetched(spark, report, sources, inputs, rules).withColumn("_row", F.monotonically_increasing_id())
    feed = tallies.write(fetched, f"{work}/feed", {"collected": F.lit(True)})
    names = [s.name for s in sources if report.fetch[s.name]["status"] in ("ok", "empty")]

    # Windows, from the newest reports that settle them.
    past = H.windows(spark, places.marks.history, names, today).rows if rules.window else None
    every = spark.createDataFrame([(n,) for n in names], "source_name string")
    if past is not None:
        marks = every.join(past.withColumnRenamed("source", "source_name"), "source_name", "left")
        seen = F.coalesce("seen", F.lit(False))
        bounds = flow.window_bounds(today, flow.anchor(F.col("drained_on"), today), seen, F.col("carry"))
        windows = marks.select("source_name", "drained_on", "carry", seen.alias("seen"), bounds.alias("b")).persist()
    else:
        windows = every.select("source_name", F.lit(None).cast("struct<cutoff:date,span_days:int,capped:boolean>").alias("b"))

    # Where each item stands. Texts stay in the feed's table: stages carry its row numbers, and calls look their own texts up.
    first = feeds.first_of_each(feed.drop(*TEXTS), "doc_id", "source_ord", "feed_ord").drop("duplicates")
    state = flow.with_state(first, places.ledger.read().drop("source_name"), places.store.read())
    state = state.withColumn("state", flow.item_state(F.col("stored"), F.col("in_ledger"), F.col("quarantined"), flow.valid_verdict(F.col("gate_key"), F.lit(rules.gate_key), F.col("is_relevant"))))
    state = state.join(windows.select("source_name", F.coalesce("b.cutoff", F.lit(OPEN)).alias("cutoff")), "source_name")
    state = flow.admission(state, ["source_name"], "published_at", "feed_ord", today, F.col("cutoff"), known=F.col("in_ledger") | F.col("stored"), most=rules.undated if rules.window else 1 << 30)
    refused = (F.col("state") == "needs_gate") & F.col("admission").isin("out_of_window", "undated_deferred")
    state = state.withColumn("refused", refused).withColumn("src", F.format_string("%010d|%s", "source_ord", "source_name"))
    ceiling = lambda kind, most: min(most, sum(getattr(s, kind) for s in sources))
    asked = flow.quota(state, (F.col("state") == "needs_gate") & ~F.col("refused"), "src", ["feed_ord", "doc_id"], F.col("gate_limit"), ceiling("gate", rules.gate_most))
    asked = asked.withColumnsRenamed({"granted": "gate_granted", "deferred": "gate_deferred"})
    is_ = lambda c, v: F.col(c) == v
    asked = tallies.write(asked, f"{work}/asked", {
        "kept": F.lit(True), **{s: is_("state", s) for s in ("stored", "stored_outside_pipeline", "quarantined", "gate_skipped")},
        "out_of_window": F.col("refused") & is_("admission", "out_of_window"), "undated_deferred": F.col("refused") & is_("admission", "undated_deferred"),
        "undated_admitted": is_("state", "needs_gate") & is_("admission", "undated_admitted") & F.lit(rules.window), "deferred_gate": F.col("gate_deferred")})
    for n, t in tallies.counts.items():
        kept = t.pop("kept", 0)
        tallies.add(n, "duplicate_in_run", t.get("collected", 0) - kept)

    base = ["doc_id", "source_name", "url", "title", "body", "published_at", "feed_ord", "src"]
    group = ["stage"] if rules.breaker == "stage" else ["stage", "source_name"]

    def with_texts(rows: DataFrame) -> DataFrame:
        """Rows of calls with their texts; the ceilings bound the broadcast."""
        return feed.select("_row", *TEXTS).join(F.broadcast(rows), "_row")

    def call(rows: DataFrame, stage: str, client: calls.Client, schema: str, fits: Callable[[str], bool]) -> DataFrame:
        """(doc_id, outcome, value, error, attempts) of the granted rows, in the order of the run."""
        got = calls.guarded(with_texts(rows).select(*base, F.lit(stage).alias("stage")), client, group, ["src", "feed_ord", "doc_id"], "doc_id", f"{work}/{stage}", fits=fits, corrections=1)
        if calls.tripped(got, group).where("tripped").limit(1).count():
            report.tripped.append(stage)
        return got.select("doc_id", "outcome", F.when(F.col("outcome") == "ok", F.from_json("response", schema)).alias("value"), "error", "attempts")

    # Gate.
    verdicts = call(asked.where("gate_granted"), "relevance_gate", gate, VERDICT, is_verdict)
    gated = asked.drop("gate_error").join(verdicts.drop("attempts").withColumnsRenamed({"outcome": "gate_outcome", "value": "verdict", "error": "gate_error"}), "doc_id", "left")
    passed, made = F.coalesce(F.col("verdict.is_relevant"), F.lit(False)) & is_("gate_outcome", "ok"), F.col("gate_outcome").isin(*calls.OUTCOMES)
    gated = tallies.write(gated, f"{work}/gated", {"gate_calls": made, "gate_error": F.col("gate_outcome").isin("schema", "transport"), "gate_passed": passed, "gate_skipped_now": is_("gate_outcome", "ok") & ~passed, "deferred_gate": is_("gate_outcome", "left")})
    kept = lambda c, default: F.coalesce(c, F.lit(default)).alias(c)
    fine = is_("gate_outcome", "ok")
    places.ledger.upsert(gated.where(made).select("doc_id", "source_name", F.when(fine, F.lit(rules.gate_key)).otherwise(F.col("gate_key")).alias("gate_key"), F.when(fine, F.col("verdict.is_relevant")).otherwise(F.col("is_relevant")).alias("is_relevant"),
                                                  "gate_error", kept("extract_failures", 0), kept("quarantined", False), "load_status", F.lit(rules.now).alias("updated_at")))

    # Extraction.
    wants = flow.quota(gated, F.coalesce(is_("state", "needs_extraction") | passed, F.lit(False)), "src", ["feed_ord", "doc_id"], F.col("extract_limit"), ceiling("extract", rules.extract_most))
    wants = wants.withColumnsRenamed({"granted": "extract_granted", "deferred": "extract_deferred"})
    made_of = call(wants.where("extract_granted"), "extraction", extract, EXTRACTION, is_record)
    done = wants.join(made_of.withColumnsRenamed({"outcome": "extract_outcome", "value": "record", "error": "extract_error", "attempts": "extract_attempts"}), "doc_id", "left")
    broken = is_("extract_outcome", "schema")
    done = done.withColumn("_failures", F.coalesce("extract_failures", F.lit(0)) + F.when(broken, 1).otherwise(0))
    done = tallies.write(done, f"{work}/done", {
        "deferred_extraction": F.col("extract_deferred") | is_("extract_outcome", "left"), "extract_calls": F.col("extract_outcome").isin(*calls.OUTCOMES), "extracted": is_("extract_outcome", "ok"), "extract_schema_failed": broken,
        "extract_transport_error": is_("extract_outcome", "transport"), "quarantined_now": broken & (F.col("_failures") >= 2)})
    good = done.where("extract_outcome = 'ok'")
    places.store.put_new(with_texts(good).select(*base, "record.model", F.col("extract_attempts").alias("attempts"), "record.release_type", "record.impact", F.lit(rules.now).alias("stored_at")))
    hit = places.ledger.read().join(done.where(broken).select("doc_id", "_failures"), "doc_id")
    places.ledger.upsert(hit.withColumn("extract_failures", F.col("_failures")).withColumn("quarantined", F.col("_failures") >= 2).withColumn("updated_at", F.lit(rules.now)))
    report.extracted = _ids(done, is_("extract_outcome", "ok"))

    # What waits, and what left the feed while it waited.
    late = _ids(done, (F.col("refused") & is_("admission", "undated_deferred")) | F.col("gate_deferred") | is_("gate_outcome", "left"))
    later = _ids(done, F.col("extract_deferred") | is_("extract_outcome", "left"))
    heads = {r.source_name: r.head for r in flow.backlog_head(feed, ["source_name"], "feed_ord", "doc_id").collect()}
    for s, t in _evicted(spark, places, rules, feed, names).items():
        for name, n in t.items():
            tallies.add(s, name, n)
    report.backlog = {n: {"head": heads.get(n, []), "gate": late.get(n, []), "extraction": later.get(n, [])} for n in names}
    report.quality = _quality(good, tallies.frame(spark))
    if past is not None:
        flags = {r.source_name: r.d for r in tallies.frame(spark).select("source_name", H.drained(F.col("tally")).alias("d")).collect()}
        for r in windows.collect():
            carry = r.carry and str(r.carry)
            report.window[r.source_name] = {"today": str(rules.today), "cutoff": str(r.b.cutoff), "span_days": r.b.span_days, "anchor": str(r.drained_on) if r.drained_on else flow.NO_DRAINED_RUN if r.seen else None, "capped": r.b.capped, "carry_cutoff": carry,
                                            "window_drained": flags[r.source_name].window_drained, "drained": flags[r.source_name].drained}


def _evicted(spark: SparkSession, places: Places, rules: Rules, feed: DataFrame, names: list[str]) -> dict[str, dict[str, int]]:
    """Of each source: deferred ids of its last record that left the feed and still wait, and whether its whole head left."""
    before = H.latest(spark, places.marks.history, "backlog", names).rows
    here = feed.select(F.col("source_name").alias("source"), "doc_id").distinct()
    queue = lambda k: before.select("source", F.lit(k).alias("kind"), F.explode(f"value.{k}").alias("doc_id"))
    waiting = queue("gate").unionByName(queue("extraction"))
    gone = flow.evictions(waiting, here, ["source", "doc_id"])
    state = flow.with_state(gone, places.ledger.read().drop("source_name"), places.store.read())
    state = state.withColumn("state", flow.item_state(F.col("stored"), F.col("in_ledger"), F.col("quarantined"), flow.valid_verdict(F.col("gate_key"), F.lit(rules.gate_key), F.col("is_relevant"))))
    lost = state.where(F.col("state").isin("needs_gate", "needs_extraction")).groupBy("source").agg(F.count_if(F.col("kind") == "gate").alias("evicted_gate"), F.count_if(F.col("kind") == "extraction").alias("evicted_extraction"))
    alive = before.select("source", F.explode("value.head").alias("doc_id")).join(here, ["source", "doc_id"], "left_semi").select("source").distinct().withColumn("_alive", F.lit(True))
    feeds_now = here.select("source").distinct().withColumn("_any", F.lit(True))
    rolled = before.where(F.size("value.head") > 0).select("source").join(feeds_now, "source").join(alive, "source", "left").select("source", F.col("_alive").isNull().cast("long").alias("feed_rollover"))
    rows = lost.join(rolled, "source", "full").na.fill(0).collect()  # a row a configured source
    return {r.source: {k: r[k] for k in ("evicted_gate", "evicted_extraction", "feed_rollover")} for r in rows}


def _quality(good: DataFrame, tallies: DataFrame) -> dict[str, float]:
    """source.metric to its rate, for what this run stored."""
    n = lambda k: F.coalesce(F.try_element_at("tally", F.lit(k)), F.lit(0)).alias(k)
    given = tallies.select("source_name", n("gate_passed"), n("gate_skipped_now"), n("extract_calls"), n("extract_schema_failed")).withColumnsRenamed({"gate_skipped_now": "gate_skipped", "extract_schema_failed": "schema_failed"})
    none = lambda c, t: F.coalesce(c, F.array().cast(t))
    records = good.select("source_name", F.col("extract_attempts").alias("attempts"), none("record.companies", "array<struct<canonical:string,resolved:boolean>>").alias("companies"), none("record.prior_art", "array<string>").alias("prior_art"), "record.release_type", "record.impact")
    rates = ("gate_pass_rate", "schema_retry_rate", "unresolved_company_rate", "prior_art_empty_rate")
    return {f"{r.source_name}.{k}": float(r[k]) for r in usage.quality(records, given).select("source_name", *rates).collect() for k in rates if r[k] is not None}


def _load(report: Report, inputs: Inputs, places: Places, rules: Rules, write_notes: Callable[[DataFrame], None] | None) -> None:
    """Notes of what is stored; no model is called."""
    seen, actions = Observation(), ("written", "exists", "deleted_by_user", "failed", "overwritten")
    ready = to_load(places.ledger, places.store, inputs.notes, rules.policy, rules.rewrite)
    path = f"{places.work}/load"
    ready.observe(seen, *[F.count_if(F.col("action") == a).alias(a) for a in actions]).write.mode("overwrite").parquet(path)
    ready = ready.sparkSession.read.schema(ready.schema).parquet(path)
    if write_notes:
        write_notes(ready.where(F.col("action").isin("written", "overwritten")))
    counts = {a: n for a, n in seen.get.items() if n}
    counts["written"] = counts.get("written", 0) + counts.pop("overwritten", 0)
    report.load = {a: n for a, n in counts.items() if n}
    status = F.when(F.col("action") == "overwritten", "written").otherwise(F.col("action"))
    moved = ready.where(~F.coalesce(F.col("load_status") == status, F.lit(False)) & ~((F.col("action") == "exists") & F.coalesce(F.col("load_status") == "written", F.lit(False))))
    if not moved.isEmpty():
        places.ledger.upsert(moved.withColumn("load_status", status).withColumn("updated_at", F.lit(rules.now)))


def release(ledger: KeyedTable, doc_ids: list[str], now: str) -> int:
    """Lift the quarantine of these items; the next run tries them again. How many there were."""
    hit = ledger.read().where(F.col("doc_id").isin(*doc_ids))
    n = hit.count()
    if n:
        ledger.upsert(hit.withColumn("quarantined", F.lit(False)).withColumn("extract_failures", F.lit(0)).withColumn("updated_at", F.lit(now)))
    return n
