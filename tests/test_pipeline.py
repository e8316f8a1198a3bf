"""Whole runs with injected clients: calls, tallies, windows, backlog, report and marks."""

import datetime as dt
import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tessera.operators import calls as C
from tessera.plans import daily
from tessera.plans import pipeline as P
from tessera.sources import history as H
from tessera.sources.tables import KeyedTable

cloudpickle.register_pickle_by_value(sys.modules[__name__])
RECORD = json.dumps({"model": "m", "attempts": 1, "release_type": "Paper", "impact": 3, "companies": [{"canonical": "A", "resolved": False}], "prior_art": []})


class Env:
    def __init__(self, spark, path):
        self.spark, self.path, self.runs = spark, str(path), 0
        self.ledger = KeyedTable(spark, f"{path}/ledger", "doc_id", daily.LEDGER)
        self.store = KeyedTable(spark, f"{path}/store", "doc_id", daily.STORE)
        self.marks = H.Marks(spark, f"{path}/runs", f"{path}/marks")
        self.notes = spark.createDataFrame([], "doc_id string, path string")

    def log(self, stage):
        name = f"{self.path}/{stage}.log"
        return [x for x in open(name).read().split("\n") if x] if os.path.exists(name) else []

    def go(self, feeds, day=31, sources=None, gate=None, extract=None, status=None, **rules):
        """feeds: {source: [(number, published day of January or None)]}; one run, its report."""
        self.runs += 1
        at = lambda d: None if d is None else dt.date(2024, 1, 1) + dt.timedelta(d - 1)
        rows = [(s, f"https://h/{n}", f"T{n}", "body", at(d), i) for s, items in feeds.items() for i, (n, d) in enumerate(items)]
        items = self.spark.createDataFrame(rows, "source_name string, url string, title string, body string, published_at date, feed_ord int")
        sources = sources or [P.Source(s, 20, 20) for s in feeds]
        fetches = self.spark.createDataFrame([(s.name, (status or {}).get(s.name, "ok"), "why", 5.0) for s in sources], "source_name string, status string, detail string, depth_hours double")

        def client(stage, answer, path=self.path):
            def ask(item):
                with open(f"{path}/{stage}.log", "a") as f:
                    f.write(f"{item['title']}\n")
                return answer(item)

            return ask

        rules = P.Rules("g|m", at(day), f"2024-{self.runs:03}", **rules)
        places = P.Places(self.ledger, self.store, self.marks, f"{self.path}/work{self.runs}")
        yes = lambda item: json.dumps({"is_relevant": True, "reason": "r"})
        return P.run(self.spark, f"pipeline-{self.runs:03}", sources, P.Inputs(items, fetches, self.notes), places, rules, client("gate", gate or yes), client("extract", extract or (lambda item: RECORD))).first()


@pytest.fixture
def env(spark, tmp_path):
    return Env(spark, tmp_path)


def down(item):
    raise ConnectionError("down")


def test_stages_carry_no_texts(env):
    """The feed's table holds the texts; calls and the store get those of their own rows."""
    said = lambda item: json.dumps({"is_relevant": item["body"] == "body" and item["url"] == f"https://h/{item['title'][1:]}", "reason": "r"})
    r = env.go({"s": [(1, 30), (2, 30), (3, 2)], "t": [(1, 30)]}, gate=said)
    assert r.sources["s"]["gate_passed"] == 2
    for stage in ("asked", "gated", "done"):
        assert not {"url", "title", "body"} & set(env.spark.read.parquet(f"{env.path}/work1/{stage}").columns)
    assert sorted((x.url, x.title, x.body) for x in env.store.read().collect()) == [("https://h/1", "T1", "body"), ("https://h/2", "T2", "body")]


def test_a_run_from_feed_to_report(env):
    gate = lambda item: json.dumps({"is_relevant": item["title"] != "T2", "reason": "r"})
    feeds = {"s": [(1, 30), (2, 30), (3, 2), (4, None)], "t": [(1, 30), (5, 29), (5, 29)]}
    r = env.go(feeds, gate=gate)
    assert r.sources["s"] == {"collected": 4, "out_of_window": 1, "undated_admitted": 1, "gate_calls": 3, "gate_passed": 2, "gate_skipped_now": 1, "extract_calls": 2, "extracted": 2}
    assert r.sources["t"] == {"collected": 3, "duplicate_in_run": 2, "gate_calls": 1, "gate_passed": 1, "extract_calls": 1, "extracted": 1}
    assert (r.failures, r.produced, r.healthy, r.exit_code, r.load) == (0, 6, 2, 0, {"written": 3}) and r.quality["s.gate_pass_rate"] == 0.667 and r.quality["t.unresolved_company_rate"] == 1.0
    assert r.window["s"].drained and r.window["s"].cutoff == "2024-01-24" and len(r.backlog["t"].head) == 3 and r.error is None and len(r.extracted_ids["s"]) == 2
    # The same items again: no call, and nothing new.
    before = (env.log("gate"), env.log("extract"), env.store.versions()[-1], env.store.read().count())
    again = env.go(feeds, gate=gate)
    assert (env.log("gate"), env.log("extract")) == before[:2] and env.store.read().count() == before[3] and again.produced == 0
    assert again.sources["s"] == {"collected": 4, "stored": 2, "gate_skipped": 1, "out_of_window": 1} and again.load == {"deleted_by_user": 3} and again.exit_code == 0
    assert {x.source: str(x.drained_on) for x in env.marks.table.read().collect()} == {"s": "2024-01-31", "t": "2024-01-31"}


def test_limits_and_what_waits(env):
    feeds = {"s": [(n, 30) for n in range(5)], "t": [(n, 30) for n in range(5, 9)]}
    r = env.go(feeds, sources=[P.Source("s", 3, 1), P.Source("t", 4, 4)])
    assert {k: r.sources["s"][k] for k in ("gate_calls", "deferred_gate", "extract_calls", "deferred_extraction")} == {"gate_calls": 3, "deferred_gate": 2, "extract_calls": 1, "deferred_extraction": 2}
    assert not r.window["s"].window_drained and r.window["t"].drained and len(r.backlog["s"].gate) == 2 == len(r.backlog["s"].extraction)
    assert {x.source: (str(x.drained_on), str(x.carry)) for x in env.marks.table.read().collect()} == {"s": ("None", "2024-01-24"), "t": ("2024-01-31", "None")}
    # The rest of the gate's queue left the feed: lost, and said so once.
    r = env.go({"s": [(n, 30) for n in range(3)] + [(90, 31)], "t": [(99, 31)]}, day=32, sources=[P.Source("s", 0, 1), P.Source("t", 0, 4)])
    assert r.sources["s"]["evicted_gate"] == 2 and r.sources["s"]["extract_calls"] == 1 and "feed_rollover" not in r.sources["s"] and r.sources["t"]["feed_rollover"] == 1
    assert r.window["s"].anchor == "none_drained" and r.window["s"].carry_cutoff == "2024-01-24" and r.window["t"].anchor == "2024-01-31"
    r = env.go({"s": [(n, 30) for n in range(3)]}, day=33, sources=[P.Source("s", 9, 9)])
    assert r.sources["s"]["evicted_gate"] == 1 and r.window["s"].drained  # number 90 alone; the first loss is not counted again


def test_the_breaker_stops_a_stage(env):
    r = env.go({"s": [(n, 30) for n in range(6)], "t": [(9, 30)]}, gate=down)
    assert r.breaker_tripped == ["relevance_gate"] and len(env.log("gate")) == 3
    assert r.sources["s"] == {"collected": 6, "gate_calls": 3, "gate_error": 3, "deferred_gate": 3} and r.sources["t"] == {"collected": 1, "deferred_gate": 1} and r.exit_code == 1
    r = env.go({"s": [(n, 30) for n in range(6)], "t": [(9, 30)]}, extract=down, breaker="source")
    assert r.breaker_tripped == ["extraction"] and r.sources["s"]["extract_transport_error"] == 3 and r.sources["s"]["deferred_extraction"] == 3 and r.sources["t"]["extract_transport_error"] == 1
    r = env.go({"s": [(n, 30) for n in range(6)], "t": [(9, 30)]})
    assert r.sources["s"]["extracted"] == 6 and "gate_calls" not in r.sources["s"] and r.exit_code == 0


def test_quarantine_and_release(env):
    odd = lambda item: RECORD if item["title"] != "T1" else json.dumps({"release_type": "Paper", "impact": 9})
    feeds = {"s": [(1, 30), (2, 30)]}
    first, second, third = (env.go(feeds, extract=odd) for _ in range(3))
    assert first.sources["s"]["extract_schema_failed"] == 1 and "quarantined_now" not in first.sources["s"] and first.exit_code == 3
    assert second.sources["s"]["quarantined_now"] == 1 and second.exit_code == 1 and third.sources["s"]["quarantined"] == 1 and "extract_calls" not in third.sources["s"]
    held = [r.doc_id for r in env.ledger.read().where("quarantined").collect()]
    assert P.release(env.ledger, held, "x") == 1 and env.go(feeds).sources["s"]["extracted"] == 1


def test_dead_and_silent_sources(env):
    sources = [P.Source("s", max_silence_days=5), P.Source("t", max_silence_days=5), P.Source("u")]
    r = env.go({"s": [(1, 30)], "t": [(2, 20)], "u": []}, sources=sources, status={"u": "http_error"})
    assert r.sources["u"] == {"source_error": 1} and r.sources["t"]["stale_feed"] == 1 and (r.failures, r.healthy, r.exit_code) == (2, 1, 3) and "u" not in r.window and "u" not in r.backlog
    assert r.fetch["t"].silent.age_days == 11 and r.fetch["u"].status == "http_error" and r.fetch["s"].depth_hours == 5.0
    r = env.go({"s": [(1, 30)], "t": [(2, 20)], "u": []}, sources=sources, status={s: "timeout" for s in "stu"})
    assert (r.failures, r.produced, r.healthy, r.exit_code) == (3, 0, 0, 1)


def test_a_failing_stage_still_leaves_a_report(env):
    def blocked(item):
        raise C.EgressBlocked("elsewhere")

    with pytest.raises(Exception, match="elsewhere"):
        env.go({"s": [(1, 30), (2, 3)]}, extract=blocked)
    r = H.read_runs(env.spark, f"{env.path}/runs", H.run_ids(env.spark, f"{env.path}/runs")).first()
    assert "elsewhere" in r.error and r.sources["s"]["gate_passed"] == 1 and r.window == {} and r.exit_code == 1
    assert env.marks.table.read().count() == 0 and env.ledger.read().count() == 1  # the verdict is kept, no mark moved
    r = env.go({"s": [(1, 30)]})
    assert r.sources["s"] == {"collected": 1, "extract_calls": 1, "extracted": 1} and len(env.log("gate")) == 1


def test_without_a_window_every_date_is_admitted(env):
    r = env.go({"s": [(1, 30), (2, 1), (3, None)]}, window=False)
    assert r.sources["s"]["gate_calls"] == 3 and r.window == {} and "undated_admitted" not in r.sources["s"]
