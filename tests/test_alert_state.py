"""Events from reports and alert state across runs, by literal cases and against the batch form."""

import json

from pyspark.sql import functions as F

from tessera.operators import alerts as A
from tessera.sources import history as H

RUN_KINDS = ["source_error", "stale_feed", "window_capped", "not_drained", "evicted", "feed_rollover", "breaker", "quarantined", "run_error"]


def reports(spark, *rows):
    return spark.read.schema(H.REPORT).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))


def events(spark, *rows):
    return spark.createDataFrame([(i, k, s, "d", x) for i, (k, s, x) in enumerate(rows)], "ord int, kind string, source string, detail string, slack double")


def test_events_read_structured_values(spark):
    got = A.events_of(reports(spark, {
        "run_id": "r", "fetch": {"A": {"status": "http_error", "detail": "503"}, "B": {"status": "ok", "silent": {"newest": "2024-05-10", "age_days": 800, "max_silence_days": 7}}, "C": {"status": "empty", "feed_kind": "sample"}},
        "window": {"B": {"capped": True, "drained": False, "cutoff": "2026-09-16", "span_days": 14}, "C": {"drained": True, "capped": False}}, "sources": {"B": {"deferred_gate": 5, "quarantined_now": 1}, "C": {"feed_rollover": 1, "evicted_extraction": 2}}, "breaker_tripped": ["extraction"]},
        {"run_id": "quiet", "fetch": {"A": {"status": "ok"}}, "window": {"A": {}}, "sources": {"A": {"evicted_gate": 0}}})).collect()
    assert {(r.kind, r.source) for r in got} == {("source_error", "A"), ("stale_feed", "B"), ("window_capped", "B"), ("not_drained", "B"), ("breaker", None), ("quarantined", "B"), ("evicted", "C")}
    detail = {r.kind: r.detail for r in got}
    assert detail["source_error"] == "fetch failed [http_error] 503" and detail["not_drained"].startswith("waiting: gate 5, undated 0") and detail["evicted"].endswith("gate 0, extraction 2")
    assert A.events_of(reports(spark, {"run_id": "r"})).count() == 0


def test_time_left_before_loss(spark):
    clocks = spark.createDataFrame([("A", 30.0, 10.0, -4.0), ("B", 90.0, 10.0, 56.0)], "source string, depth_hours double, hours_since_success double, slack_hours double")
    got = {(r.kind, r.source): (r.slack, r.detail) for r in A.with_loss(events(spark, ("source_error", "B", None), ("source_error", "Z", None), ("breaker", None, None), ("not_drained", "A", None)).drop("slack"), clocks).collect()}
    assert got["source_error", "B"][0] == 56.0 and "B has a feed of 90.0 hours" in got["source_error", "B"][1] and got["source_error", "Z"] == (None, "d")
    assert got["breaker", None][0] == -4.0 and "; A has a feed" in got["breaker", None][1] and got["not_drained", "A"] == (None, "d")
    assert A.with_loss(events(spark, ("breaker", None, None)).drop("slack"), clocks.limit(0)).first().slack is None


def test_state_across_runs(spark, tmp_path):
    state = A.AlertState(spark, str(tmp_path / "s"))
    keys = lambda df: {r.key: (r.severity, r.consecutive, r.first_seen) for r in df.collect()}
    raised = state.update(events(spark, ("source_error", "A", None), ("source_error", "A", None), ("preflight_mismatch", None, None)), "r1", "t1", RUN_KINDS + ["preflight_mismatch"])
    assert keys(raised) == keys(state.open()) == {"source_error|A": ("info", 1, "t1"), "preflight_mismatch|-": ("critical", 1, "t1")}
    # A run that stops at its readiness checks evaluates neither kind: nothing closes or grows.
    state.update(events(spark, ("env_not_ready", None, None)), "r2", "t2", ["env_not_ready"])
    assert set(keys(state.open())) == {"source_error|A", "preflight_mismatch|-", "env_not_ready|-"} and state.open().first().kind == "preflight_mismatch"
    raised = state.update(events(spark, ("source_error", "A", None), ("source_error", "B", -1.0)), "r3", "t3", RUN_KINDS)
    assert keys(raised) == {"source_error|A": ("warning", 2, "t1"), "source_error|B": ("critical", 1, "t3")}
    assert keys(state.update(events(spark, ("source_error", "A", None)), "r4", "t4", ["source_error"])) == {"source_error|A": ("critical", 3, "t1")}
    state.update(events(spark).limit(0), "r5", "t5", RUN_KINDS + ["preflight_mismatch"])
    assert set(keys(state.open())) == {"env_not_ready|-"} and {(r.key, r.closed_by) for r in state.closed().collect()} == {("source_error|A", "r5"), ("source_error|B", "r4"), ("preflight_mismatch|-", "r5")}
    state.update(events(spark, ("source_error", "A", None)), "r6", "t6", RUN_KINDS)
    assert keys(state.open())["source_error|A"] == ("info", 1, "t6")  # a new alert


def test_only_the_last_closed_are_kept(spark, tmp_path):
    state = A.AlertState(spark, str(tmp_path / "s"))
    state.update(events(spark, *[("evicted", f"s{i}", None) for i in range(5)]), "r1", "t1", RUN_KINDS)
    state.update(events(spark).limit(0), "r2", "t2", RUN_KINDS, keep=3)
    assert state.closed().count() == 3 and state.open().count() == 0


def test_another_schema_version_is_refused(spark, tmp_path):
    state = A.AlertState(spark, str(tmp_path / "s"))
    state.update(events(spark, ("breaker", None, None)), "r1", "t1", RUN_KINDS)
    assert state.open().count() == 1
    state.table.overwrite(state.table.read().withColumn("schema", F.lit(99)))
    assert state.open().count() == 0 and state.closed().count() == 0
    state.update(events(spark, ("breaker", None, None)), "r2", "t2", RUN_KINDS)
    assert [r.consecutive for r in state.open().collect()] == [1]


def test_state_equals_the_batch_form(spark, tmp_path):
    runs = {"1": [("not_drained", "A")], "2": [("not_drained", "A"), ("breaker", None)], "3": [("not_drained", "B")], "4": [("not_drained", "A"), ("not_drained", "B"), ("breaker", None)]}
    state = A.AlertState(spark, str(tmp_path / "s"))
    for run, found in runs.items():
        state.update(events(spark, *[(k, s, None) for k, s in found]), run, run, ["not_drained"] + (["breaker"] if run != "3" else []))
    all_ = spark.createDataFrame([(r, k, s, None) for r, f in runs.items() for k, s in f], "run string, kind string, source string, slack double")
    evaluated = spark.createDataFrame([(r, "not_drained") for r in runs] + [(r, "breaker") for r in runs if r != "3"], "run string, kind string")
    batch = A.open_after(A.streaks(all_, evaluated), evaluated)
    want = {(r.key, r.consecutive, r.severity, r.first_seen, r.last_seen) for r in batch.collect()}
    assert {(r.key, r.consecutive, r.severity, r.first_seen, r.last_seen) for r in state.open().collect()} == want != set()
