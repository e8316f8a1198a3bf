"""Preflight, contract ontology, folding, replays and notices by literal cases."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import control, records, usage

PRINT = "section string, name string, value string"


def test_folding_is_pythons(spark):
    words = ["Straße", "ΟΔΟΣ", "ﬁn", "ıI", "İ", "ÀÉ", "ǅ", "ŉ", "K", "中文 한국", "", "ẞ", "Ω", "ſ", "և"]
    got = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").select("w", T.casefold(F.col("w")).alias("f")).collect()
    assert {r.w: r.f for r in got} == {w: w.casefold() for w in words}
    assert spark.range(1).select(T.normalization_key(F.lit(" STRASSE　x"))).first()[0] == "strassex"


def why(spark, approved, current):
    return {(r.section, r.name): r.why for r in records.mismatches(spark.createDataFrame(approved, PRINT), spark.createDataFrame(current, PRINT)).collect()}


def test_limits_may_fall_and_sources_may_go(spark):
    approved = [("limits.gate", "s", "10"), ("limits.extract", "s", "5"), ("sources", "s", "u"), ("sources", "gone", "v"), ("prompt", "g", "h1"), ("model", "gate", None), ("endpoint", "", "e1")]
    same = [("limits.gate", "s", "9"), ("limits.extract", "s", "5"), ("sources", "s", "u"), ("prompt", "g", "h1"), ("model", "gate", None), ("endpoint", "", "e1")]
    assert why(spark, approved, approved) == why(spark, approved, same) == {}
    other = [("limits.gate", "s", "11"), ("limits.extract", "t", "1"), ("sources", "s", "other"), ("sources", "new", "w"), ("prompt", "g", "h2"), ("model", "gate", "m"), ("endpoint", "", None)]
    assert why(spark, approved, other) == {("limits.gate", "s"): "raised", ("limits.extract", "t"): "added", ("sources", "s"): "changed", ("sources", "new"): "added", ("prompt", "g"): "changed", ("model", "gate"): "added", ("endpoint", ""): "unresolved"}


def test_preflight_needs_a_live_approval(spark):
    found = spark.createDataFrame([("prompt", "g", "changed")], "section string, name string, why string")
    record = lambda *rows: spark.createDataFrame(list(rows), "schema int, expires_at timestamp")
    run = lambda a, **more: {(r.key, r.detail) for r in records.preflight(a, found, F.lit("2024-02-01").cast("timestamp"), **more).collect()}
    changed = ("prompt.g", "changed")
    assert run(record((1, dt.datetime(2024, 3, 1)))) == {changed} and run(record((1, dt.datetime(2024, 1, 1)))) == {changed, ("approval", "approval expired")}
    assert run(record()) == {("approval", "no approval")} and run(record((9, dt.datetime(2024, 3, 1)))) == {("approval", "unreadable approval")}
    assert run(record((1, None)), vendor_file=True) == {changed, ("approval", "approval expired"), ("vendor_approval", "an approval of a vendor run is left over")}


def test_contract_ontology(spark):
    kind = "o struct<tech_domains:array<string>,release_type:string,companies:array<struct<canonical:string,raw:string,resolved:boolean,role:string,extra:int>>,prior_art:array<string>,impact:struct<score:int,rationale:string>,summary:string>"
    rows = [((["LLM"], "Paper", [("A", "a", None, "maker", 1), (None, "b", True, None, 2)], None, (4, "why"), "s"),), ((["RAG"], "Policy", None, ["x"], (1, None), "t"),)]
    a, b = [r[0].asDict(True) for r in spark.createDataFrame(rows, kind).select(records.ontology_block(F.col("o"))).collect()]
    assert a == {"tech_domains": ["LLM"], "release_type": "Paper", "companies": [{"canonical": "A", "raw": "a", "resolved": False, "role": "maker"}, {"canonical": None, "raw": "b", "resolved": True, "role": None}], "prior_art": [], "impact_score": 4, "impact_rationale": "why", "summary": "s"}
    assert (b["companies"], b["prior_art"], b["impact_score"]) == ([], ["x"], 1)


def test_replays(spark):
    base = spark.createDataFrame([(i, "Paper", i) for i in range(5)], "doc_id int, release_type string, impact int")
    out = spark.createDataFrame([(0, "Paper", 0, None, 1), (1, "Policy", 9, None, 1), (2, None, None, "schema", 2), (3, None, None, "transport", 1), (3, "Paper", 3, None, 2), (99, "Paper", 1, None, 1)], "doc_id int, release_type string, impact int, failure string, attempts int")
    got = {r.doc_id: (r.state, r.attempts, r.changed) for r in usage.replayed(base, out, ["release_type", "impact"]).collect()}
    assert got == {0: ("same", 1, []), 1: ("changed", 1, ["release_type", "impact"]), 2: ("failed", 2, None), 3: ("same", 2, []), 4: ("pending", None, None)}


def test_notices_are_for_critical_alerts_alone(spark):
    alerts = lambda *rows: spark.createDataFrame(list(rows), "key string, kind string, source string, detail string, severity string, first_seen string")
    assert control.toast(alerts(("a", "evicted", "s", "d", "warning", "1"))).count() == 0 and control.toast(alerts(("a", "x", None, "d", "info", "1")).limit(0)).count() == 0
    two = control.toast(alerts(("a", "source_error", "s", "late", "critical", "2"), ("b", "breaker", None, "first", "critical", "1"), ("c", "evicted", None, "no", "warning", "0"))).first()
    assert (two.title, two.body) == ("pipeline: 2 critical", "breaker — first and 1 more; see the status note")
    one = control.toast(alerts(("a", "source_error", "s", "late", "critical", "2"))).first()
    assert one.body == "source_error · s — late"


def test_judge_variables(spark):
    v = lambda body, slots: spark.range(1).select(control.judge_variables(F.lit("T"), F.lit(body), F.lit("sum"), slots)).first()[0]
    arr = lambda *x: F.array(*[F.lit(e) for e in x]).cast("array<string>")
    assert v(" b\n", F.lit(None).cast("array<array<string>>")) == {"source_text": "T\n\nb", "summary": "sum"} and v(None, F.lit(None).cast("array<array<string>>"))["source_text"] == "T"
    got = v("b", F.array(arr("x", "y"), arr(), arr("z"), arr()))["completeness_slots"].split("\n")
    assert got[0] == "분모: 2" and got[1].endswith("(a) x / (b) y") and "분모 제외" in got[2] and got[3].endswith(": (a) z")


def test_repeats_by_axis_and_element(spark):
    from tessera.operators import evals

    kind = "item_id string, judged boolean, coded boolean, parse_failed boolean, scores struct<faithfulness:int,completeness:int,concision:int>, human struct<faithfulness:int,completeness:int,concision:int>, rationale string"
    rows = [("a", True, False, False, (3, 4, 5), (3, 3, 3), "① 충족: (a) 담김 (b) 담김 ② 부분: (a) 이름만 (a) 담김 (b) 없음"), ("a", True, False, False, (5, 4, 1), None, "① 충족: (a) 담김 (b) 없음 ② 분모에서 제외 (a) 없음 ③ 부분"),
            ("a", False, False, True, None, None, None), ("b", True, True, False, (1, 1, 1), None, "① 충족 (a) 담김"), ("c", False, False, False, None, None, None)]
    df = spark.createDataFrame(rows, kind)
    axes = {(r.item_id, r.axis): (r.n, r.mean, r.stdev, r.spread, r.human, r.gap) for r in evals.repeat_axes(df).collect()}
    assert axes["a", "faithfulness"] == (2, 4.0, 1.414, 2, 3, 1.0) and axes["a", "completeness"] == (2, 4.0, 0.0, 0, 3, 1.0) and axes["b", "concision"] == (1, 1.0, None, 0, None, None) and len(axes) == 6
    got = {r.item_id: (r.checked, r.consistency, r.counts, r.parse_failures) for r in evals.repeat_elements(df).collect()}
    # Rows 1 and 2, slot 1: consistent, and not; row 1, slot 2: one of two held, partial.
    assert got["a"] == (3, 0.667, "1(a) 담김=2;1(b) 담김=1;1(b) 없음=1;2(a) 담김=1;2(b) 없음=1", 1) and got["b"] == (0, None, "", 0) and got["c"] == (0, None, "", 0)
