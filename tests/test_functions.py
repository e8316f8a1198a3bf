"""Literal cases of the scalar functions and operators; the registered queries are compared with DuckDB in test_queries.py."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import urls as U
from tessera.operators import evals, flow, identity, records


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def each(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


URLS = {
    "http://Example.com/a": "https://example.com/a", "https://example.com:443/a/": "https://example.com/a", "http://example.com:80/": "https://example.com/",
    "http://h:443/x": "https://h:443/x", "https://h:8080/x?b=2&a=1": "https://h:8080/x?a=1&b=2", "https://h/?utm_source=x&ref=y&q=1#f": "https://h/?q=1", " https://u:p@h/a//  ": "https://h/a",
    "https://h/a?x=a+b&y=%7E*": "https://h/a?x=a+b&y=~%2A", "https://h/a?k": "https://h/a?k=", "https://h/A?REF=1": "https://h/A?REF=1", "https://h": "https://h", "https://h/?b=1&b=0": "https://h/?b=0&b=1",
}


def test_canonical_url(spark):
    assert each(spark, U.canonical_url, list(URLS)) == list(URLS.values())


def test_doc_id(spark):
    got = each(spark, U.doc_id, ["http://arxiv.org/pdf/2401.00001v2.pdf", "https://arxiv.org/abs/cs/0701001v1", "https://www.arxiv.org/abs/1", "http://h/a", "https://h/a/"])
    assert got[:2] == ["arXiv:2401.00001v2", "arXiv:0701001v1"]
    assert got[2].startswith("news:") and len(got[2]) == 21 and got[3] == got[4]
    with pytest.raises(Exception, match="no paper id"):
        each(spark, U.doc_id, ["https://arxiv.org/"])


def test_hosts(spark):
    assert each(spark, U.registrable, ["a.b.c", "b.c", "c"]) == ["b.c", "b.c", "c"]
    assert each(spark, U.endpoint, ["http://h/x", "https://h:99/x"]) == ["h:80", "h:99"]


def test_strip_html(spark):
    got = each(spark, T.strip_html, ["<p>a&nbsp;b</p>", "a\n\n\n\nb &lt;c&gt;", "  x\t\ty ", "", None])
    assert got == ["a b", "a\n\nb <c>", "x y", "", ""]


def test_query_takes_references_by_its_sql(spark, tmp_path):
    """A title cut inside &amp; keeps what is left of it; null stays null; white space beyond ASCII stays at the ends."""
    import duckdb

    from tessera.plans.catalogue import ORACLES, QUERIES

    texts = ["<title>a &amp</title><p>b &amp; c", "&copy 1 &copy; &nbsp;", "&amp;lt;", None, "", "\u2003 a\x0b", " \x85", "a\n\n\n\nb\n"]
    spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = {r.page_id: r.body for r in QUERIES["strip_html_text"](spark, str(tmp_path)).collect()}
    assert got == dict(con.sql(ORACLES["strip_html_text"]).fetchall())
    assert got[0] == "a &amp b & c" and got[3] is None


def test_offsets(spark):
    assert each(spark, T.parse_offset, ["+09:00", "-0530", "", None]) == [32400, -19800, None, None]
    for bad in ("+9", "KST", "+09:00:00"):
        with pytest.raises(Exception, match="not an offset"):
            each(spark, T.parse_offset, [bad])
    moved = T.utc_date(F.lit("2024-01-01 03:00:00").cast("timestamp_ntz"), F.lit(32400))
    assert one(spark, moved) == dt.date(2023, 12, 31)


def test_slugs(spark):
    got = each(spark, lambda c: T.slugify(c, 10), ["Hello, World!", "한글 제목 테스트 입니다", "aaaaaaaaaaaaaaa", "ab cdefghijklm", "!!!"])
    assert got == ["hello", "한글-제목-테스트", "aaaaaaaaaa", "ab-cdefghi", ""]
    assert each(spark, T.slugify, ["각"]) == ["각"]
    assert each(spark, T.sanitize_filename, ['a:b?.md. ', "???"]) == ["ab.md", "untitled"]
    assert each(spark, T.wikilink, ["C#", "[[a|b]]"]) == ["[[C]]", "[[a b]]"]


def test_clamp(spark):
    got = each(spark, T.clamp_text, ["a… ", "a...", "b", "x" * 4001])
    assert [(len(r.text), r.truncated) for r in got] == [(3, True), (4, True), (1, False), (4000, True)]


def test_prompt_values_are_not_expanded(spark):
    assert one(spark, T.render_prompt("{{a}}-{{b}}-{{c}}", {"a": F.lit("{{b}}"), "b": F.lit("")})) == "{{b}}-(정보 없음)-{{c}}"


def test_stop_kind(spark):
    f = lambda c: T.stop_kind(F.lit("length"), c)
    assert each(spark, f, ["x" + " " * 200, "x" + " " * 199, "", None]) == ["degenerate", "truncated", "degenerate", "degenerate"]
    assert one(spark, T.stop_kind(F.lit("stop"), F.lit(""))) == "stop"


def test_names(spark):
    index = identity.alias_index(spark, {"OpenAI": ["오픈AI"], "Google": ["구글", "open ai"]})
    names = spark.createDataFrame([(i, n) for i, n in enumerate(["open AI", "오픈 AI (OpenAI)", "구글（오픈AI）", "Unknown (구글)", "a(b)(c)", "None"])], "i int, raw string")
    got = [(r.canonical, r.resolved, r.conflict) for r in identity.resolve(names, index).orderBy("i").collect()]
    assert got == [("OpenAI", True, []), ("OpenAI", True, []), ("구글（오픈AI）", False, ["Google", "OpenAI"]), ("Google", True, []), ("a(b)(c)", False, []), ("None", False, [])]


def test_window_bounds(spark):
    today = F.lit("2026-09-29").cast("date")
    day = lambda s: F.lit(s).cast("date")
    none = F.lit(None).cast("date")
    cases = [(none, F.lit(False), none, 7, False), (day("2026-09-26"), F.lit(True), none, 7, False), (day("2026-09-19"), F.lit(True), none, 11, False), (day("2026-09-01"), F.lit(True), none, 14, True), (none, F.lit(True), none, 14, True), (none, F.lit(True), day("2026-09-20"), 9, False)]
    for anchor, seen, carry, span, capped in cases:
        r = one(spark, flow.window_bounds(today, anchor, seen, carry))
        assert (r.span_days, r.capped) == (span, capped)


def test_breaker(spark):
    kinds = ["transport", "transport", "schema", "transport", "ok", "transport"]
    rows = spark.createDataFrame([("gate", i, k) for i, k in enumerate(kinds)], "stage string, i int, k string")
    got = flow.breaker(rows, ["stage"], ["i"], "k").orderBy("i").collect()
    assert [r.streak for r in got] == [1, 2, 2, 3, 0, 1] and [r.open for r in got] == [False, False, False, False, True, True]


def test_rollover_needs_both_sides(spark):
    a = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    assert [one(spark, flow.rollover(*p)) for p in ((a("1"), a("2")), (a("1"), a("1", "2")), (a(), a("1")), (a("1"), a()))] == [True, False, False, False]


RATIONALE = "①사건: 충족 ②범위(" + "긴 설명 " * 10 + ") 미충족 ③정도: 부분 충족 ④경위: 분모에서 제외 → 분모 3"


def test_slots(spark):
    assert each(spark, evals.slot_states, [RATIONALE, "", None]) == [["full", "none", "partial", "excluded"], [None] * 4, [None] * 4]
    assert each(spark, evals.slot_verdicts, [RATIONALE])[0][:3] == ["yes", "no", "yes"]
    assert each(spark, T.stated_denominator, [RATIONALE, "1/3, 2/4 슬롯", "없음"]) == [3, 4, None]
    strict = lambda text, sizes: one(spark, evals.parsed_elements(F.lit(text), F.array(*[F.lit(n) for n in sizes])))
    assert strict("①사건: (a) 담김 | ②범위: (a) 이름만 (b) 없음", [1, 2, 0, 0]) == "ok:a=담김|a=이름만;b=없음||"
    for bad, sizes in (("①(a) 담김 ①(a) 담김", [1, 0, 0, 0]), ("①(a) 담김 (a) 없음", [1, 0, 0, 0]), ("①(a) 담김", [2, 0, 0, 0]), ("①(a) 담김 (b) 담김", [1, 0, 0, 0]), ("", [1, 0, 0, 0]), ("②(a) 담김", [1, 0, 0, 0]), (None, [1, 0, 0, 0])):
        assert strict(bad, sizes).startswith("error:")
    assert each(spark, evals.element_verdicts, ["①(a) 담김 (a) 없음 (c)이름만 → (b) 담김 ② x ②(b) 담김"]) == [["a=없음;c=이름만", "b=담김", None, None]]
    assert each(spark, evals.slot_verdicts, ["①" + "가" * 200 + "충족 ② 채우지 못했다 충족"]) == [[None, "no", None, None]]


def test_golden_and_slot_rules(spark):
    arr = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    ok = [(arr("a"), arr(), arr(), arr()), (arr(), arr(), arr(), arr()), (arr("a", " a"), arr(), arr(), arr()), (arr("a"), arr(" "), arr(), arr()), (arr("a", "b", "c", "d"), arr(), arr(), arr())]
    assert [one(spark, records.slots_valid(F.array(*s))) for s in ok] == [True, False, False, False, False]
    full = lambda status, body, whole: one(spark, records.golden_valid(F.lit(status), F.lit(3), F.lit(body), F.lit("me"), F.lit("2024"), F.lit(whole)))
    assert full("confirmed", "b", "{}") and full("draft", "", "{}") and not full("confirmed", " ", "{}") and not full("confirmed", "b", "<<채워주세요>>")


def test_empty_sets_agree(spark):
    none = F.array().cast("array<string>")
    assert one(spark, evals.jaccard(none, none)) == 1.0


def test_unknown_items_abort(spark):
    golden = spark.createDataFrame([("a",), ("b",)], "item_id string")
    assert evals.select_items(golden, golden.limit(1)).count() == 1
    with pytest.raises(Exception, match="unknown items: z"):
        evals.select_items(golden, spark.createDataFrame([("z",)], "item_id string")).collect()


def test_alert_streaks(spark):
    """An evaluated run without the event closes a streak, an unevaluated one neither closes nor extends it."""
    from tessera.operators import alerts

    events = spark.createDataFrame([(r, "source_error", "s", None) for r in (1, 2, 4, 5, 8)] + [(5, "source_error", "s", None)], "run int, kind string, source string, slack double")
    evaluated = spark.createDataFrame([(r, "source_error") for r in (1, 2, 4, 6, 8)], "run int, kind string")
    got = [(r.run, r.consecutive, r.first_seen, r.severity, r.raised) for r in alerts.streaks(events, evaluated).orderBy("run").collect()]
    assert got == [(1, 1, 1, "info", True), (2, 2, 1, "warning", True), (4, 3, 1, "critical", True), (5, 4, 1, "critical", False), (8, 1, 8, "info", True)]
    assert alerts.open_after(alerts.streaks(events, evaluated), evaluated).count() == 1
    assert [(r.last_seen, r.closed_by) for r in alerts.closed(alerts.streaks(events, evaluated), evaluated).collect()] == [(5, 6)]


SEVERITY = [
    ("preflight_mismatch", 1, None, "critical"), ("source_error", 1, 5.0, "info"), ("source_error", 2, 5.0, "warning"), ("source_error", 1, 0.0, "critical"), ("breaker", 1, 5.0, "warning"), ("breaker", 1, None, "warning"),
    ("source_error", 2, None, "warning"), ("source_error", 3, None, "critical"), ("env_not_ready", 1, None, "warning"), ("env_not_ready", 2, None, "critical"), ("env_not_ready", 1, 9.0, "info"), ("not_drained", 1, None, "info"),
    ("not_drained", 2, None, "warning"), ("evicted", 1, None, "warning"), ("lock_held", 9, None, "info"),
]


def test_severity(spark):
    from tessera.operators import alerts

    df = spark.createDataFrame([(i, *r) for i, r in enumerate(SEVERITY)], "i int, kind string, n int, slack double, want string")
    bad = df.where(alerts.severity(F.col("kind"), F.col("n"), F.col("slack")) != F.col("want"))
    assert bad.count() == 0


def test_item_states(spark):
    cases = [(True, True, None, None, "stored"), (True, False, None, None, "stored_outside_pipeline"), (False, False, None, None, "needs_gate"), (False, True, True, True, "quarantined"), (False, True, False, None, "needs_gate"), (False, True, False, True, "needs_extraction"), (False, True, False, False, "gate_skipped")]
    df = spark.createDataFrame(cases, "s boolean, l boolean, q boolean, v boolean, want string")
    assert df.where(flow.item_state(F.col("s"), F.col("l"), F.col("q"), F.col("v")) != F.col("want")).count() == 0


def test_contract_mutations(spark):
    """Each mutation of a clean export fails the one check it belongs to."""
    store = spark.createDataFrame([(f"https://h/{i}", "t", f"body {i}", ["ko"], "src", "2024-01-01", "2024-01-02") for i in range(4)], "url string, title string, body string, tags array<string>, source_name string, published_at string, collected_at string")
    ontology = F.struct(F.array(F.lit("LLM")).alias("tech_domains"), F.lit("Paper").alias("release_type"))
    extraction = F.struct(F.lit("m").alias("model"), F.lit("p").alias("prompt_name"), F.sha2(F.lit("p"), 256).alias("prompt_sha256"), F.lit("at").alias("extracted_at"))
    gate = F.struct(F.lit("g").alias("model"), F.lit("gp").alias("prompt_name"))
    clean = records.export_records(store.withColumn("ontology", ontology).withColumn("extraction", extraction).withColumn("gate", gate), "1", "v1")
    assert len(clean.columns) == 17
    counts = records.manifest_counts(clean.select("text", "source_name", F.col("ontology.release_type").alias("release_type"), F.col("ontology.tech_domains").alias("tech_domains"), F.array().cast("array<struct<resolved:boolean>>").alias("companies")))
    prompts = spark.sql("SELECT 'p' AS prompt_version, sha2('p', 256) AS sha256")
    snapshot = clean.limit(1).select("doc_id", "title", "text", "locator", "url")
    pairs = snapshot.select(F.lit("c").alias("case_id"), "doc_id")

    def failing(rec, manifest=counts, expected=4):
        return {r.number for r in records.checks(rec, manifest, prompts, snapshot, pairs, "1", expected).where("status = 'FAIL'").collect()}

    assert failing(clean) == set()
    assert failing(clean, expected=5) == {1}
    assert failing(clean.withColumn("provenance", F.col("provenance").withField("extraction_model", F.lit(" ")))) == {2}
    assert failing(clean.withColumn("provenance", F.col("provenance").withField("prompt_sha256", F.lit("x")))) == {3}
    assert failing(clean.withColumn("text_chars", F.lit(1).cast("long"))) == {8}
    assert failing(clean.withColumn("indexable", F.lit(False))) == {9}
    assert failing(clean.withColumn("ontology", F.col("ontology").withField("release_type", F.lit("Gossip")))) == {10}
    assert failing(clean.withColumn("published_at", F.lit(""))) == {11}
    assert failing(clean, manifest=counts.withColumn("n", F.when(F.col("block") == "total", 9).otherwise(F.col("n")))) == {12}
    assert failing(clean.withColumn("text_origin", F.lit("summary"))) == {4, 9}
