"""Sources, sinks, the daily run and the streaming twins on small literal inputs."""

import gzip
import json
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.plans import daily
from tessera.sources import config, feeds, notes, tables
from tessera.streaming import incremental

RSS = """<?xml version="1.0"?><rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>
<item><title> One </title><link>https://h/1</link><description>short</description><content:encoded><![CDATA[<p>a longer &amp; body</p>]]></content:encoded><pubDate>Mon, 29 Jan 2024 23:30:00 GMT</pubDate></item>
<item><title>Two</title><link>https://h/2</link><description>b</description><pubDate>2024-01-30 03:00:00</pubDate></item>
<item><title> </title><link>https://h/3</link></item><item><title>No link</title></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link href="https://arxiv.org/abs/2401.1v1"/><summary>s</summary><published>2024-01-29T23:00:00-05:00</published></entry></feed>"""
CONFIG = {"sources": {"rss": [{"name": "rss", "url": "x", "tags": ["ko"], "limits": {"gate": 3, "extract": 2}, "naive_date_offset": "+09:00"}, {"name": "atom", "url": "y", "limits": {"gate": 4, "extract": 1}, "feed_kind": "sample"}], "retired": [{"name": "old", "url": "z", "retired_on": "2024-01-01"}]}}


def test_config(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(CONFIG))
    t = config.sources(spark, config.load_config(str(tmp_path / "c.json")))
    assert [r.name for r in config.active(t).collect()] == ["rss", "atom"] and [r.name for r in config.retired(t).collect()] == ["old"]
    assert {(r.gate_ceiling, r.extract_ceiling) for r in config.limits(config.active(t)).collect()} == {(7, 3)}
    assert [(r.name, r.gate_ceiling) for r in config.limits(t, {"rss": (500, 1)}).collect()] == [("rss", 200)]
    with pytest.raises(ValueError, match="feed_kind"):
        config.sources(spark, {"sources": {"rss": [{"name": "a", "feed_kind": "odd"}]}})
    (tmp_path / "bad.json").write_text("[]")
    with pytest.raises(ValueError, match="mapping"):
        config.load_config(str(tmp_path / "bad.json"))


def test_decode():
    raw = zlib.compressobj(wbits=-15)
    for data, name in ((b"abc", None), (gzip.compress(b"abc"), "gzip"), (zlib.compress(b"abc"), "deflate"), (raw.compress(b"abc") + raw.flush(), "deflate")):
        assert feeds.decode(data, name) == b"abc"
    with pytest.raises(feeds.TooLarge):
        feeds.decode(gzip.compress(b"x" * 100), "gzip", cap=50)
    for data, name in ((b"abc", "br"), (b"abc", "gzip")):
        with pytest.raises(feeds.Undecodable):
            feeds.decode(data, name)


def test_outcomes_of_fetch():
    def late(url, timeout):
        raise TimeoutError

    calls = []

    def second(url, timeout):
        calls.append(url)
        return (200, b"" if len(calls) == 1 else b"x", None)

    assert feeds.fetch("u", transport=late)[0] == "timeout"
    assert feeds.fetch("u", transport=lambda u, t: (503, b"", None))[:2] == ("http_error", 503)
    assert feeds.fetch("u", transport=lambda u, t: (200, b"abc", None), cap=2)[0] == "too_large"
    assert feeds.fetch("u", transport=lambda u, t: (200, b"abc", "br"))[0] == "decode_error"
    assert feeds.fetch(None)[0] == "config_error"
    assert feeds.fetch("u", transport=second, delays=(0, 0))[0] == "fetched" and len(calls) == 2


def test_feeds(spark, tmp_path):
    for name, text in (("rss", RSS), ("atom", ATOM), ("bad", "<rss"), ("empty", "<rss/>"), ("blank", "<rss><item/></rss>")):
        (tmp_path / name).write_text(text)
    raw = feeds.read_bytes(spark, [(n, str(tmp_path / n)) for n in ("rss", "atom", "bad", "empty", "blank", "missing")])
    found = feeds.results(raw, config.sources(spark, CONFIG)).persist()
    got = {r.name: r for r in found.collect()}
    assert {n: r.status for n, r in got.items()} == {"rss": "ok", "atom": "ok", "bad": "parse_error", "empty": "empty", "blank": "no_usable_entries", "missing": "network_error"}
    assert (got["rss"].entries_in_feed, got["rss"].dropped, got["rss"].naive_dates, got["rss"].depth_hours) == (4, 2, 1, 5.5)
    items = {r.url: r for r in feeds.items(found).collect()}
    assert (items["https://h/1"].title, items["https://h/1"].body, str(items["https://h/1"].published_at)) == ("One", "a longer & body", "2024-01-29")
    assert str(items["https://h/2"].published_at) == "2024-01-29" and items["https://h/2"].tags == ["ko"]
    assert str(items["https://arxiv.org/abs/2401.1v1"].published_at) == "2024-01-30"
    assert feeds.items(feeds.results(raw, config.sources(spark, CONFIG), limit=1)).count() == 2


def test_urls_in_order(spark, tmp_path):
    (tmp_path / "u").write_text("# list\nhttps://arxiv.org/abs/2\n\nhttps://arxiv.org/abs/1\n")
    wanted = feeds.read_urls(spark, str(tmp_path / "u"))
    fetched = spark.createDataFrame([("https://arxiv.org/abs/1", "a"), ("https://arxiv.org/abs/2", "b")], "url string, title string")
    assert [r.title for r in feeds.in_order(wanted, fetched).collect()] == ["b", "a"]
    with pytest.raises(Exception, match="not returned"):
        feeds.in_order(wanted, fetched.limit(1)).collect()
    with pytest.raises(Exception, match="unsupported"):
        feeds.in_order(spark.createDataFrame([(0, "https://h/a")], "ord int, url string"), fetched).collect()


def test_jsonl(spark, tmp_path):
    path = str(tmp_path / "log")
    assert tables.read_jsonl(spark, path, "a int").count() == 0
    tables.append_jsonl(spark.createDataFrame([(1,)], "a int"), path)
    tables.append_jsonl(spark.createDataFrame([(2,)], "a int"), path)
    (tmp_path / "log" / "part-x.json").write_text('\n{"a": 3}\n{"a": \n[1]\nnoise\n')
    assert sorted(r.a for r in tables.read_jsonl(spark, path, "a int").collect()) == [1, 2, 3]


def test_keyed_table(spark, tmp_path):
    t = tables.KeyedTable(spark, str(tmp_path / "t"), "k", "k string, v int")
    rows = lambda *x: spark.createDataFrame(list(x), "k string, v int")
    assert t.read().count() == 0
    t.upsert(rows(("a", 1), ("a", 2), ("b", 1)), order="v")
    t.upsert(rows(("b", 5)))
    t.put_new(rows(("b", 9), ("c", 1)))
    assert sorted(map(tuple, t.read().collect())) == [("a", 2), ("b", 5), ("c", 1)]
    (tmp_path / "t" / "v=99").mkdir()  # a version that never completed
    assert t.read().count() == 3
    for _ in range(4):
        t.put_new(rows(("c", 1)))
    assert len(t.versions()) == 3


def test_snapshot_and_golden(spark, tmp_path):
    s = tmp_path / "s"
    s.mkdir()
    for name, text in (("1", "old"), ("2", "new")):
        (s / f"{name}.json").write_text(json.dumps({"documents": [{"doc_id": "a", "text": text, "published": "2024-01-02T00"}]}))
    snap = tables.read_snapshot(spark, str(s))
    assert [r.text for r in snap.collect()] == ["new"]
    wanted = spark.createDataFrame([(0, "a")], "ord int, doc_id string")
    assert str(tables.pick(snap, wanted).first().published_at) == "2024-01-02"
    with pytest.raises(Exception, match="not in the snapshot: z"):
        tables.pick(snap, spark.createDataFrame([(0, "z")], "ord int, doc_id string")).collect()
    (tmp_path / "cases.json").write_text(json.dumps({"cases": [{"id": "c1", "expect": {"expected_doc_ids": ["a", "b"]}}, {"id": "c2", "expect": {"expected_doc_ids": None}}]}))
    assert tables.read_cases(spark, str(tmp_path / "cases.json")).count() == 2
    g = tmp_path / "g"
    g.mkdir()
    for name, status in (("a", "confirmed"), ("b", "draft"), ("_c", "confirmed"), ("TEMPLATE", "confirmed")):
        (g / f"{name}.json").write_text(json.dumps({"id": name, "status": status}))
    assert [r.id for r in tables.read_strict(spark, str(g), "id string, status string").collect()] == ["a"]
    assert tables.read_strict(spark, str(g), "id string, status string", drafts=True).count() == 2
    (g / "d.json").write_text('{"id": ')
    with pytest.raises(Exception):
        tables.read_strict(spark, str(g), "id string, status string").collect()


def test_export_is_the_same_twice(spark, tmp_path):
    rec = spark.createDataFrame([("a", "news"), ("b", "arxiv"), ("c", "news")], "doc_id string, source string")
    counts = spark.createDataFrame([("total", "", 3)], "block string, value string, n long")
    lines = []
    for out in ("x", "y"):
        tables.write_export(rec, counts, str(tmp_path / out), "e1", "1")
        lines.append(sorted((p.parent.name, p.read_text()) for p in (tmp_path / out / "records").rglob("part-*.json")))
    assert lines[0] == lines[1] and {n for n, _ in lines[0]} == {"source=news", "source=arxiv"}
    assert spark.read.json(str(tmp_path / "x" / "manifest")).first().export_id == "e1"


def test_notes(spark, tmp_path):
    spark.dataSource.register(notes.Notes)
    df = lambda text: spark.createDataFrame([("a.md", text), ("b.md", text)], "file string, content string")
    put = lambda text, how: df(text).write.format("notes").option("path", str(tmp_path)).option("on_conflict", how).mode("append").save()
    put("1", "skip")
    put("2", "skip")
    assert (tmp_path / "a.md").read_text() == "1"
    put("3", "overwrite")
    assert (tmp_path / "b.md").read_text() == "3" and len(list(tmp_path.iterdir())) == 2
    text = notes.front_matter({"title": "a: b", "date": "2024-01-01", "published_at": None, "source_url": "https://h/a", "tech_domain": ["LLM"], "prior_art": [], "impact_score": 3})
    yaml = pytest.importorskip("yaml")
    assert list(yaml.safe_load(text).items())[0] == ("title", "a: b") and yaml.safe_load(text)["published_at"] is None
    (tmp_path / "c.md").write_text(f"---\n{text}---\n\nbody\nsource_url: no\n")
    found = tables.front_matter_url(spark.read.text(str(tmp_path / "c.md"), wholetext=True).select(F.lit("c.md").alias("path"), "value"))
    assert found.first().source_url == "https://h/a"


def run_once(spark, tmp_path, ledger, store, seen, now):
    rows = [(f"https://h/{i}", f"T{i}", "body", "s" if i < 6 else "t", i, None if i == 5 else f"2024-01-{30 if i != 4 else 2}") for i in range(8)] + [("http://h/0/", "again", "b", "t", 99, "2024-01-30")]
    items = spark.createDataFrame(rows, "url string, title string, body string, source_name string, feed_ord int, published_at string").withColumn("published_at", F.col("published_at").cast("date"))

    def gate(df):
        found = df.select("doc_id", (F.col("feed_ord") != 1).alias("is_relevant"), F.lit(None).cast("string").alias("error"))
        out = spark.createDataFrame(found.collect(), "doc_id string, is_relevant boolean, error string")
        seen["gate"] = seen.get("gate", 0) + out.count()
        return out

    def extract(df):
        found = df.select("doc_id", F.lit("m").alias("model"), F.lit(1).alias("attempts"), F.lit("Paper").alias("release_type"), F.lit(3).alias("impact"), F.when(F.col("feed_ord") == 2, "schema").alias("error"))
        out = spark.createDataFrame(found.collect(), "doc_id string, model string, attempts int, release_type string, impact int, error string")
        seen["extract"] = seen.get("extract", 0) + out.count()
        return out

    return daily.run(items, ledger, store, gate, extract, F.lit("2024-01-31").cast("date"), F.lit("2024-01-24").cast("date"), "g|m", now, daily.Limits(gate=4, extract=3))


def test_daily_run(spark, tmp_path):
    ledger = tables.KeyedTable(spark, str(tmp_path / "ledger"), "doc_id", daily.LEDGER)
    store = tables.KeyedTable(spark, str(tmp_path / "store"), "doc_id", daily.STORE)
    seen = {}
    out = run_once(spark, tmp_path, ledger, store, seen, "1")
    state = {(r.url, r.feed_ord): r for r in out["items"].collect()}
    assert len(state) == 8 and state["https://h/4", 4].admission == "out_of_window" and state["https://h/5", 5].admission == "undated_admitted"
    assert seen == {"gate": 6, "extract": 5} and store.read().count() == 4  # 4 + 2 gate calls; 3 + 2 extractions, one broke its schema
    run_once(spark, tmp_path, ledger, store, seen, "2")
    assert seen["gate"] == 7  # the deferred one alone
    run_once(spark, tmp_path, ledger, store, seen, "3")
    assert ledger.read().where("quarantined").count() == 1
    before = dict(seen)
    run_once(spark, tmp_path, ledger, store, seen, "4")
    assert seen == before  # nothing is left to call
    loads = daily.to_load(ledger, store, spark.createDataFrame([], "doc_id string, path string"))
    assert {r.action for r in loads.collect()} == {"written"}


def test_model_client_is_called_once(spark, tmp_path):
    rows = spark.range(3).select(F.col("id").cast("string").alias("doc_id"))
    got = daily.call_model(rows, lambda r: {"doc_id": r.get("doc_id"), "answer": f"a{r.get('doc_id')}"}, "doc_id string, answer string", str(tmp_path / "raw"))
    assert sorted(r.answer for r in got.collect()) == ["a0", "a1", "a2"]


def test_stream_ingest_is_idempotent(spark, tmp_path):
    schema = "doc_id string, feed_ord int, title string"
    ledger = tables.KeyedTable(spark, str(tmp_path / "l"), "doc_id", schema)
    put = lambda rows: spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
    put([("a", 2, "late"), ("a", 1, "first"), ("b", 1, "b")])
    for _ in range(2):
        incremental.ingest(incremental.files(spark, str(tmp_path / "in"), schema), ledger, str(tmp_path / "c")).awaitTermination()
    put([("a", 3, "again"), ("c", 1, "c")])
    incremental.ingest(incremental.files(spark, str(tmp_path / "in"), schema), ledger, str(tmp_path / "c")).awaitTermination()
    assert sorted((r.doc_id, r.title) for r in ledger.read().collect()) == [("a", "first"), ("b", "b"), ("c", "c")]


def test_stream_streaks(spark, tmp_path):
    schema = "key string, run long, hit boolean"
    spark.createDataFrame([("k", 1, True), ("k", 2, True), ("k", 3, False), ("k", 4, True)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    q = incremental.streaks(incremental.files(spark, str(tmp_path / "in"), schema)).writeStream.format("memory").queryName("streaks").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.run, r.consecutive, r.first_seen) for r in spark.table("streaks").collect()) == [(1, 1, 1), (2, 2, 1), (4, 1, 4)]
