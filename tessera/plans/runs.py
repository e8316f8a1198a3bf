"""Queries on recorded calls, run history, numbered files and paper batches."""

from __future__ import annotations

import json
import re
import uuid
from datetime import date

from pyspark.sql import functions as F

from tessera.operators import calls, flow
from tessera.plans import daily, pipeline
from tessera.plans.evals import WINDOWS_SQL, _dashed
from tessera.plans.fixtures import RAW_ITEMS, RUNS, TODAY, raw_items, runs
from tessera.plans.flow import CALLS
from tessera.plans.identity import CUT, SLUG
from tessera.plans.registry import query
from tessera.session import table
from tessera.sources import history, lines, papers
from tessera.sources.scratch import scratch
from tessera.sources.tables import KeyedTable
from tessera.streaming import silence
from tessera.vocab import BREAKER_AT, EXTRACT_CEILING, GATE_CEILING, LOOKBACK_RUNS


def _outcome_client(item: dict) -> str:
    """A client whose transport fails on errors and whose schema fails on signups."""
    from tessera.operators.calls import SchemaMismatch

    if item["event_type"] == "error":
        raise ConnectionError("no answer")
    if item["event_type"] == "signup":
        raise SchemaMismatch("no JSON")
    return "{}"


@query(f"""
WITH {CALLS},
isl AS (SELECT *, sum(CASE WHEN outcome = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM calls),
st AS (SELECT *, sum(CASE WHEN outcome = 'transport' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, i ORDER BY ts, event_id) AS streak FROM isl),
op AS (SELECT *, coalesce(max(CASE WHEN streak >= {BREAKER_AT} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shut FROM st)
SELECT user_id, count(*) FILTER (WHERE shut = 0) AS calls, count(*) FILTER (WHERE shut = 1) AS "left", max(streak) FILTER (WHERE shut = 0) >= {BREAKER_AT} AS tripped,
       count(*) FILTER (WHERE shut = 0 AND outcome = 'ok') AS ok, count(*) FILTER (WHERE shut = 0 AND outcome = 'schema') AS schema_failed FROM op GROUP BY 1""")
def guarded_calls(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    got = calls.guarded(e, _outcome_client, ["user_id"], ["ts", "event_id"], "event_id", scratch(spark, "guarded"))
    kinds = got.groupBy("user_id").agg(F.count_if(F.col("outcome") == "ok").alias("ok"), F.count_if(F.col("outcome") == "schema").alias("schema_failed"))
    return calls.tripped(got, ["user_id"]).join(kinds, "user_id")


#: Calls that each run and source wants, and how many of them its limit grants: a third of what it collected.
TALLIES = f"""{RUNS}, wants AS (SELECT CAST(ts AS DATE) AS day, event_type AS source, count(*) FILTER (WHERE event_id % 3 = 0) AS w FROM events GROUP BY 1, 2),
t AS (SELECT day, source, cutoff, greatest(w - n // 3, 0) AS deferred FROM runs JOIN wants USING (day, source))"""


def _reports(spark, sf):
    """A report a day: tallies of the quotas, windows with the flags that follow from them, backlog heads of what was fetched."""
    e = table(spark, sf, "events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("source"), "event_id")
    n = e.groupBy("day", "source").agg(F.count(F.lit(1)).alias("n"))
    keyed = e.join(n, ["day", "source"]).withColumn("key", F.concat_ws("|", F.col("day").cast("string"), "source"))
    asked = flow.quota(keyed, F.col("event_id") % 3 == 0, "key", ["event_id"], F.floor(F.col("n") / 3), 10**12)
    tally = asked.groupBy("day", "source").agg(F.count_if("granted").alias("g"), F.count_if("deferred").alias("d"))
    r = runs(spark, sf).join(tally, ["day", "source"]).withColumn("tally", F.create_map(F.lit("gate_calls"), "g", F.lit("deferred_gate"), "d")).withColumn("flags", history.drained(F.col("tally")))
    text = lambda a: F.transform(a, lambda x: x.cast("string"))
    window = F.struct(F.col("day").cast("string").alias("today"), F.col("cutoff").cast("string").alias("cutoff"), "flags.window_drained", "flags.drained")
    backlog = F.when(F.col("fetched"), F.struct(text(F.slice("ids", 1, 5)).alias("head"), F.array().cast("array<string>").alias("gate")))
    as_map = lambda v: F.map_from_entries(F.collect_list(F.struct("source", v.alias("v"))))
    return r.groupBy("day").agg(as_map(F.col("tally")).alias("sources"), as_map(window).alias("window"), as_map(backlog).alias("backlog")).withColumn("run_id", F.concat(F.lit("pipeline-"), F.date_format("day", "yyyyMMdd"), F.lit("-000000")))


@query(f"""
WITH {TALLIES}, last AS (SELECT source, max(day) FILTER (WHERE deferred = 0) AS drained_on FROM t GROUP BY 1)
SELECT source, drained_on, (SELECT min(cutoff) FROM t WHERE t.source = last.source AND deferred > 0 AND (drained_on IS NULL OR day > drained_on)) AS carry FROM last""", text="drained_on carry")
def drained_marks(spark, sf):
    """The marks after all days, settled in two parts, as by two drivers of which the first was lost between the phases."""
    reports, at = _reports(spark, sf).persist(), scratch(spark, "history")
    marks = history.Marks(spark, at, scratch(spark, "marks"))
    early = F.col("day") <= F.lit("2024-01-10").cast("date")
    for part in (early, ~early):
        history.write_reports(reports.where(part).drop("day"), at)
        marks.settle()
    return marks.table.read().select("source", "drained_on", "carry")


@query(f"""
WITH {RUNS}, r AS (SELECT *, dense_rank() OVER (ORDER BY day DESC) AS ago FROM runs)
SELECT source, 'pipeline-' || strftime(max(day), '%Y%m%d') || '-000000' AS run_id, array_to_string(arg_max(ids, day)[1:5], ',') AS head FROM r WHERE fetched AND ago <= {LOOKBACK_RUNS} GROUP BY 1""")
def previous_backlog(spark, sf):
    at = scratch(spark, "history")
    history.write_reports(_reports(spark, sf).drop("day"), at)
    sources = [r.source for r in table(spark, sf, "events").select(F.col("event_type").alias("source")).distinct().limit(1000).collect()]  # configured sources
    found = history.latest(spark, at, "backlog", sources, most=LOOKBACK_RUNS)
    return found.rows.select("source", "run_id", F.array_join("value.head", ",").alias("head"))


@query(f"""
WITH {RAW_ITEMS}
SELECT source_name, max(published_at) AS newest, max(published_at) + CASE WHEN length(source_name) > 4 THEN 6 ELSE 3 END AS silent_from FROM raw_items
WHERE published_at <= date '2024-02-03' + 1 GROUP BY 1, length(source_name) HAVING date '2024-02-03' - max(published_at) > CASE WHEN length(source_name) > 4 THEN 5 ELSE 2 END""", text="newest silent_from")
def silence_stream(spark, sf):
    """silent_sources as a stream: all items of a run, and the timers that have fired by then."""
    at = scratch(spark, "silence")
    most = F.when(F.length("source_name") > 4, 5).otherwise(2)
    seen = raw_items(spark, sf).select(F.col("source_name").alias("source"), F.lit("2024-02-03 12:00:00").cast("timestamp").alias("fetched"), F.col("published_at").alias("published"), most.alias("most_days"))
    seen.write.parquet(f"{at}/in")
    silence.run(spark.readStream.schema(seen.schema).parquet(f"{at}/in"), f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return spark.read.schema(silence.OUT).parquet(f"{at}/out").select(F.col("source").alias("source_name"), "newest", "silent_from")


@query("""
WITH l AS (SELECT doc_id, source, length(text) % 9 AS k, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS line FROM documents)
SELECT source, line, CASE WHEN k = 0 THEN 'not a JSON object of the schema' WHEN k = 1 THEN 'no item_id' END AS error, CASE WHEN k > 1 THEN doc_id END AS item_id, CASE WHEN k > 1 THEN d.text END AS said
FROM l JOIN documents d USING (doc_id, source) WHERE k < 8""", text="item_id")
def numbered_lines(spark, sf):
    """Prediction files, one a source, read in byte ranges: line numbers, records, and broken lines; blank lines count but give no row."""
    at, k = scratch(spark, "predictions"), F.length("text") % 9
    whole = F.to_json(F.struct(F.col("doc_id").alias("item_id"), F.col("text").alias("said")))
    line = F.when(k == 0, F.concat(F.lit("{broken "), F.col("doc_id").cast("string"))).when(k == 1, F.to_json(F.struct(F.col("text").alias("said")))).when(k == 8, F.lit("")).otherwise(whole)
    docs = table(spark, sf, "documents").select("source", "doc_id", line.alias("value"))
    docs.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "value").write.partitionBy("source").text(at)
    got = lines.read_keyed(spark, f"{at}/*", "item_id long, said string")
    return got.select(F.regexp_extract("file", "source=([^/]*)/", 1).alias("source"), "line", "error", "record.item_id", "record.said")


def _hasty_client(item: dict) -> str:
    """Writes JSON by hand: it forgets to escape quotes until it is told of the error, and never thinks of control characters."""
    said = item["text"] or ""
    if item["error"]:
        said = said.replace("\\", "\\\\").replace('"', '\\"')
    return f'{{"said": "{said}"}}'


@query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_matches(coalesce(text, ''), '[\x00-\x1f]') AS control, regexp_matches(coalesce(text, ''), '["\\]') AS marks FROM documents)
SELECT doc_id, CAST(CASE WHEN control OR marks THEN 2 ELSE 1 END AS INTEGER) AS attempts, CASE WHEN control THEN 'schema' END AS error, CASE WHEN NOT control THEN length(t) END AS n_said FROM d""", text="n_said")
def corrected_records(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    got = calls.corrected(d, _hasty_client, "said string", scratch(spark, "corrected"))
    return got.select("doc_id", "attempts", "error", F.length("value.said").alias("n_said"))


@query("SELECT item_id, repeat, CASE WHEN repeat = 0 THEN 'first' ELSE 'second' END AS session, length(t) % 5 + 1 AS score FROM (SELECT doc_id AS item_id, coalesce(text, '') AS t, CAST(unnest([0, 1, 2]) AS INTEGER) AS repeat FROM documents JOIN labels USING (doc_id))")
def resumed_judgements(spark, sf):
    """A run of one repeat, then the same run with three: the second session asks for what is missing alone."""
    items = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(F.col("doc_id").alias("item_id"), "text")
    at = scratch(spark, "judged")

    def client(session):
        return lambda item: json.dumps({"session": session, "score": len(item["text"] or "") % 5 + 1})

    calls.judge(items, client("first"), "item_id", 1, at, parts=2)
    got = calls.judge(items, client("second"), "item_id", 3, at, parts=2)
    return got.select("item_id", "repeat", F.from_json("response", "session string, score bigint").alias("r")).select("item_id", "repeat", "r.session", "r.score")


def _paper_transport():
    """A server that answers a request for the second time only, and knows no paper whose id ends in 7."""
    seen: set[str] = set()

    def transport(url: str, timeout: float) -> tuple[int, bytes, None]:
        ids = url.split("id_list=")[1].split("&")[0].split(",")
        if url not in seen:
            seen.add(url)
            return 200, b"<feed xmlns='http://www.w3.org/2005/Atom'></feed>", None
        found = "".join(f"<entry><title>Paper {i}</title><link href='http://arxiv.org/abs/{i}'/><summary>s</summary></entry>" for i in ids if not i.endswith("7"))
        return 200, f"<feed xmlns='http://www.w3.org/2005/Atom'>{found}</feed>".encode(), None

    return transport


@query("""
SELECT row_number() OVER (ORDER BY page_id) - 1 AS ord, '2401.' || page_id AS paper_id, CASE WHEN page_id % 10 <> 7 THEN 'Paper 2401.' || page_id END AS title, CAST(2 AS INTEGER) AS attempts FROM pages""")
def paper_batches(spark, sf):
    p = table(spark, sf, "pages").select("page_id", F.concat(F.lit("https://arxiv.org/abs/2401."), F.col("page_id").cast("string")).alias("url"))
    # page_id numbers the pages; ord is its rank, by counts of ranges.
    first = p.agg(F.min("page_id")).first()[0]
    wanted = p.select((F.col("page_id") - F.lit(first)).alias("ord"), "url")
    answers = papers.fetch(wanted, transport=_paper_transport(), delays=(0, 0), batch=50)
    return papers.outcome(wanted, answers).select("ord", "paper_id", "title", "attempts")


GATE, EXTRACT, UNDATED = 15, 4, 5
#: The name of the source of documents without one, after all others, which get a "=" before theirs; the ceilings do not count it.
UNNAMED = "~"

_GATED = f"""items AS (SELECT doc_id, source, length(coalesce(text, '')) AS n, CASE WHEN doc_id % 11 <> 0 THEN date '{TODAY}' - CAST(doc_id * 7 % 21 AS INTEGER) END AS p FROM documents),
adm AS (SELECT *, p IS NULL AS undated, CASE WHEN p IS NULL THEN row_number() OVER (PARTITION BY source, p IS NULL ORDER BY doc_id) <= {UNDATED} ELSE p >= date '{TODAY}' - 7 END AS let_in FROM items),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source, let_in ORDER BY doc_id) AS r FROM adm),
inside AS (SELECT *, let_in AND r <= {GATE} AS in_source FROM ranked),
asked AS (SELECT *, in_source AND sum(CASE WHEN in_source THEN 1 ELSE 0 END) OVER (ORDER BY source, doc_id) <= least(200, {GATE} * (SELECT count(DISTINCT source) FROM documents)) AS granted FROM inside)"""


def _streaks(name: str, rows: str, granted: str, failed: str, neutral: str) -> str:
    """CTEs that add to rows whether the breaker was still closed before each granted row of its source."""
    return f"""{name}_i AS (SELECT *, sum(CASE WHEN {granted} AND NOT ({failed}) AND NOT ({neutral}) THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id) AS island FROM {rows}),
{name}_s AS (SELECT *, sum(CASE WHEN {granted} AND ({failed}) THEN 1 ELSE 0 END) OVER (PARTITION BY source, island ORDER BY doc_id) AS streak FROM {name}_i),
{name} AS (SELECT * EXCLUDE (island, streak), {granted} AND coalesce(max(streak) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < {BREAKER_AT} AS {name}_called FROM {name}_s)"""


@query(f"""
WITH {_GATED}, {_streaks('gate', 'asked', 'granted', 'n % 4 = 0', 'false')},
passed AS (SELECT *, gate_called AND n % 4 >= 2 AS ok FROM gate),
wants AS (SELECT *, ok AND row_number() OVER (PARTITION BY source, ok ORDER BY doc_id) <= {EXTRACT} AS taken FROM passed),
got AS (SELECT *, taken AND sum(CASE WHEN taken THEN 1 ELSE 0 END) OVER (ORDER BY source, doc_id) <= least(100, {EXTRACT} * (SELECT count(DISTINCT source) FROM documents)) AS picked FROM wants),
{_streaks('extract', 'got', 'picked', 'n % 11 = 0 AND n % 7 <> 0', 'n % 7 = 0')},
t AS (SELECT source, count(*) AS collected, count(*) FILTER (WHERE NOT let_in AND NOT undated) AS out_of_window, count(*) FILTER (WHERE NOT let_in AND undated) AS undated_deferred, count(*) FILTER (WHERE gate_called) AS gate_calls,
  count(*) FILTER (WHERE gate_called AND n % 4 = 0) AS gate_error, count(*) FILTER (WHERE ok) AS gate_passed, count(*) FILTER (WHERE let_in AND NOT gate_called) AS deferred_gate, count(*) FILTER (WHERE extract_called) AS extract_calls,
  count(*) FILTER (WHERE extract_called AND n % 7 = 0) AS extract_schema_failed, count(*) FILTER (WHERE extract_called AND n % 11 = 0 AND n % 7 <> 0) AS extract_transport_error,
  count(*) FILTER (WHERE extract_called AND n % 11 <> 0 AND n % 7 <> 0) AS extracted, count(*) FILTER (WHERE ok AND NOT extract_called) AS deferred_extraction FROM extract GROUP BY 1),
s AS (SELECT *, deferred_gate = 0 AND undated_deferred = 0 AS window_drained, CAST(sum(gate_error + extract_schema_failed + extract_transport_error) OVER () AS BIGINT) AS failures, CAST(sum(extracted) OVER () * 2 AS BIGINT) AS produced FROM t)
SELECT *, CAST(CASE WHEN failures = 0 THEN 0 WHEN produced > 0 THEN 3 ELSE 1 END AS INTEGER) AS exit_code FROM s""")
def run_report(spark, sf):
    """The report of one whole run over all documents, a row a source, however many there are; clients fail by the length of the text.

    What is past a limit is not dropped: it is counted as deferred, listed in the report's backlog, and the next run asks for it.
    """
    d = table(spark, sf, "documents")
    published = F.when(F.col("doc_id") % 11 != 0, F.date_sub(F.lit(TODAY).cast("date"), (F.col("doc_id") * 7 % 21).cast("int")))
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit(UNNAMED)).alias("source_name")
    items = d.select(named, F.concat(F.lit("https://h.example/"), F.col("doc_id").cast("string")).alias("url"), F.lit("t").alias("title"), F.coalesce("text", F.lit("")).alias("body"), published.alias("published_at"), F.col("doc_id").alias("feed_ord"))
    names = sorted(r.source_name for r in d.select(named).distinct().collect())  # configured sources
    at = scratch(spark, "run")
    keyed = lambda name, schema: KeyedTable(spark, f"{at}/{name}", "doc_id", schema)
    places = pipeline.Places(keyed("ledger", daily.LEDGER), keyed("store", daily.STORE), history.Marks(spark, f"{at}/runs", f"{at}/marks"), f"{at}/work")
    fetches = spark.createDataFrame([(n, "ok", None, None) for n in names], "source_name string, status string, detail string, depth_hours double")
    inputs = pipeline.Inputs(items, fetches, spark.createDataFrame([], "doc_id string, path string"))

    def gate(item):
        if len(item["body"]) % 4 == 0:
            raise ConnectionError("no answer")
        return json.dumps({"is_relevant": len(item["body"]) % 4 >= 2, "reason": ""})

    def extract(item):
        if len(item["body"]) % 7 == 0:
            return "no JSON"
        if len(item["body"]) % 11 == 0:
            raise ConnectionError("no answer")
        return json.dumps({"model": "m", "release_type": "Paper", "impact": 1})

    k = len(set(names) - {UNNAMED})
    rules = pipeline.Rules("g|m", date.fromisoformat(TODAY), "now", breaker="source", undated=UNDATED, gate_most=min(GATE_CEILING, GATE * k), extract_most=min(EXTRACT_CEILING, EXTRACT * k))
    report = pipeline.run(spark, "pipeline-1", [pipeline.Source(n, GATE, EXTRACT) for n in names], inputs, places, rules, gate, extract)
    kinds = ("collected", "out_of_window", "undated_deferred", "gate_calls", "gate_error", "gate_passed", "deferred_gate", "extract_calls", "extract_schema_failed", "extract_transport_error", "extracted", "deferred_extraction")
    # Both maps are merged by source before they are taken apart: a map in every row would grow with the square of the sources.
    merged = F.map_zip_with("sources", "window", lambda _, t, w: F.struct(t.alias("t"), w.window_drained.alias("drained")))
    rows = report.select(F.explode(merged).alias("name", "v"), "failures", "produced", "exit_code")
    source = F.when(F.col("name") != UNNAMED, F.substr("name", F.lit(2))).alias("source")
    return rows.select(source, *[F.coalesce(F.try_element_at("v.t", F.lit(k)), F.lit(0)).alias(k) for k in kinds], F.col("v.drained").alias("window_drained"), "failures", "produced", "exit_code")


_FIGURES = f"""{RUNS}, day_ AS (SELECT day, 'pipeline-' || strftime(day, '%Y%m%d') || '-000000' AS run_id, bool_or(tripped) AS shut FROM runs GROUP BY 1),
r AS (SELECT runs.*, run_id, shut FROM runs JOIN day_ USING (day))"""


def _alert_reports(spark, sf):
    """A report a day whose figures follow from its events."""
    r = runs(spark, sf)
    k = F.col("k")
    silent = F.when(k % 7 == 0, F.struct(F.col("cutoff").cast("string").alias("newest"), (k % 30).alias("age_days"), F.lit(7).cast("long").alias("max_silence_days")))
    fetch = F.struct(F.when(F.col("fetched"), "ok").otherwise("timeout").alias("status"), F.lit("slow").alias("detail"), F.when(F.col("source") == "view", "sample").otherwise("stream").alias("feed_kind"), "depth_hours", silent.alias("silent"))
    window = F.struct(F.col("day").cast("string").alias("today"), F.col("cutoff").cast("string").alias("cutoff"), F.datediff("day", "cutoff").alias("span_days"), (k % 9 == 0).alias("capped"), (k % 2 == 0).alias("window_drained"), "drained")
    tally = F.create_map(*[x for name, v in (("deferred_gate", k % 4), ("deferred_extraction", k % 5), ("evicted_gate", F.when(k % 8 == 0, k % 3).otherwise(0)), ("feed_rollover", F.when(k % 10 == 0, 1).otherwise(0)), ("quarantined_now", F.when(k % 11 == 0, 2).otherwise(0))) for x in (F.lit(name), v.cast("long"))])
    as_map = lambda v: F.map_from_entries(F.collect_list(F.struct("source", v.alias("v"))))
    days = r.groupBy("day").agg(as_map(fetch).alias("fetch"), as_map(window).alias("window"), as_map(tally).alias("sources"), F.max("tripped").alias("shut"))
    return days.select(F.concat(F.lit("pipeline-"), F.date_format("day", "yyyyMMdd"), F.lit("-000000")).alias("run_id"), F.col("day").cast("string").alias("started_at"), "fetch", "window", "sources", F.when(F.col("shut"), F.array(F.lit("extraction"))).otherwise(F.array().cast("array<string>")).alias("breaker_tripped"))


@query(f"""
WITH {_FIGURES},
ev AS (
  SELECT run_id, 'source_error' AS kind, source, 'fetch failed [timeout] slow' AS detail FROM r WHERE NOT fetched
  UNION ALL SELECT run_id, 'stale_feed', source, 'newest item ' || cutoff || ' (' || (k % 30) || ' days ago, at most 7)' FROM r WHERE k % 7 = 0
  UNION ALL SELECT run_id, 'window_capped', source, 'the window is at its cap (from ' || cutoff || ', ' || (day - cutoff) || ' days)' FROM r WHERE k % 9 = 0
  UNION ALL SELECT run_id, 'not_drained', source, 'waiting: gate ' || (k % 4) || ', undated 0, extraction ' || (k % 5) || '; the window''s anchor ' || CASE WHEN k % 2 = 0 THEN 'moves' ELSE 'stays' END FROM r WHERE NOT drained
  UNION ALL SELECT run_id, 'evicted', source, 'left the feed unprocessed: gate ' || (k % 3) || ', extraction 0' FROM r WHERE k % 8 = 0 AND k % 3 > 0
  UNION ALL SELECT run_id, 'feed_rollover', source, 'the whole head of the last feed is gone; items may be lost, their number is not known' FROM r WHERE k % 10 = 0 AND source <> 'view'
  UNION ALL SELECT run_id, 'quarantined', source, '2 quarantined in this run' FROM r WHERE k % 11 = 0
  UNION ALL SELECT run_id, 'breaker', NULL, 'extraction: transport failures in a row' FROM day_ WHERE shut),
ok AS (SELECT * FROM r WHERE fetched AND depth_hours IS NOT NULL AND source <> 'view'),
d AS (SELECT source, arg_max(depth_hours, day) AS depth, max(day) FILTER (WHERE NOT shut) AS done FROM ok GROUP BY 1),
clock AS (SELECT source, depth, CAST(date '2024-02-02' - done AS INTEGER) * 24.0 AS since, round(depth - CAST(date '2024-02-02' - done AS INTEGER) * 24.0 - 24, 1) AS slack FROM d WHERE done IS NOT NULL),
late AS (SELECT run_id, kind, source, CASE WHEN kind = 'source_error' THEN (SELECT slack FROM clock c WHERE c.source = ev.source) WHEN kind = 'breaker' THEN (SELECT min(slack) FROM clock) END AS slack,
       CASE WHEN kind NOT IN ('source_error', 'breaker') THEN detail END AS detail FROM ev)
SELECT *, slack IS NULL AS plain FROM late""", text="slack")
def report_events(spark, sf):
    """Reports to typed events with the time left before items are lost; reports are written and read back as the history is."""
    from tessera.operators import alerts

    at = scratch(spark, "history")
    history.write_reports(_alert_reports(spark, sf), at)
    reports = history.read_runs(spark, at, history.run_ids(spark, at))
    depths = alerts.last_depths(alerts.depth_rows(reports), "source", "run_id").join(reports.select(F.col("run_id").alias("processed"), F.to_timestamp("started_at").alias("at")), "processed")
    clocks = depths.select("source", "depth_hours", alerts.loss_clock(F.col("depth_hours"), F.col("at"), F.lit("2024-02-02").cast("timestamp")).alias("c")).select("source", "depth_hours", "c.*")
    got = alerts.with_loss(alerts.events_of(reports), clocks)
    deep = F.col("kind").isin("source_error", "breaker")
    return got.select("run_id", "kind", "source", (~F.contains("detail", F.lit("hours ago"))).alias("plain"), "slack", F.when(~deep, F.col("detail")).alias("detail"))


#: Rationales from texts: marks, tokens and verdicts between pieces whose lengths follow from the text, so that windows end at marks, arrows and their own length.
_SPLICED = """'① ' || substr(t, 1, n % 90) || ['충족', '미충족', '채웠다', ''][n % 4 + 1] || ' 2번 슬롯 ' || substr(t, 40, n % 260) || ['부분', '분모에서 제외', ''][n % 3 + 1] || ' -> ' || substr(t, 5, 9) || ' 충족 ③ (a) ' || ['담김', '이름만', '없음', ''][n % 4 + 1]
  || substr(t, 10, n % 50) || ' (b) 담김 (b) ' || ['담김', '없음'][n % 2 + 1] || ' (4) ' || ['빠졌다', '담겼다'][n % 2 + 1] || ' ④ (a) 담김'"""


@query(f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
r AS (SELECT doc_id AS event_id, source, t, n, {_SPLICED} AS rationale FROM d),
{WINDOWS_SQL.split("),", 1)[1].lstrip()},
judged AS (SELECT event_id AS doc_id, v, st, el, CASE WHEN n % 2 = 1 THEN 'error:slot 3 contradicts itself' WHEN n % 6 = 0 THEN 'error:slot 3 has other elements than its label' ELSE 'ok:||a=' || ['담김', '이름만', '없음', ''][n % 4 + 1] || ';b=담김|a=담김' END AS parsed FROM s),
slugs AS (SELECT doc_id, {CUT} AS slug FROM (SELECT doc_id, {SLUG.format('t')} AS s FROM d))
SELECT doc_id, {_dashed('v')} AS verdicts, {_dashed('st')} AS states, {_dashed('el')} AS elements, CASE WHEN contains(t, '①') OR contains(t, '③') OR contains(t, '④') THEN NULL ELSE parsed END AS parsed, slug,
       '## 요약' || chr(10) || chr(10) || regexp_replace(t, '^\\s+|\\s+$', '', 'g') || chr(10) || chr(10) || '## 관련 개념' || chr(10) || chr(10) || '- [[' || source || ']]' || chr(10) || chr(10) || '## 원문' || chr(10) || chr(10) || '[' || source || '에서 보기](u)' || chr(10) AS body
FROM judged JOIN slugs USING (doc_id) JOIN d USING (doc_id)""")
def sql_functions(spark, sf):
    """A query written as SQL with the registered functions, over every whole text."""
    from tessera.functions import sql

    sql.register(spark, "tessera_")
    view = f"documents_{uuid.uuid4().hex}"
    table(spark, sf, "documents").createOrReplaceTempView(view)
    spliced = re.sub(r"\[([^\]]*)\]\[(n % \d) \+ 1\]", r"element_at(array(\1), cast(\2 + 1 as int))", _SPLICED)
    dash = lambda c: f"array_join(transform({c}, x -> coalesce(x, '-')), '|')"
    return spark.sql(f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM {view}),
r AS (SELECT *, {spliced} AS rationale FROM d),
f AS (SELECT doc_id, tessera_slot_verdicts(rationale) AS v, tessera_slot_states(rationale) AS st, tessera_element_verdicts(rationale) AS el, tessera_parsed_elements(rationale, array(0, 0, if(n % 6 = 0, 1, 2), 1)) AS parsed, tessera_slug(t, 40) AS slug,
             tessera_note_body(t, array(), array(source, ''), source, 'u') AS body, t FROM r)
SELECT doc_id, {dash('v')} AS verdicts, {dash('st')} AS states, {dash('el')} AS elements, CASE WHEN contains(t, '①') OR contains(t, '③') OR contains(t, '④') THEN NULL ELSE parsed END AS parsed, slug, body FROM f""")
