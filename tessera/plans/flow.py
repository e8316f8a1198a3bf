"""Queries on states, windows, quotas, backlog, loading and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import alerts, flow
from tessera.plans.fixtures import RAW_ITEMS, RUNS, TODAY, raw_items, runs
from tessera.plans.registry import query
from tessera.session import table
from tessera.vocab import BREAKER_AT


STATES = """states AS (
  SELECT d.doc_id, d.source, CASE WHEN d.doc_id % 4 = 0 AND l.doc_id IS NOT NULL THEN 'stored' WHEN d.doc_id % 4 = 0 THEN 'stored_outside_pipeline' WHEN l.doc_id IS NULL THEN 'needs_gate'
       WHEN l.doc_id % 37 = 0 THEN 'quarantined' WHEN l.doc_id % 9 = 0 THEN 'needs_gate' WHEN l.quality = 1 THEN 'needs_extraction' ELSE 'gate_skipped' END AS state
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def _states(spark, sf):
    ledger = table(spark, sf, "labels").select("doc_id", F.when(F.col("doc_id") % 9 == 0, "old|m").otherwise("gate|m").alias("gate_key"), (F.col("quality") == 1).alias("is_relevant"), (F.col("doc_id") % 37 == 0).alias("quarantined"))
    docs = table(spark, sf, "documents").select("doc_id", "source")
    joined = flow.with_state(docs, ledger, docs.where("doc_id % 4 = 0"))
    verdict = flow.valid_verdict(F.col("gate_key"), F.lit("gate|m"), F.col("is_relevant"))
    return joined.select("doc_id", "source", flow.item_state(F.col("stored"), F.col("in_ledger"), F.col("quarantined"), verdict).alias("state"))


@query(f"WITH {STATES} SELECT * FROM states")
def item_state(spark, sf):
    return _states(spark, sf)


@query(f"WITH {STATES} SELECT source, state, count(*) AS n FROM states GROUP BY 1, 2")
def state_tally(spark, sf):
    return _states(spark, sf).groupBy("source", "state").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {STATES}, sums AS (SELECT count(*) FILTER (WHERE state = 'needs_gate') AS g, count(*) FILTER (WHERE state = 'needs_extraction') AS e FROM states)
SELECT g AS needs_gate, e AS needs_extraction, least(g, 200) AS gate_max, least(e + least(g, 200), 100) AS extract_max FROM sums""")
def plan_counts(spark, sf):
    n = _states(spark, sf).agg(F.count_if(F.col("state") == "needs_gate").alias("needs_gate"), F.count_if(F.col("state") == "needs_extraction").alias("needs_extraction"))
    return n.select("*", flow.call_plan(F.col("needs_gate"), F.col("needs_extraction"), F.lit(200), F.lit(100)).alias("p")).select("needs_gate", "needs_extraction", "p.*")


ADMITTED = f"""admitted AS (
  SELECT *, CASE WHEN published_at IS NULL THEN CASE WHEN row_number() OVER (PARTITION BY source_name, published_at IS NULL ORDER BY feed_ord) <= 1 THEN 'undated_admitted' ELSE 'undated_deferred' END
       WHEN published_at >= date '{TODAY}' - 7 THEN 'in_window' ELSE 'out_of_window' END AS admission FROM raw_items)"""


def _admitted(spark, sf):
    today = F.lit(TODAY).cast("date")
    return flow.admission(raw_items(spark, sf), ["source_name"], "published_at", "feed_ord", today, F.date_sub(today, 7), most=1)


@query(f"WITH {RAW_ITEMS}, {ADMITTED} SELECT page_id, source_name, admission FROM admitted")
def admission(spark, sf):
    return _admitted(spark, sf).select("page_id", "source_name", "admission")


@query(f"WITH {RAW_ITEMS}, {ADMITTED} SELECT source_name, count(*) FILTER (WHERE admission = 'undated_admitted') AS admitted, count(*) FILTER (WHERE admission = 'undated_deferred') AS deferred FROM admitted GROUP BY 1")
def undated_cap(spark, sf):
    n = lambda v: F.count_if(F.col("admission") == v)
    return _admitted(spark, sf).groupBy("source_name").agg(n("undated_admitted").alias("admitted"), n("undated_deferred").alias("deferred"))


@query(f"""
WITH c AS (SELECT doc_id, date '{TODAY}' AS today, CASE WHEN doc_id % 3 = 1 THEN date '{TODAY}' - CAST(doc_id % 25 AS INTEGER) END AS anchor, doc_id % 3 > 0 AS seen, CASE WHEN doc_id % 2 = 0 THEN date '{TODAY}' - CAST(doc_id % 20 AS INTEGER) END AS carry FROM documents),
w AS (SELECT *, CASE WHEN anchor IS NOT NULL THEN greatest(7, today - anchor + 1) WHEN NOT seen OR carry IS NOT NULL THEN 7 ELSE 15 END AS wanted FROM c),
n AS (SELECT *, least(today - CAST(wanted AS INTEGER), coalesce(carry, today - CAST(wanted AS INTEGER))) AS need FROM w)
SELECT doc_id, greatest(need, today - 14) AS cutoff, CAST(today - greatest(need, today - 14) AS INTEGER) AS span_days, need < today - 14 AS capped FROM n""", text="cutoff")
def window_bounds(spark, sf):
    d, today = F.col("doc_id"), F.lit(TODAY).cast("date")
    ago = lambda k: F.date_sub(today, (d % k).cast("int"))
    w = flow.window_bounds(today, F.when(d % 3 == 1, ago(25)), d % 3 > 0, F.when(d % 2 == 0, ago(20)))
    return table(spark, sf, "documents").select("doc_id", w.alias("w")).select("doc_id", "w.*")


@query(f"""
WITH RECURSIVE {RUNS},
ordered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY day DESC) AS no FROM runs WHERE day <= date '2024-01-20'),
back AS (
  SELECT source, no, CASE WHEN drained THEN day END AS drained_on, CASE WHEN NOT drained THEN cutoff END AS carry, drained OR cutoff < date '2024-01-25' - 14 AS stop FROM ordered WHERE no = 1
  UNION ALL
  SELECT o.source, o.no, CASE WHEN o.drained THEN o.day END, CASE WHEN o.drained THEN b.carry ELSE least(coalesce(b.carry, o.cutoff), o.cutoff) END, o.drained OR least(coalesce(b.carry, o.cutoff), o.cutoff) < date '2024-01-25' - 14
  FROM back b JOIN ordered o ON o.source = b.source AND o.no = b.no + 1 WHERE NOT b.stop)
SELECT source, arg_max(drained_on, no) FILTER (WHERE drained_on IS NOT NULL) AS drained_on, arg_max(carry, no) AS carry FROM back GROUP BY source""", text="drained_on carry")
def window_history(spark, sf):
    return flow.window_history(runs(spark, sf).where("day <= date'2024-01-20'"), F.lit("2024-01-25").cast("date"), ["source"])


QUOTA = """ranked AS (SELECT *, row_number() OVER (PARTITION BY source, state = '{0}' ORDER BY doc_id) AS r FROM states),
inside AS (SELECT *, state = '{0}' AND r <= {1} AS in_source FROM ranked),
counted AS (SELECT *, sum(CASE WHEN in_source THEN 1 ELSE 0 END) OVER (ORDER BY source, doc_id) AS upto FROM inside)
SELECT doc_id, source, in_source AND upto <= {2} AS granted, state = '{0}' AND NOT (in_source AND upto <= {2}) AS deferred FROM counted"""


@query(f"WITH {STATES}, {QUOTA.format('needs_gate', 15, 200)}")
def gate_quota(spark, sf):
    return flow.quota(_states(spark, sf), F.col("state") == "needs_gate", "source", ["doc_id"], F.lit(15), 200).select("doc_id", "source", "granted", "deferred")


@query(f"WITH {STATES}, {QUOTA.format('needs_extraction', 4, 50)}")
def extract_quota(spark, sf):
    return flow.quota(_states(spark, sf), F.col("state") == "needs_extraction", "source", ["doc_id"], F.lit(4), 50).select("doc_id", "source", "granted", "deferred")


CALLS = "calls AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'error' THEN 'transport' WHEN 'signup' THEN 'schema' ELSE 'ok' END AS outcome FROM events)"


def _calls(spark, sf):
    kind = F.when(F.col("event_type") == "error", "transport").when(F.col("event_type") == "signup", "schema").otherwise("ok")
    return table(spark, sf, "events").select("event_id", "user_id", "ts", kind.alias("outcome"))


@query(f"""
WITH {CALLS},
isl AS (SELECT *, sum(CASE WHEN outcome = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM calls),
st AS (SELECT *, CAST(sum(CASE WHEN outcome = 'transport' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, i ORDER BY ts, event_id) AS BIGINT) AS streak FROM isl)
SELECT user_id, count(*) AS calls, max(streak) AS longest, arg_min(event_id, (ts, event_id)) FILTER (WHERE streak >= {BREAKER_AT}) AS tripped_at FROM st GROUP BY 1""", text="tripped_at")
def breaker_trips(spark, sf):
    out = flow.breaker(_calls(spark, sf), ["user_id"], ["ts", "event_id"], "outcome")
    return out.groupBy("user_id").agg(F.count(F.lit(1)).alias("calls"), F.max("streak").alias("longest"), F.min_by("event_id", F.when(F.col("streak") >= BREAKER_AT, F.struct("ts", "event_id"))).alias("tripped_at"))


@query("""
WITH k AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'error' THEN 'schema' WHEN 'signup' THEN 'release' ELSE 'ok' END AS kind FROM events),
s AS (SELECT *, sum(CASE WHEN kind = 'release' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS since FROM k),
f AS (SELECT *, sum(CASE WHEN kind = 'schema' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, since ORDER BY ts, event_id) AS failures FROM s)
SELECT event_id, CAST(failures AS BIGINT) AS failures, failures >= 2 AS quarantined FROM f""")
def quarantine(spark, sf):
    kind = F.when(F.col("event_type") == "error", "schema").when(F.col("event_type") == "signup", "release").otherwise("ok")
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", kind.alias("kind"))
    return flow.quarantine(e, ["user_id"], ["ts", "event_id"], "kind").select("event_id", "failures", "quarantined")


@query("""
SELECT event_type AS source, CAST(ts AS DATE) AS day, event_id AS id FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events n WHERE n.event_type = e.event_type AND n.event_id = e.event_id + 5)""", text="day")
def backlog_evictions(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("source"), F.to_date("ts").alias("day"), F.col("event_id").alias("id"))
    now = e.select("source", (F.col("id") - 5).alias("id"))
    return flow.evictions(e, now, ["source", "id"]).select("source", "day", "id")


@query(f"""
WITH {RUNS}, heads AS (SELECT source, day, ids, ids[1:5] AS head FROM runs),
pairs AS (SELECT source, day, ids, lag(head) OVER (PARTITION BY source ORDER BY day) AS before FROM heads)
SELECT source, day, coalesce(len(before) > 0 AND len(ids) > 0 AND NOT list_has_any(before, list_transform(ids, lambda x: x - 4)), false) AS rolled FROM pairs""", text="day")
def feed_rollover(spark, sf):
    from pyspark.sql import Window as W

    r = runs(spark, sf).withColumn("before", F.lag(F.slice("ids", 1, 5)).over(W.partitionBy("source").orderBy("day")))
    return r.select("source", "day", F.coalesce(flow.rollover(F.col("before"), F.transform("ids", lambda x: x - 4)), F.lit(False)).alias("rolled"))


@query("""
WITH f AS (SELECT event_type AS source, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS r FROM events)
SELECT source, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY r) AS head FROM f WHERE r <= 5 GROUP BY 1""")
def backlog_head(spark, sf):
    e = table(spark, sf, "events").withColumnRenamed("event_type", "source")
    return flow.backlog_head(e, ["source"], "event_id", "event_id").select("source", F.array_join(F.transform("head", lambda x: x.cast("string")), ",").alias("head"))


ALERTS = f"""{RUNS},
evaluated AS (SELECT DISTINCT day AS run, kind FROM runs, (VALUES ('source_error'), ('not_drained'), ('breaker')) AS v(kind) WHERE kind <> 'source_error' OR dayofmonth(day) % 6 <> 0),
ev AS (
  SELECT day AS run, 'source_error' AS kind, source, CASE WHEN k % 2 = 0 THEN CAST(k % 7 AS DOUBLE) - 2 END AS slack FROM runs WHERE NOT fetched
  UNION ALL SELECT day, 'not_drained', source, NULL FROM runs WHERE NOT drained
  UNION ALL SELECT day, 'breaker', NULL, NULL FROM runs WHERE tripped GROUP BY day),
keyed AS (SELECT *, kind || '|' || coalesce(source, '-') AS key FROM ev),
prev AS (SELECT *, lag(run) OVER (PARTITION BY key ORDER BY run) AS before FROM keyed),
fresh AS (SELECT p.*, CASE WHEN before IS NULL OR EXISTS (SELECT 1 FROM evaluated e WHERE e.kind = p.kind AND e.run > p.before AND e.run < p.run) THEN 1 ELSE 0 END AS new FROM prev p),
isl AS (SELECT *, sum(new) OVER (PARTITION BY key ORDER BY run) AS g FROM fresh),
cons AS (SELECT *, row_number() OVER (PARTITION BY key, g ORDER BY run) AS consecutive, min(run) OVER (PARTITION BY key, g) AS first_seen FROM isl),
sev AS (SELECT *, CASE WHEN kind IN ('source_error', 'breaker') AND slack IS NOT NULL THEN CASE WHEN slack <= 0 THEN 'critical' WHEN consecutive >= 2 OR kind = 'breaker' THEN 'warning' ELSE 'info' END
  WHEN kind IN ('source_error', 'breaker') THEN CASE WHEN consecutive >= 3 THEN 'critical' WHEN consecutive >= 2 OR kind = 'breaker' THEN 'warning' ELSE 'info' END
  WHEN consecutive >= 2 THEN 'warning' ELSE 'info' END AS severity FROM cons),
streaks AS (SELECT *, coalesce(list_position(['info', 'warning', 'critical'], severity) > list_position(['info', 'warning', 'critical'], lag(severity) OVER (PARTITION BY key, g ORDER BY run)), true) AS raised FROM sev)"""


def _alerts(spark, sf):
    r = runs(spark, sf)
    kinds = F.explode(F.array(*[F.lit(k) for k in ("source_error", "not_drained", "breaker")]))
    evaluated = r.select(F.col("day").alias("run"), kinds.alias("kind")).distinct().where((F.col("kind") != "source_error") | (F.dayofmonth("run") % 6 != 0))
    slack = F.when(F.col("k") % 2 == 0, (F.col("k") % 7).cast("double") - 2)
    none = F.lit(None).cast("double")
    events = r.where(~F.col("fetched")).select(F.col("day").alias("run"), F.lit("source_error").alias("kind"), "source", slack.alias("slack"))
    events = events.unionByName(r.where(~F.col("drained")).select(F.col("day").alias("run"), F.lit("not_drained").alias("kind"), "source", none.alias("slack")))
    events = events.unionByName(r.where("tripped").select(F.col("day").alias("run"), F.lit("breaker").alias("kind"), F.lit(None).cast("string").alias("source"), none.alias("slack")))
    return alerts.streaks(events, evaluated), evaluated


@query(f"WITH {ALERTS} SELECT key, run, CAST(consecutive AS INTEGER) AS consecutive, first_seen, severity, raised FROM streaks", text="run first_seen")
def alert_streaks(spark, sf):
    return _alerts(spark, sf)[0].select("key", "run", "consecutive", "first_seen", "severity", "raised")


@query(f"""WITH {ALERTS}, final AS (SELECT key, kind, arg_max(severity, run) AS severity, arg_max(consecutive, run) AS consecutive, max(run) AS last_seen FROM streaks GROUP BY 1, 2)
SELECT key, severity, CAST(consecutive AS INTEGER) AS consecutive, last_seen FROM final f WHERE NOT EXISTS (SELECT 1 FROM evaluated e WHERE e.kind = f.kind AND e.run > f.last_seen)""", text="last_seen")
def alerts_open(spark, sf):
    return alerts.open_after(*_alerts(spark, sf)).select("key", "severity", "consecutive", "last_seen")


@query(f"""WITH {ALERTS}, ends AS (SELECT key, kind, first_seen, max(run) AS last_seen FROM streaks GROUP BY 1, 2, 3)
SELECT key, first_seen, last_seen, min(e.run) AS closed_by FROM ends JOIN evaluated e ON e.kind = ends.kind AND e.run > last_seen GROUP BY 1, 2, 3 ORDER BY closed_by DESC, key LIMIT 50""", text="first_seen last_seen closed_by")
def alerts_closed(spark, sf):
    return alerts.closed(*_alerts(spark, sf)).select("key", "first_seen", "last_seen", "closed_by")


CASES = """cases AS (SELECT doc_id, ['preflight_mismatch', 'source_error', 'env_not_ready', 'breaker', 'not_drained', 'stale_feed', 'quarantined', 'lock_held'][doc_id % 8 + 1] AS kind,
  CAST(1 + doc_id % 4 AS INTEGER) AS consecutive, CASE WHEN doc_id % 5 > 1 THEN CAST(doc_id % 5 - 3 AS DOUBLE) END AS slack FROM documents)"""


@query(f"""WITH {CASES} SELECT doc_id, CASE WHEN kind = 'preflight_mismatch' THEN 'critical'
  WHEN kind IN ('source_error', 'env_not_ready', 'breaker') AND slack IS NOT NULL THEN CASE WHEN slack <= 0 THEN 'critical' WHEN consecutive >= 2 OR kind = 'breaker' THEN 'warning' ELSE 'info' END
  WHEN kind = 'env_not_ready' THEN CASE WHEN consecutive >= 2 THEN 'critical' ELSE 'warning' END
  WHEN kind IN ('source_error', 'breaker') THEN CASE WHEN consecutive >= 3 THEN 'critical' WHEN consecutive >= 2 OR kind = 'breaker' THEN 'warning' ELSE 'info' END
  WHEN kind = 'not_drained' THEN CASE WHEN consecutive >= 2 THEN 'warning' ELSE 'info' END WHEN kind IN ('stale_feed', 'quarantined') THEN 'warning' ELSE 'info' END AS severity FROM cases""")
def alert_severity(spark, sf):
    d = F.col("doc_id")
    kinds = ("preflight_mismatch", "source_error", "env_not_ready", "breaker", "not_drained", "stale_feed", "quarantined", "lock_held")
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (d % 8 + 1).cast("int"))
    return table(spark, sf, "documents").select("doc_id", alerts.severity(kind, 1 + d % 4, F.when(d % 5 > 1, (d % 5 - 3).cast("double"))).alias("severity"))


@query(f"""WITH {RUNS}, ok AS (SELECT * FROM runs WHERE fetched AND depth_hours IS NOT NULL),
d AS (SELECT source, arg_max(depth_hours, day) AS depth_hours, max(day) FILTER (WHERE NOT tripped) AS processed FROM ok GROUP BY 1)
SELECT source, depth_hours, processed, CAST(date '2024-02-02' - processed AS INTEGER) * 24.0 AS hours_since_success, round(depth_hours - CAST(date '2024-02-02' - processed AS INTEGER) * 24.0 - 24, 1) AS slack_hours FROM d WHERE processed IS NOT NULL""", text="processed")
def loss_clock(spark, sf):
    d = alerts.last_depths(runs(spark, sf), "source", "day")
    clock = alerts.loss_clock(F.col("depth_hours"), F.col("processed").cast("timestamp"), F.lit("2024-02-02").cast("timestamp"))
    return d.select("source", "depth_hours", "processed", clock.alias("c")).select("source", "depth_hours", "processed", "c.*")


@query("""
SELECT doc_id, CASE WHEN note AND policy = 'skip' THEN 'exists' WHEN NOT note AND coalesce(status IN ('written', 'deleted_by_user'), false) AND NOT rewrite THEN 'deleted_by_user' WHEN note AND policy = 'overwrite' THEN 'overwritten'
  WHEN note THEN 'failed' WHEN same AND policy = 'skip' THEN 'exists' WHEN same AND policy <> 'overwrite' THEN 'failed' ELSE 'written' END AS action
FROM (SELECT doc_id, doc_id % 3 = 0 AS note, ['skip', 'overwrite', 'version'][doc_id % 5 % 3 + 1] AS policy, [NULL, 'written', 'failed', 'deleted_by_user'][doc_id % 4 + 1] AS status, doc_id % 7 = 0 AS rewrite, doc_id % 11 = 0 AS same FROM documents)""")
def load_actions(spark, sf):
    d = F.col("doc_id")
    pick = lambda words, i: F.element_at(F.array(*[F.lit(w).cast("string") for w in words]), (i + 1).cast("int"))
    return table(spark, sf, "documents").select("doc_id", flow.load_action(d % 3 == 0, pick(("skip", "overwrite", "version"), d % 5 % 3), pick((None, "written", "failed", "deleted_by_user"), d % 4), d % 7 == 0, d % 11 == 0).alias("action"))


@query("""
WITH n AS (SELECT doc_id, source || '-' || lang AS base, row_number() OVER (PARTITION BY source || '-' || lang ORDER BY doc_id) AS r FROM documents)
SELECT doc_id, CASE WHEN r = 1 THEN base || '.md' WHEN r <= 999 THEN base || '-' || r || '.md' END AS file FROM n""")
def note_suffix(spark, sf):
    return flow.suffixed(table(spark, sf, "documents").withColumn("base", F.concat("source", F.lit("-"), "lang")), "base", "doc_id").select("doc_id", "file")


@query("SELECT doc_id, CAST(CASE WHEN doc_id % 3 = 0 THEN 0 WHEN doc_id % 4 > 0 THEN 3 WHEN doc_id % 2 = 0 AND doc_id % 5 >= 1 THEN 3 ELSE 1 END AS INTEGER) AS code FROM documents")
def run_exit_code(spark, sf):
    d = F.col("doc_id")
    return table(spark, sf, "documents").select("doc_id", flow.exit_code(d % 3, d % 4, d % 2 == 0, d % 5).alias("code"))


@query("SELECT 'k' || min(page_id) AS first_key, count(*) AS n FROM pages GROUP BY lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))")
def note_index(spark, sf):
    host = F.lower(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1))
    p = table(spark, sf, "pages").withColumn("path", F.lpad(F.col("page_id").cast("string"), 12, "0"))
    n = p.groupBy(host.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return flow.note_index(p, host).join(n, "key").select(F.concat(F.lit("k"), F.col("path").cast("long").cast("string")).alias("first_key"), "n")
