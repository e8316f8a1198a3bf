"""Queries on records, manifests, scores, usage and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import evals, records, usage
from tessera.plans.fixtures import EXTRACTIONS, PRICES, extractions
from tessera.plans.registry import query
from tessera.session import table
from tessera.sources.scratch import scratch
from tessera.vocab import RELEASE_TYPES, TECH_DOMAINS

VOCAB = "[" + ", ".join(f"'{w}'" for w in TECH_DOMAINS) + "]"


def _broken(spark, sf):
    """Extractions with faults planted by doc_id."""
    d = F.col("doc_id")
    e = extractions(spark, sf)
    e = e.withColumn("tech_domains", F.when(d % 12 == 0, F.array(F.lit("Cooking"))).otherwise(F.col("tech_domains"))).withColumn("impact", F.when(d % 15 == 0, 6).otherwise(F.col("impact")))
    return e.withColumn("summary", F.col("text")).withColumn("rationale", F.concat("text", "lang"))


BROKEN = f"""{EXTRACTIONS}, broken AS (SELECT doc_id, source_name, CASE WHEN doc_id % 12 = 0 THEN ['Cooking'] ELSE tech_domains END AS tech_domains, release_type, CASE WHEN doc_id % 15 = 0 THEN 6 ELSE impact END AS impact, text AS summary, text || lang AS rationale FROM extractions)"""


@query(f"""WITH {BROKEN} SELECT doc_id, array_to_string(list_filter([CASE WHEN length(summary) NOT BETWEEN 20 AND 600 THEN 'summary_length' END, CASE WHEN doc_id % 12 = 0 THEN 'domain_vocab' END,
  CASE WHEN impact > 5 THEN 'score_range' END, CASE WHEN length(rationale) NOT BETWEEN 15 AND 300 THEN 'rationale_length' END], lambda x: x IS NOT NULL), ',') AS violations FROM broken""")
def validate_ontology(spark, sf):
    v = records.violations(F.col("summary"), F.col("tech_domains"), F.col("release_type"), F.col("prior_art"), F.col("impact"), F.col("rationale"))
    return _broken(spark, sf).select("doc_id", F.array_join(v, ",").alias("violations"))


@query(f"WITH {BROKEN}, x AS (SELECT source_name, unnest(tech_domains) AS value FROM broken) SELECT value, count(*) AS n FROM x WHERE NOT list_contains({VOCAB}, value) GROUP BY 1")
def vocab_violations(spark, sf):
    bad = F.explode(F.array_except("tech_domains", F.array(*[F.lit(w) for w in TECH_DOMAINS])))
    return _broken(spark, sf).select(bad.alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {EXTRACTIONS}
SELECT 'total' AS block, '' AS value, count(*) AS n FROM extractions
UNION ALL SELECT 'indexable', '', count(*) FILTER (WHERE length(text) >= 1) FROM extractions
UNION ALL SELECT 'excluded_empty_text', '', count(*) FILTER (WHERE length(text) < 1) FROM extractions
UNION ALL SELECT 'companies_unresolved', '', CAST(sum(len(list_filter(companies, lambda c: NOT c.resolved))) AS BIGINT) FROM extractions
UNION ALL SELECT 'by_source_name', source_name, count(*) FROM extractions GROUP BY 2
UNION ALL SELECT 'by_release_type', release_type, count(*) FROM extractions GROUP BY 2
UNION ALL SELECT 'by_tech_domain', d, count(*) FROM (SELECT unnest(tech_domains) AS d FROM extractions) GROUP BY 2""")
def manifest_counts(spark, sf):
    return records.manifest_counts(extractions(spark, sf))


def _store(spark, sf):
    e = extractions(spark, sf)
    p = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), "url")
    ontology = F.struct("tech_domains", "release_type", F.transform("companies", lambda c: c.canonical).alias("companies"), "prior_art", F.col("impact").alias("impact_score"))
    gate = F.when(F.col("doc_id") % 3 > 0, F.struct(F.lit("gate-m").alias("model"), F.lit("gate-v1").alias("prompt_name")))
    extraction = F.struct("model", F.lit("extract-v1").alias("prompt_name"), F.sha2(F.lit("extract-v1"), 256).alias("prompt_sha256"), F.lit("2024-01-31T09:00:00+09:00").alias("extracted_at"))
    return e.join(p, "doc_id").select(F.col("doc_id").alias("ord"), "url", F.concat(F.lit("Item "), F.col("doc_id").cast("string")).alias("title"), F.col("text").alias("body"), F.array("lang").alias("tags"), "source_name",
                                      F.when(F.col("doc_id") % 11 != 0, F.lit("2024-01-30")).alias("published_at"), F.lit("2024-01-31").alias("collected_at"), gate.alias("gate"), extraction.alias("extraction"), ontology.alias("ontology"))


@query(f"""WITH {EXTRACTIONS}
SELECT e.doc_id AS ord, 'news' AS source, left(md5(left(text, 4000)), 8) AS digest, CAST(length(left(text, 4000)) AS BIGINT) AS text_chars, length(text) > 4000 AS text_truncated, 'feed_excerpt' AS locator, CASE WHEN doc_id % 11 <> 0 THEN '2024-01-30' END AS published_at,
       CASE WHEN doc_id % 3 > 0 THEN 'gate-m' END AS gate_model, model AS extraction_model, array_to_string(tech_domains, ',') AS domains
FROM extractions e JOIN pages ON page_id = doc_id""")
def export_records(spark, sf):
    store = _store(spark, sf)
    named = records.export_records(store.withColumn("title", F.col("ord").cast("string")), "1", "v1")
    return named.select(F.col("title").cast("long").alias("ord"), "source", F.left(F.md5("text"), F.lit(8)).alias("digest"), "text_chars", "text_truncated", "locator", "published_at", F.col("provenance.gate_model").alias("gate_model"),
                        F.col("provenance.extraction_model").alias("extraction_model"), F.array_join("ontology.tech_domains", ",").alias("domains"))


MERGED = """snap AS (SELECT doc_id, 'old ' || doc_id AS title, text, 'http://s/' || doc_id AS url FROM documents),
rec AS (SELECT page_id * 5 AS doc_id, 'new ' || page_id AS title, html AS text, url FROM pages),
merged AS (SELECT coalesce(s.doc_id, r.doc_id) AS doc_id, coalesce(s.title, r.title) AS title, coalesce(s.text, r.text) AS text, coalesce(r.url, s.url) AS url, s.doc_id IS NOT NULL AND r.doc_id IS NOT NULL AS merged FROM snap s FULL JOIN rec r ON s.doc_id = r.doc_id)"""


def _snapshot(spark, sf):
    """All documents as the snapshot, and all pages as records; their ids are spread, so that some are in one of them alone."""
    side = lambda d, word, k, body: d.select((F.col(k) * (5 if k == "page_id" else 1)).alias("doc_id"), F.concat(F.lit(word), F.col(k).cast("string")).alias("title"), F.col(body).alias("text"), F.lit("abstract").alias("locator"), "url", F.lit("o").alias("ontology"))
    docs = table(spark, sf, "documents").withColumn("url", F.concat(F.lit("http://s/"), F.col("doc_id").cast("string")))
    return side(docs, "old ", "doc_id", "text"), side(table(spark, sf, "pages"), "new ", "page_id", "html").withColumn("ord", F.col("doc_id"))


@query(f"WITH {MERGED} SELECT * FROM merged")
def merge_snapshot(spark, sf):
    return records.merge(*_snapshot(spark, sf), "ord").select("doc_id", "title", "text", "url", F.coalesce("merged", F.lit(False)).alias("merged"))


@query(f"WITH {MERGED}, pairs AS (SELECT event_id % 10 AS case_id, event_id AS doc_id FROM events) SELECT case_id, doc_id, 'missing' AS why FROM pairs p WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE m.doc_id = p.doc_id)")
def golden_pairs_broken(spark, sf):
    snap, rec = _snapshot(spark, sf)
    pairs = table(spark, sf, "events").select((F.col("event_id") % 10).alias("case_id"), F.col("event_id").alias("doc_id"))
    return records.broken_pairs(pairs, snap, records.merge(snap, rec, "ord"))


_CHECKS = ["end_to_end", "provenance", "prompt_hash", "text_origin", "arxiv_merge", "golden_pairs", "reproducible", "text_limit", "indexable", "vocabulary", "null_dates", "manifest", "consumer"]


#: Faults planted in the records: each check but arxiv_merge, which only a wrong merge can fail, counts some; a twelfth of the documents carry none.
_FAULTS = """b AS (SELECT doc_id AS ord, source, length(left(text, 4000)) AS chars FROM pages JOIN documents ON page_id = doc_id), r AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE ord % 43 = 5),
c AS (SELECT count(*) AS n, (SELECT count(*) FROM b) AS base, count(*) FILTER (WHERE ord % 31 = 1) AS k1, count(*) FILTER (WHERE ord % 37 = 2) AS k2, count(*) FILTER (WHERE ord % 50 = 0) AS k3, count(*) FILTER (WHERE ord % 41 = 3) AS k4,
  (SELECT count(*) FROM b WHERE ord % 70 = 0) AS k6, (SELECT count(*) FROM b WHERE ord % 43 = 5) AS k7, count(*) FILTER (WHERE ord % 47 = 6) AS k8,
  count(*) FILTER (WHERE ((chars >= 1) <> (ord % 53 = 7)) <> (ord % 41 <> 3 AND chars + CASE WHEN ord % 47 = 6 THEN 1 ELSE 0 END >= 1)) AS k9, count(*) FILTER (WHERE ord % 59 = 8) AS k10, count(*) FILTER (WHERE ord % 61 = 9) AS k11, CAST(count(*) FILTER (WHERE source = 'src3') > 0 AS INT) AS k12 FROM r)"""


@query(f"WITH {_FAULTS} SELECT number, name, failures, CASE WHEN number = 13 THEN 'PENDING' WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT CAST(unnest(range(1, 14)) AS INTEGER) AS number, unnest([" + ", ".join(f"'{c}'" for c in _CHECKS) + """]) AS name,
  unnest([k1 + n - base + k7, k2, k3, k4, 0, k6, k7, k8, k9, k10, k11, k12, 0]) AS failures FROM c)""")
def conformance_report(spark, sf):
    """The contract's checks on records with planted faults, written once and then read by each check."""
    store = _store(spark, sf)
    sha = F.when(F.col("ord") % 50 == 0, F.lit("other")).otherwise(F.col("extraction.prompt_sha256"))
    store = store.withColumn("url", F.concat(F.lit("https://h/"), F.col("ord").cast("string"))).withColumn("extraction", F.col("extraction").withField("prompt_sha256", sha))
    clean, at = records.export_records(store, "1", "v1"), scratch(spark, "records")
    ord_ = F.regexp_extract("url", r"(\d+)$", 1).cast("long")
    is_ = lambda k, r: ord_ % k == r
    rec = clean.unionByName(clean.where(is_(43, 5)).withColumn("title", F.lit("again"))).withColumns({
        "contract_version": F.when(is_(31, 1), "0").otherwise(F.col("contract_version")), "text_origin": F.when(is_(41, 3), "summary").otherwise(F.col("text_origin")), "text_chars": F.col("text_chars") + F.when(is_(47, 6), 1).otherwise(0),
        "indexable": F.col("indexable") != is_(53, 7), "published_at": F.when(is_(61, 9), "").otherwise(F.col("published_at")), "ontology": F.col("ontology").withField("release_type", F.when(is_(59, 8), "Odd").otherwise(F.col("ontology.release_type"))),
        "provenance": F.col("provenance").withField("extraction_model", F.when(is_(37, 2), " ").otherwise(F.col("provenance.extraction_model")))})
    rec.write.parquet(at)
    rec = spark.read.schema(rec.schema).parquet(at)
    counts = records.manifest_counts(rec.select("text", "source_name", F.col("ontology.release_type").alias("release_type"), F.col("ontology.tech_domains").alias("tech_domains"), F.array().cast("array<struct<resolved:boolean>>").alias("companies")))
    counts = counts.where("not (block = 'by_source_name' and value = 'src3')")
    prompts = spark.sql("SELECT 'extract-v1' AS prompt_version, sha2('extract-v1', 256) AS sha256")
    snapshot = rec.where("title <> 'again' and length(text) % 2 = 0").select("doc_id", "title", "text", "locator", "url")
    pairs = store.where("ord % 70 = 0").select(F.lit("c").alias("case_id"), F.concat(F.lit("gone-"), F.col("ord").cast("string")).alias("doc_id"))
    return records.checks(rec, counts, prompts, snapshot, pairs, "1", table(spark, sf, "pages").join(table(spark, sf, "documents"), F.col("page_id") == F.col("doc_id")).count())


GOLDEN = f"""{EXTRACTIONS},
golden AS (SELECT l.doc_id AS item_id, l.quality, e.tech_domains AS ed, e.release_type AS er, CASE WHEN l.doc_id % 6 <> 0 THEN e.impact END AS ei, list_transform(e.companies, lambda c: c.canonical) AS ec, e.prior_art AS ep FROM labels l JOIN extractions e ON l.doc_id = e.doc_id),
pred AS (SELECT doc_id AS pid, tech_domains AS ad, release_type AS ar, impact AS ai, list_transform(companies, lambda c: c.canonical) AS ac, prior_art AS ap FROM extractions),
both_ AS (SELECT * FROM golden JOIN pred ON pid = item_id + quality),
scored AS (SELECT item_id,
  CASE WHEN len(list_distinct(ed || ad)) = 0 THEN 1.0 ELSE round(len(list_intersect(ed, ad)) / len(list_distinct(ed || ad)), 4) END AS domains, CASE WHEN er = ar THEN 1.0 ELSE 0.0 END AS release,
  CASE WHEN ei IS NULL THEN 0.0 WHEN abs(ei - ai) = 0 THEN 1.0 WHEN abs(ei - ai) = 1 THEN 0.5 ELSE 0.0 END AS impact, ei IS NOT NULL AS impact_graded,
  CASE WHEN len(list_distinct(ec || ac)) = 0 THEN 1.0 ELSE round(len(list_intersect(ec, ac)) / len(list_distinct(ec || ac)), 4) END AS companies, CASE WHEN len(list_distinct(ep || ap)) = 0 THEN 1.0 ELSE round(len(list_intersect(ep, ap)) / len(list_distinct(ep || ap)), 4) END AS prior_art FROM both_)"""


def _pairs(spark, sf):
    e = extractions(spark, sf).select("doc_id", F.struct("tech_domains", "release_type", F.col("impact"), F.transform("companies", lambda c: c.canonical).alias("companies"), "prior_art").alias("r"))
    labels = table(spark, sf, "labels")
    impact = F.when(F.col("doc_id") % 6 != 0, F.col("r.impact"))
    golden = labels.join(e, "doc_id").select(F.col("doc_id").alias("item_id"), F.col("r").withField("impact", impact).alias("expected"))
    predictions = labels.select(F.col("doc_id").alias("item_id"), (F.col("doc_id") + F.col("quality")).alias("pid")).join(e.select(F.col("doc_id").alias("pid"), F.col("r").alias("actual")), "pid").select("item_id", "actual")
    return evals.paired(golden, predictions).withColumn("scores", evals.field_scores("expected", "actual"))


@query(f"WITH {GOLDEN} SELECT item_id, domains, release, impact, impact_graded, companies, prior_art FROM scored")
def field_scores(spark, sf):
    s = F.col("scores")
    return _pairs(spark, sf).select("item_id", s[0].score.alias("domains"), s[1].score.alias("release"), s[2].score.alias("impact"), s[2].graded.alias("impact_graded"), s[3].score.alias("companies"), s[4].score.alias("prior_art"))


ACCURACY = "round(CASE WHEN impact_graded THEN (domains + release + impact) / 3 ELSE (domains + release) / 2 END, 4)"


@query(f"WITH {GOLDEN} SELECT item_id, {ACCURACY} AS accuracy FROM scored")
def field_accuracy(spark, sf):
    return _pairs(spark, sf).select("item_id", evals.field_accuracy(F.col("scores")).alias("accuracy"))


@query(f"""WITH {GOLDEN}, rows_ AS (SELECT item_id, {ACCURACY} AS accuracy, CASE WHEN item_id % 4 > 0 THEN 1 + item_id % 5 END AS f FROM scored)
SELECT count(*) AS items, 1 AS repeat, round(avg(accuracy), 3) AS field_accuracy, count(f) AS judged, round(avg(f), 4) AS faithfulness, round(avg(accuracy), 4) >= 0.9 AS accuracy_passed, round(avg(f), 4) >= 4 AS faithfulness_passed FROM rows_""")
def run_accuracy(spark, sf):
    rows = _pairs(spark, sf).select("item_id", evals.field_accuracy(F.col("scores")).alias("accuracy"), F.when(F.col("item_id") % 4 > 0, 1 + F.col("item_id") % 5).alias("faithfulness"))
    out = evals.run_summary(rows)
    return out.select("items", F.col("repeat").cast("int").alias("repeat"), F.round("field_accuracy", 3).alias("field_accuracy"), "judged", "faithfulness", "accuracy_passed", "faithfulness_passed")


@query("""
WITH c AS (SELECT user_id, 1 + event_id % 5 AS s, count(*) AS n FROM events GROUP BY 1, 2),
t AS (SELECT user_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(s * n) AS DOUBLE) AS a, CAST(sum(s * s * n) AS DOUBLE) AS b, arg_min(s, (-n, s)) AS mode, max(n) AS top, min(s) AS minimum, max(s) AS maximum, string_agg(s || '=' || n, ';' ORDER BY s) AS distribution FROM c GROUP BY 1)
SELECT user_id, n, round(a / n, 3) AS mean, CASE WHEN n > 1 THEN round(sqrt(greatest(0.0, (b - a * (a / n)) / (n - 1))), 3) END AS stdev, mode, minimum, maximum, maximum - minimum AS spread, round(top / n, 3) AS mode_ratio, distribution FROM t""")
def axis_stats(spark, sf):
    e = table(spark, sf, "events").select("user_id", (1 + F.col("event_id") % 5).alias("score"))
    return evals.axis_stats(e, ["user_id"], "score")


STATES4 = "['full', 'partial', 'none', 'excluded']"


@query(f"""
WITH s AS (SELECT event_id, {STATES4}[event_id % 3 + 1] AS a, {STATES4}[event_id % 4 + 1] AS b, {STATES4}[event_id * 3 % 4 + 1] AS c, CASE WHEN event_id % 13 <> 0 THEN {STATES4}[event_id // 7 % 4 + 1] END AS d FROM events),
p AS (SELECT *, list_sum(list_transform([a, b, c, d], lambda x: CASE x WHEN 'full' THEN 1.0 WHEN 'partial' THEN 0.5 ELSE 0.0 END)) AS points, len(list_filter([a, b, c, d], lambda x: x <> 'excluded')) AS n FROM s)
SELECT event_id, points, CAST(n AS INTEGER) AS denominator, CAST(CASE WHEN d IS NULL THEN NULL WHEN a = 'none' THEN 1 WHEN points / n >= 1 THEN 5 WHEN points / n >= 0.75 THEN 4 WHEN points / n >= 0.5 THEN 3 ELSE 2 END AS INTEGER) AS score FROM p""", text="points score")
def completeness_score(spark, sf):
    e = F.col("event_id")
    pick = lambda i: F.element_at(F.array(*[F.lit(w) for w in ("full", "partial", "none", "excluded")]), (i + 1).cast("int"))
    states = F.array(pick(e % 3), pick(e % 4), pick(e * 3 % 4), F.when(e % 13 != 0, pick(F.floor(e / 7) % 4)))
    return table(spark, sf, "events").select("event_id", evals.completeness(states).alias("c")).select("event_id", "c.*")


@query("SELECT event_id % 4 AS held, event_id % 3 + 1 AS n, CASE WHEN event_id % 4 >= event_id % 3 + 1 THEN 'full' WHEN event_id % 4 > 0 THEN 'partial' ELSE 'none' END AS state, count(*) AS k FROM events GROUP BY 1, 2, 3")
def element_states(spark, sf):
    e = table(spark, sf, "events").select((F.col("event_id") % 4).alias("held"), (F.col("event_id") % 3 + 1).alias("n"))
    return e.groupBy("held", "n", evals.state_of_elements(F.least("held", "n"), F.col("n")).alias("state")).agg(F.count(F.lit(1)).alias("k"))


#: Rationales by event_id, with every kind of mark and token.
RATIONALES = ("①사건: 충족 ②범위: 미충족 ③정도: 부분 충족 ④경위: 분모에서 제외 → 분모 3", "(1) 사건이 담겼다 (2) 없다 (3) 채웠다 (4) 불충족 -> 3/4 슬롯", "①사건: (a) 담김 / (b) 이름만 ②범위: (a) 없음", "", "1번 슬롯 충족, 슬롯 2 미달")


def _rationales(spark, sf):
    r = F.element_at(F.array(*[F.lit(x) for x in RATIONALES]), (F.col("event_id") % len(RATIONALES) + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", "user_id", r.alias("rationale"))


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _slots_sql(reading: str) -> str:
    """A list of the first reading of each slot; reading is SQL on x.w."""
    return "[" + ", ".join(f"list_filter(list_transform(windows, lambda x: CASE WHEN x.slot = {k} THEN {reading} END), lambda x: x IS NOT NULL)[1]" for k in range(1, 5)) + "]"


_TOKEN = f"regexp_extract(x.w, {_sql_text(evals.STATE)})"
VERDICTS_SQL = _slots_sql(f"CASE WHEN regexp_matches(x.w, {_sql_text(evals.NO)}) THEN 'no' WHEN regexp_matches(x.w, {_sql_text(evals.YES)}) THEN 'yes' END")
STATES_SQL = _slots_sql(f"CASE WHEN starts_with({_TOKEN}, '분모') THEN 'excluded' WHEN {_TOKEN} = '부분' THEN 'partial' WHEN {_TOKEN} = '충족' THEN 'full' WHEN {_TOKEN} <> '' THEN 'none' END")
ELEMENTS_SQL = _slots_sql("nullif(concat_ws(';', " + ", ".join(f"CASE WHEN regexp_matches(x.w, '\\({e}\\)\\s*({evals.HELD})') THEN '{e}=' || regexp_extract_all(x.w, '\\({e}\\)\\s*({evals.HELD})', 1)[-1] END" for e in "abc") + "), '')")
#: Rationales cut into windows by DuckDB.
WINDOWS_SQL = f"""r AS (SELECT *, [{", ".join(map(_sql_text, RATIONALES))}][event_id % {len(RATIONALES)} + 1] AS rationale FROM events),
cut AS (SELECT *, list_transform(string_split(regexp_replace(rationale, {_sql_text("(" + evals.MARKS + ")")}, chr(57344) || '\\1' || chr(57345), 'g'), chr(57344))[2:], lambda p: string_split(p, chr(57345))) AS pieces FROM r),
w AS (SELECT *, list_transform(pieces, lambda p: {{'slot': CAST(regexp_extract(translate(p[1], '①②③④', '1234'), '[1-4]') AS INT), 'w': left(string_split_regex(p[2], '→|->')[1], 200)}}) AS windows FROM cut),
s AS (SELECT *, {VERDICTS_SQL} AS v, {STATES_SQL} AS st, {ELEMENTS_SQL} AS el FROM w)"""


def _dashed(name: str) -> str:
    return f"array_to_string(list_transform({name}, lambda x: coalesce(x, '-')), '|')"


@query(f"WITH {WINDOWS_SQL} SELECT event_id, {_dashed('v')} AS verdicts, {_dashed('st')} AS states, {_dashed('el')} AS elements FROM s")
def slot_states(spark, sf):
    r, cut = _rationales(spark, sf).withColumn("cut", evals.windows(F.col("rationale"))), F.col("cut")
    join = lambda a: F.concat_ws("|", F.transform(a, lambda x: F.coalesce(x, F.lit("-"))))
    return r.select("event_id", join(evals.slot_verdicts("rationale", cut)).alias("verdicts"), join(evals.slot_states("rationale", cut)).alias("states"), join(evals.element_verdicts("rationale", cut)).alias("elements"))


@query("""SELECT event_id, CAST([3, 4, NULL, NULL, NULL][event_id % 5 + 1] AS VARCHAR) AS denominator FROM events""", text="denominator")
def stated_denominator(spark, sf):
    return _rationales(spark, sf).select("event_id", T.stated_denominator(F.col("rationale")).alias("denominator"))


def _share(cond: str, among: str) -> str:
    return f"round(avg(CASE WHEN {among} THEN CAST(coalesce({cond}, false) AS INT) END), 3)"


_WHOLE = "(len(list_filter(st, lambda x: x IS NULL)) = 0)"
_POINTS = "list_sum(list_transform(st, lambda x: CASE x WHEN 'full' THEN 1.0 WHEN 'partial' THEN 0.5 ELSE 0.0 END)) / nullif(len(list_filter(st, lambda x: x <> 'excluded')), 0)"
_TABLE = f"CASE WHEN NOT {_WHOLE} OR st[1] = 'excluded' THEN NULL WHEN st[1] = 'none' THEN 1 WHEN {_POINTS} >= 1 THEN 5 WHEN {_POINTS} >= 0.75 THEN 4 WHEN {_POINTS} >= 0.5 THEN 3 ELSE 2 END"


@query(f"""WITH {WINDOWS_SQL},
d AS (SELECT *, event_id % 7 > 0 AS judged, event_id % 14 = 0 AS failed, event_id % 6 = 5 AS coded, 1 + event_id % 5 AS score, [3, 4, NULL, NULL, NULL][event_id % 5 + 1] AS stated FROM s),
l AS (SELECT *, judged AND NOT coded AS legacy, {_TABLE} AS due FROM d)
SELECT user_id AS item_id, count(*) FILTER (WHERE judged) AS n, count(*) FILTER (WHERE failed) AS failures, max(CASE WHEN judged THEN 'judge-v4' END) AS judge_prompt,
CASE WHEN count(*) FILTER (WHERE judged) = 0 THEN NULL WHEN count(*) FILTER (WHERE legacy) = 0 THEN 'code' WHEN count(*) FILTER (WHERE judged AND coded) > 0 THEN 'mixed' ELSE 'judge' END AS scored_by,
{_share("len(list_filter(v, lambda x: x IS NULL)) = 0", "legacy")} AS slot_adherence, {_share("stated = 3", "legacy")} AS denominator_adherence, {_share(_WHOLE, "legacy")} AS state_adherence, {_share("due = score", f"legacy AND {_WHOLE}")} AS score_table_adherence,
{", ".join(f"{_share(f"v[{k}] = 'yes'", 'legacy')} AS fill_{k}" for k in range(1, 5))},
{", ".join("concat_ws(';', " + ", ".join(f"CASE WHEN count(*) FILTER (WHERE legacy AND st[{k}] = '{x}') > 0 THEN '{x}=' || count(*) FILTER (WHERE legacy AND st[{k}] = '{x}') END" for x in evals.STATES) + f") AS states_{k}" for k in range(1, 5))}
FROM l GROUP BY user_id""")
def repeat_stats(spark, sf):
    e = F.col("event_id")
    rows = _rationales(spark, sf).select(F.col("user_id").alias("item_id"), (e % 7 > 0).alias("judged"), (e % 14 == 0).alias("failed"), (e % 6 == 5).alias("coded"), "rationale", (1 + e % 5).alias("score"), T.stated_denominator(F.col("rationale")).alias("stated"), F.lit(3).alias("labelled"), F.lit("judge-v4").alias("judge_prompt"))
    return evals.repeat_stats(rows)


#: Rationales of the strict reading, labels and what it says of them, by event_id.
STRICT = (("①사건: (a) 담김 | ②범위: (a) 이름만 (b) 없음", (1, 2, 0, 0), "ok:a=담김|a=이름만;b=없음||"), ("①(a) 담김 ①(a) 담김", (1, 0, 0, 0), "error:slot twice"), ("①(a) 담김 (a) 없음", (1, 0, 0, 0), "error:slot 1 contradicts itself"),
          ("①(a) 담김", (2, 0, 0, 0), "error:slot 1 has other elements than its label"), (" ", (1, 0, 0, 0), "error:empty"), ("②(a) 담김", (1, 0, 0, 0), "error:slot 1 missing"), ("③(b) 담김 ①(a) 없음 (a) 없음", (1, 0, 0, 0), "ok:a=없음|||"))


@query(f"SELECT event_id, [{', '.join(_sql_text(x) for _, _, x in STRICT)}][event_id % {len(STRICT)} + 1] AS read FROM events")
def strict_elements(spark, sf):
    rows = F.array(*[F.struct(F.lit(t).alias("t"), F.array(*[F.lit(n) for n in sizes]).alias("sizes")) for t, sizes, _ in STRICT])
    r = table(spark, sf, "events").select("event_id", F.element_at(rows, (F.col("event_id") % len(STRICT) + 1).cast("int")).alias("r"))
    return r.select("event_id", evals.parsed_elements(F.col("r.t"), F.col("r.sizes")).alias("read"))


STOP = "CASE WHEN event_id % 4 = 0 THEN 'length' ELSE 'stop' END"


@query(f"""SELECT event_type, count(*) FILTER (WHERE k = 'truncated') AS truncated, count(*) FILTER (WHERE k = 'degenerate') AS degenerate, count(*) FILTER (WHERE k = 'unclassified') AS unclassified FROM (
  SELECT event_type, CASE WHEN event_id % 9 = 0 THEN CASE WHEN event_id % 4 = 0 THEN 'unclassified' END WHEN event_id % 4 = 0 THEN CASE WHEN event_id % 3 = 0 THEN 'degenerate' ELSE 'truncated' END END AS k FROM events) GROUP BY 1""")
def stop_kinds(spark, sf):
    e = F.col("event_id")
    reason = F.when(e % 4 == 0, "length").otherwise("stop")
    content = F.when(e % 3 == 0, F.concat(F.lit("x"), F.repeat(F.lit("\n"), F.lit(250)))).otherwise(F.lit("some text"))
    rows = table(spark, sf, "events").select("event_type", F.when(e % 9 != 0, F.array(T.stop_kind(reason, content))).alias("stop_kinds"), F.array(reason).alias("finish_reasons"))
    return usage.length_stops(rows, "event_type")


COST = f"""{EXTRACTIONS},
price AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{p}', {a}, {b})" for i, (p, a, b) in enumerate(PRICES))}) AS t(ord, prefix, pin, pout)),
m AS (SELECT source_name, CASE WHEN doc_id % 40 <> 2 AND source_name = 'src2' THEN 'beta-1' WHEN source_name IN ('src1', 'src4', 'src8') THEN 'alpha-2' ELSE model END AS model, input_tokens, output_tokens, thinking_tokens, text FROM extractions),
bm AS (SELECT source_name, model, count(*) AS records, sum(input_tokens) AS i, sum(output_tokens) AS o, sum(thinking_tokens) AS t FROM m GROUP BY 1, 2),
pm AS (SELECT bm.*, (SELECT arg_min(pin, ord) FROM price WHERE starts_with(model, prefix)) AS pin, (SELECT arg_min(pout, ord) FROM price WHERE starts_with(model, prefix)) AS pout FROM bm),
med AS (SELECT source_name, list(length(text) ORDER BY length(text))[count(*) // 2 + 1] AS body_median FROM m GROUP BY 1),
us AS (SELECT source_name, CAST(sum(records) AS BIGINT) AS records, CAST(sum(i) AS BIGINT) AS input_tokens, CAST(sum(o) AS BIGINT) AS output_tokens, CAST(sum(coalesce(t, 0)) AS BIGINT) AS thinking_tokens,
  CASE WHEN count(*) = count(pin) THEN round(sum((i * CAST(pin AS DOUBLE) + o * CAST(pout AS DOUBLE)) / 1000000), 6) END AS cost, coalesce(string_agg(CASE WHEN pin IS NULL THEN model END, ',' ORDER BY model), '') AS unpriced FROM pm GROUP BY 1)"""


def _usage(spark, sf):
    e = extractions(spark, sf)
    model = F.when((F.col("doc_id") % 40 != 2) & (F.col("source_name") == "src2"), "beta-1").when(F.col("source_name").isin("src1", "src4", "src8"), "alpha-2").otherwise(F.col("model"))
    return usage.usage_by_source(e.withColumn("model", model), usage.price_table(spark, PRICES))


@query(f"WITH {COST} SELECT us.*, round(cost / records, 6) AS cost_per_record, body_median FROM us JOIN med USING (source_name)", text="cost cost_per_record")
def usage_by_source(spark, sf):
    return usage.usage_report(_usage(spark, sf))


@query(f"WITH {COST} SELECT CAST(sum(records) AS BIGINT) AS records, round(sum(cost), 4) AS cost, round(sum(cost) / sum(CASE WHEN cost IS NOT NULL THEN records END), 6) AS mean, coalesce((SELECT string_agg(DISTINCT unpriced, ',' ORDER BY unpriced) FROM us WHERE unpriced <> ''), '') AS excluded FROM us")
def cost_null_poison(spark, sf):
    return usage.usage_totals(_usage(spark, sf))


FAIL = "CASE WHEN doc_id % 17 = 0 THEN 'schema' WHEN doc_id % 13 = 0 THEN 'transport' END"


def _attempts(spark, sf):
    d = F.col("doc_id")
    return extractions(spark, sf).withColumn("failure", usage.failure_kind((d % 17 != 0) & (d % 13 != 0), F.when(d % 17 == 0, "schema").otherwise("x"))).withColumn("attempts", 1 + d % 3)


@query(f"""SELECT lang, count(*) AS n, count(*) FILTER (WHERE f = 'schema') AS schema_failed, count(*) FILTER (WHERE f = 'transport') AS transport_failed, count(*) - count(*) FILTER (WHERE f = 'transport') AS measured,
  round(count(*) FILTER (WHERE f = 'schema') / nullif(count(*) - count(*) FILTER (WHERE f = 'transport'), 0), 4) AS schema_failure_rate, count(*) FILTER (WHERE doc_id % 3 > 0) AS retried FROM (SELECT *, {FAIL} AS f FROM documents) GROUP BY 1""")
def replay_summary(spark, sf):
    return usage.replay_summary(_attempts(spark, sf), "lang")


@query(f"""SELECT lang, count(*) AS n, count(*) - count(*) FILTER (WHERE f = 'transport') AS measured, count(*) FILTER (WHERE f = 'schema') / nullif(count(*) - count(*) FILTER (WHERE f = 'transport'), 0) AS schema_failure_rate,
  CAST(sum(doc_id % 3) AS BIGINT) AS retried FROM (SELECT *, {FAIL} AS f FROM documents) GROUP BY 1""")
def predict_summary(spark, sf):
    return usage.predict_summary(_attempts(spark, sf), "lang")


@query(f"""WITH {EXTRACTIONS}, b AS (SELECT source_name, count(*) AS extracted, count(*) FILTER (WHERE attempts > 1) AS retried, count(*) FILTER (WHERE len(prior_art) = 0) AS empty, sum(len(companies)) AS c, sum(len(list_filter(companies, lambda x: NOT x.resolved))) AS u FROM extractions GROUP BY 1),
r AS (SELECT source_name, string_agg(release_type || '=' || n, ';' ORDER BY release_type) AS release_types FROM (SELECT source_name, release_type, count(*) AS n FROM extractions GROUP BY 1, 2) GROUP BY 1),
i AS (SELECT source_name, string_agg(impact || '=' || n, ';' ORDER BY impact) AS impacts FROM (SELECT source_name, impact, count(*) AS n FROM extractions GROUP BY 1, 2) GROUP BY 1),
t AS (SELECT source, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality = 0) AS s FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
SELECT b.source_name, extracted, round(p / nullif(p + s, 0), 3) AS gate_pass_rate, round((retried + 1) / nullif(p, 0), 3) AS schema_retry_rate, round(u / nullif(c, 0), 3) AS unresolved_company_rate, round(empty / nullif(extracted, 0), 3) AS prior_art_empty_rate, release_types, impacts
FROM b JOIN r USING (source_name) JOIN i USING (source_name) LEFT JOIN t ON t.source = b.source_name""")
def quality_metrics(spark, sf):
    n = lambda v: F.count_if(F.coalesce(F.col("quality") == v, F.lit(False)))
    tallies = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").groupBy(F.col("source").alias("source_name")).agg(n(1).alias("gate_passed"), n(0).alias("gate_skipped"))
    return usage.quality(extractions(spark, sf), tallies.withColumn("extract_calls", F.col("gate_passed")).withColumn("schema_failed", F.lit(1)))


@query("""WITH a AS (SELECT source AS section, lang AS name, count(*) AS value FROM documents WHERE doc_id % 5 > 0 GROUP BY 1, 2), b AS (SELECT source AS section, lang AS name, count(*) AS value FROM documents WHERE doc_id % 7 > 1 GROUP BY 1, 2)
SELECT section, name, CASE WHEN a.value IS NULL THEN 'added' WHEN b.value IS NULL THEN 'removed' ELSE 'changed' END AS kind FROM a FULL JOIN b USING (section, name) WHERE a.value IS DISTINCT FROM b.value""")
def fingerprint_diff(spark, sf):
    side = lambda cond: table(spark, sf, "documents").where(cond).groupBy(F.col("source").alias("section"), F.col("lang").alias("name")).agg(F.count(F.lit(1)).alias("value"))
    return records.fingerprint_diff(side("doc_id % 5 > 0"), side("doc_id % 7 > 1"))


@query("SELECT source AS source_name, min(length(text)) AS shortest, list(length(text) ORDER BY length(text))[count(*) // 2 + 1] AS median, max(length(text)) AS longest, count(*) FILTER (WHERE length(text) < 1) AS excluded FROM documents GROUP BY 1")
def length_range(spark, sf):
    return records.length_range(table(spark, sf, "documents").withColumnRenamed("source", "source_name"), "source_name")


@query("SELECT text, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_texts(spark, sf):
    return records.duplicates(table(spark, sf, "documents"), "text")


@query("SELECT sha256('tech_domain=' || '" + ",".join(TECH_DOMAINS) + "' || ';release_type=' || '" + ",".join(RELEASE_TYPES) + "') AS vocab_hash, count(*) AS n FROM documents")
def vocab_hash(spark, sf):
    return table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n")).select(records.schema_sha256().alias("vocab_hash"), "n")


@query("SELECT conv_id, arg_max(text, turn) AS text FROM conversations GROUP BY 1")
def latest_wins(spark, sf):
    return records.last_of_each(table(spark, sf, "conversations"), "conv_id", "turn").select("conv_id", "text")
