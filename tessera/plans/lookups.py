"""Queries on small functions, checks before calls, labels and replays, over whole tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import urls as U
from tessera.operators import control, evals, identity, records, usage
from tessera.plans.fixtures import EXTRACTIONS, PRICES, extractions
from tessera.plans.registry import query
from tessera.session import table
from tessera.vocab import PLACEHOLDER, SLOTS

_D = "d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents)"


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("t")).withColumn("n", F.length("t"))


@query(f"""WITH {_D}, c AS (SELECT doc_id, [left(t, n % 900), substr(t, 3, n % 800), NULL, substr(t, 7, 5000)] AS c FROM d)
SELECT doc_id, left(coalesce((SELECT x FROM (SELECT unnest(c) AS x, generate_subscripts(c, 1) AS i) WHERE x <> '' ORDER BY length(x) DESC, i LIMIT 1), ''), 4000) AS body FROM c""")
def entry_body(spark, sf):
    part = lambda a, k: F.substring("t", a, k) if isinstance(k, int) else F.substr("t", F.lit(a), k)
    got = F.array(part(1, F.col("n") % 900), part(3, F.col("n") % 800), F.lit(None).cast("string"), part(7, 5000))
    return _docs(spark, sf).select("doc_id", T.entry_body(got).alias("body"))


@query(f"WITH {_D} SELECT lang, count(*) FILTER (WHERE length(left(t, n % 230)) BETWEEN 10 AND 200) AS valid, count(*) AS n FROM d GROUP BY 1")
def gate_reasons(spark, sf):
    valid = records.gate_valid(F.when(F.col("n") > 0, F.substr("t", F.lit(1), F.col("n") % 230)))
    return _docs(spark, sf).groupBy("lang").agg(F.count_if(valid).alias("valid"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_D} SELECT doc_id, NOT (n % 5 < 4) OR (n % 3 > 0 AND trim(t) <> '' AND n % 7 > 0 AND n % 11 > 0) AS valid FROM d""")
def golden_valid(spark, sf):
    """Confirmed labels need impact, body and labeller, and no placeholder anywhere in the row."""
    n = F.col("n")
    d = _docs(spark, sf).withColumn("status", F.when(n % 5 < 4, "confirmed").otherwise("draft")).withColumn("impact", F.when(n % 3 > 0, n % 5 + 1)).withColumn("by", F.when(n % 7 > 0, F.lit("me"))).withColumn("note", F.when(n % 11 == 0, F.lit(f"see {PLACEHOLDER}")).otherwise("done"))
    whole = F.to_json(F.struct("doc_id", "impact", "by", "note", "t"))
    return d.select("doc_id", records.golden_valid(F.col("status"), F.col("impact"), F.col("t"), F.col("by"), F.lit("2024"), whole).alias("valid"))


#: Labels from the words of a text: up to four a slot.
_SLOTS_SQL = f"""{_D}, w AS (SELECT doc_id, n, string_split(t, ' ') AS w FROM d),
s AS (SELECT doc_id, n, w[1:n % 4] AS s1, w[5:4 + n % 3] AS s2, w[10:9 + n % 5] AS s3, w[20:19 + n % 2] AS s4 FROM w)"""


def _slots(spark, sf):
    n, w = F.col("n"), F.split("t", " ", -1)
    cut = lambda a, k: F.slice(w, a, n % k)
    return _docs(spark, sf).select("doc_id", "n", "t", F.array(cut(1, 4), cut(5, 3), cut(10, 5), cut(20, 2)).alias("slots"))


@query(f"""WITH {_SLOTS_SQL}, f AS (SELECT *, list_transform(s1 || s2 || s3 || s4, lambda x: trim(x)) AS a FROM s)
SELECT doc_id, len(s1) >= 1 AND len(s1) <= 3 AND len(s2) <= 3 AND len(s3) <= 3 AND len(s4) <= 3 AND len(list_filter(a, lambda x: x = '')) = 0 AND len(list_distinct(a)) = len(a) AS valid FROM f""")
def slot_labels(spark, sf):
    return _slots(spark, sf).select("doc_id", records.slots_valid(F.col("slots")).alias("valid"))


def _slot_line(k: int, name: str) -> str:
    return f"'- {name}: ' || CASE WHEN len(s{k}) = 0 THEN '분모 제외 (원문이 이 정보를 주지 않았다)' ELSE array_to_string(list_transform(s{k}, lambda x, i: '(' || chr(CAST(96 + i AS INTEGER)) || ') ' || x), ' / ') END"


@query(f"""WITH {_SLOTS_SQL}, v AS (SELECT doc_id, '분모: ' || (CAST(len(s1) > 0 AS INT) + CAST(len(s2) > 0 AS INT) + CAST(len(s3) > 0 AS INT) + CAST(len(s4) > 0 AS INT)) || chr(10) || {" || chr(10) || ".join(_slot_line(k, name) for k, name in enumerate(SLOTS, 1))} AS slots FROM s)
SELECT v.doc_id, CASE WHEN regexp_replace(t, '^\\s+|\\s+$', '', 'g') = '' THEN 'Item' ELSE 'Item' || chr(10) || chr(10) || regexp_replace(t, '^\\s+|\\s+$', '', 'g') END AS source_text, CASE WHEN d.n % 6 > 0 THEN slots END AS slots FROM v JOIN d USING (doc_id)""")
def judge_variables(spark, sf):
    d = _slots(spark, sf)
    v = control.judge_variables(F.lit("Item"), F.col("t"), F.lit("s"), F.when(F.col("n") % 6 > 0, F.col("slots")))
    return d.select("doc_id", v.alias("v")).select("doc_id", F.col("v.source_text").alias("source_text"), F.col("v.completeness_slots").alias("slots"))


@query(f"WITH {_D} SELECT doc_id AS item_id FROM d WHERE n % 6 = 0")
def missing_labels(spark, sf):
    golden = _slots(spark, sf).select(F.col("doc_id").alias("item_id"), F.when(F.col("n") % 6 > 0, F.col("slots")).alias("completeness_slots"))
    return control.missing_labels(golden)


@query("SELECT doc_id AS item_id, lang FROM documents JOIN labels USING (doc_id) WHERE quality = 1")
def selected_items(spark, sf):
    golden = table(spark, sf, "documents").select(F.col("doc_id").alias("item_id"), "lang")
    wanted = table(spark, sf, "labels").where("quality = 1").join(table(spark, sf, "documents").select("doc_id"), "doc_id").select(F.col("doc_id").alias("item_id"))
    return evals.select_items(golden, wanted)


@query("""WITH h AS (SELECT page_id, array_to_string(string_split(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '.')[-2:], '.') AS host FROM pages) SELECT page_id AS item_id, 'source of ' || host AS source_name FROM h""")
def source_of_items(spark, sf):
    """The configured source of each page's registrable host."""
    p = table(spark, sf, "pages").select(F.col("page_id").alias("item_id"), "url")
    hosts = p.select(U.registrable(U.host_of(F.col("url"))).alias("h")).distinct()
    return control.source_names(p, hosts.select(F.concat(F.lit("https://"), "h", F.lit("/feed")).alias("url"), F.concat(F.lit("source of "), "h").alias("name"))).select("item_id", "source_name")


_SOURCE = "CASE WHEN page_id % 4 = 0 THEN 'https://arxiv.org/abs/' || page_id ELSE url END"


@query(f"""WITH u AS (SELECT page_id, {_SOURCE} AS url FROM pages), x AS (SELECT page_id, url, lower(regexp_extract(url, '^([A-Za-z]+):', 1)) AS scheme, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host FROM u)
SELECT page_id, CASE WHEN host = 'arxiv.org' THEN 'arxiv' ELSE 'news' END AS source, CASE WHEN host = 'arxiv.org' THEN 'abstract' ELSE 'feed_excerpt' END AS locator,
       CASE WHEN contains(host, ':') THEN host WHEN scheme = 'https' THEN host || ':443' ELSE host || ':80' END AS endpoint, CASE WHEN host = 'arxiv.org' THEN 'arXiv:' || page_id END AS doc_id FROM x""")
def url_kinds(spark, sf):
    url = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("https://arxiv.org/abs/"), F.col("page_id").cast("string"))).otherwise(F.col("url"))
    p = table(spark, sf, "pages").select("page_id", url.alias("url"))
    u = F.col("url")
    return p.select("page_id", U.source_for(u).alias("source"), U.locator_for(u).alias("locator"), U.endpoint(u).alias("endpoint"), F.when(U.is_arxiv(u), U.doc_id(u)).alias("doc_id"))


@query("""WITH o AS (SELECT event_id, ts, event_id % 25 - 12 AS h, event_id % 2 * 30 AS m FROM events), p AS (SELECT *, CASE WHEN event_id % 9 > 0 THEN (CASE WHEN h < 0 THEN -1 ELSE 1 END) * (abs(h) * 3600 + m * 60) END AS off FROM o)
SELECT event_id, off AS offset_s, CAST(CASE WHEN event_id % 10 = 0 THEN CAST(ts AS DATE) + 1 ELSE CAST(ts - to_seconds(coalesce(off, 0)) AS DATE) END AS DATE) AS day FROM p""", text="offset_s day")
def utc_dates(spark, sf):
    """Dates of naive moments under their source's offset; an explicit moment wins."""
    e = F.col("event_id")
    h = e % 25 - 12
    text = F.when(e % 9 > 0, F.concat(F.when(h < 0, "-").otherwise("+"), F.lpad(F.abs(h).cast("string"), 2, "0"), F.when(e % 3 == 0, "").otherwise(":"), F.when(e % 2 == 1, "30").otherwise("00")))
    off = T.parse_offset(text)
    day = T.utc_date(F.col("ts"), off, F.when(e % 10 == 0, F.date_add(F.to_date("ts"), 1)))
    return table(spark, sf, "events").select("event_id", off.alias("offset_s"), day.alias("day"))


@query(f"""WITH {_D} SELECT doc_id, 'Title: ' || CASE WHEN source = '' THEN '(정보 없음)' ELSE source END || ' {{{{other}}}} ' || CASE WHEN t = '' THEN '(정보 없음)' ELSE t END || '!' || '(정보 없음)' AS prompt FROM d""")
def rendered_prompts(spark, sf):
    """Places are filled once: a text that holds a place is not filled again, an unknown place stays."""
    d = _docs(spark, sf)
    return d.select("doc_id", T.render_prompt("Title: {{source}} {{other}} {{text}}!{{empty}}", {"source": F.col("source"), "text": F.col("t"), "empty": F.lit("")}).alias("prompt"))


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events", text="day")
def dated_ids(spark, sf):
    item = F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("-"), "event_type", F.lit("-"), F.col("event_id").cast("string"))
    return table(spark, sf, "events").select("event_id", control.published_of(item).alias("day"))


@query("SELECT doc_id, CASE WHEN length(source) > 4 THEN source || '=x' ELSE source END AS name, CAST(length(text) AS INTEGER) AS n, ['1', '2', '3', '4'][length(text) % 4 + 1] AS slot FROM documents")
def taken_counts(spark, sf):
    """name=count arguments, split at the last sign, and slot marks."""
    n = F.length("text")
    name = F.when(F.length("source") > 4, F.concat("source", F.lit("=x"))).otherwise(F.col("source"))
    mark = F.element_at(F.array(*[F.lit(c) for c in "①②③④"]), (n % 4 + 1).cast("int"))
    return table(spark, sf, "documents").select("doc_id", T.parse_take(F.concat(name, F.lit("="), n.cast("string"))).alias("x"), T.slot_key(mark).alias("slot")).select("doc_id", "x.name", "x.n", "slot")


@query("""WITH e AS (SELECT user_id % 50 AS k, CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS VARCHAR) AS run_id, count(*) AS n FROM events GROUP BY 1, 2),
ok AS (SELECT *, row_number() OVER (ORDER BY run_id DESC, k DESC) AS r FROM e WHERE n % 2 = 0 AND n % 3 > 0 AND n % 7 = 1)
SELECT run_id || '-' || lpad(CAST(k AS VARCHAR), 2, '0') AS run_id, CAST(n AS BIGINT) AS n FROM ok WHERE r = 1""")
def qualifying_run(spark, sf):
    """The last finished run under configured limits equal to today's."""
    e = table(spark, sf, "events").groupBy((F.col("user_id") % 50).alias("k"), F.date_format("ts", "yyyyMMdd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    runs = e.select(F.concat_ws("-", "day", F.lpad(F.col("k").cast("string"), 2, "0")).alias("run_id"), "n", F.when(n % 2 == 0, "config").otherwise("cli").alias("mode"), (n % 3 > 0).alias("finished"), F.create_map(F.lit("b"), n % 7, F.lit("a"), F.lit(2).cast("long")).alias("limits"))
    return records.qualifies(runs, F.create_map(F.lit("a"), F.lit(2).cast("long"), F.lit("b"), F.lit(1).cast("long"))).select("run_id", "n")


@query("""WITH e AS (SELECT user_id, avg(event_id % 5 + 1) FILTER (WHERE event_id % 3 > 0) AS j, avg(event_id % 4 + 1) FILTER (WHERE event_id % 7 = 0) AS h FROM events GROUP BY 1) SELECT user_id, round(j - h, 3) AS gap FROM e""", text="gap")
def judge_gaps(spark, sf):
    e = F.col("event_id")
    g = table(spark, sf, "events").groupBy("user_id").agg(F.avg(F.when(e % 3 > 0, e % 5 + 1)).alias("j"), F.avg(F.when(e % 7 == 0, e % 4 + 1)).alias("h"))
    return g.select("user_id", evals.judge_gap(F.col("j"), F.col("h")).alias("gap"))


@query("""WITH q AS (SELECT lower(regexp_extract(text, '^([A-Za-z]+)', 1)) AS key, count(*) AS n FROM conversations WHERE regexp_extract(text, '^([A-Za-z]+)', 1) <> '' GROUP BY 1)
SELECT key, n FROM q WHERE key NOT IN (SELECT lower(regexp_extract(text, '^([A-Za-z]+)', 1)) FROM conversations WHERE turn = 0)""")
def pruned_queue(spark, sf):
    """Unknown names without those that a dictionary knows by now; here the first turns name it."""
    name = F.regexp_extract("text", "^([A-Za-z]+)", 1)
    c = table(spark, sf, "conversations")
    q = c.where(name != "").groupBy(T.normalization_key(name).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return identity.prune_resolved(q, c.where("turn = 0").select(T.normalization_key(name).alias("key")).distinct())


_BLOCK = f"{EXTRACTIONS}, x AS (SELECT *, length(coalesce(text, '')) AS n FROM extractions)"


@query(f"""WITH {_BLOCK} SELECT doc_id, array_to_string(tech_domains, ',') AS domains, array_to_string(list_transform(companies, lambda c: c.canonical || ':' || CASE WHEN n % 3 = 0 THEN 'false' ELSE CAST(c.resolved AS VARCHAR) END), ',') AS companies,
  CASE WHEN n % 4 = 0 THEN 0 ELSE len(prior_art) END AS prior, impact AS impact_score, left(text, n % 50) AS impact_rationale FROM x""")
def ontology_blocks(spark, sf):
    n = F.length(F.coalesce("text", F.lit("")))
    company = lambda c: F.struct(c.canonical.alias("canonical"), c.canonical.alias("raw"), F.when(n % 3 > 0, c.resolved).alias("resolved"), F.lit("maker").alias("role"), F.lit(1).alias("rank"))
    ontology = F.struct("tech_domains", "release_type", F.transform("companies", company).alias("companies"), F.when(n % 4 > 0, F.col("prior_art")).alias("prior_art"), F.struct(F.col("impact").alias("score"), F.substr("text", F.lit(1), n % 50).alias("rationale")).alias("impact"), F.lit("s").alias("summary"))
    b = records.ontology_block(ontology)
    shown = F.array_join(F.transform("b.companies", lambda c: F.concat(c.canonical, F.lit(":"), c.resolved.cast("string"))), ",")
    return extractions(spark, sf).select("doc_id", b.alias("b")).select("doc_id", F.array_join("b.tech_domains", ",").alias("domains"), shown.alias("companies"), F.size("b.prior_art").alias("prior"), "b.impact_score", "b.impact_rationale")


_PRINTS = """a AS (SELECT CASE WHEN lang = 'en' THEN 'limits.gate' ELSE 'prompts' END AS section, source || lang AS name, count(*) AS v FROM documents WHERE length(text) % 5 > 0 GROUP BY 1, 2),
b AS (SELECT CASE WHEN lang = 'en' THEN 'limits.gate' ELSE 'prompts' END AS section, source || lang AS name, count(*) AS v FROM documents WHERE length(text) % 7 > 0 GROUP BY 1, 2)"""


@query(f"""WITH {_PRINTS}, j AS (SELECT b.section, b.name, a.v AS x, b.v AS y FROM b LEFT JOIN a USING (section, name))
SELECT 'approval' AS key, 'approval expired' AS detail UNION ALL
SELECT section || '.' || name, CASE WHEN x IS NULL THEN 'added' WHEN section = 'prompts' THEN 'changed' ELSE 'raised' END FROM j WHERE x IS NULL OR (section = 'prompts' AND x <> y) OR (section <> 'prompts' AND y > x)""")
def preflight(spark, sf):
    """What stands against a scheduled run: an approval past its time, raised limits and changed prompts; lowered limits pass."""
    d = table(spark, sf, "documents")
    side = lambda k: d.where(F.length("text") % k > 0).groupBy(F.when(F.col("lang") == "en", "limits.gate").otherwise("prompts").alias("section"), F.concat("source", "lang").alias("name")).agg(F.count(F.lit(1)).cast("string").alias("value"))
    approval = d.agg(F.lit(1).alias("schema"), F.lit("2024-01-01").cast("timestamp").alias("expires_at"))
    return records.preflight(approval, records.mismatches(side(5), side(7)), F.lit("2024-02-01").cast("timestamp"))


@query(f"""WITH {EXTRACTIONS}, o AS (SELECT doc_id, CASE WHEN length(text) % 6 = 0 THEN 'Paper' ELSE release_type END AS r, CASE WHEN length(text) % 4 = 0 THEN 1 ELSE impact END AS i, length(text) AS n FROM extractions WHERE length(text) % 9 > 0),
j AS (SELECT e.doc_id, e.model, o.doc_id AS has, o.n, e.release_type <> o.r AS cr, e.impact <> o.i AS ci FROM extractions e LEFT JOIN o USING (doc_id))
SELECT model, CASE WHEN has IS NULL THEN 'pending' WHEN n % 8 = 0 THEN 'failed' WHEN cr OR ci THEN 'changed' ELSE 'same' END AS state, count(*) AS n, count(*) FILTER (WHERE has IS NOT NULL AND n % 8 > 0 AND cr) AS release_changed FROM j GROUP BY 1, 2""")
def replayed_outputs(spark, sf):
    """A new model's recorded outputs against the stored ones."""
    e, n = extractions(spark, sf), F.length("text")
    out = e.where(n % 9 > 0).select("doc_id", F.when(n % 6 == 0, "Paper").otherwise(F.col("release_type")).alias("release_type"), F.when(n % 4 == 0, 1).otherwise(F.col("impact")).alias("impact"), F.when(n % 8 == 0, "schema").alias("failure"), F.lit(1).alias("attempts"))
    got = usage.replayed(e, out, ["release_type", "impact"]).join(e.select("doc_id", "model"), "doc_id")
    return got.groupBy("model", "state").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.array_contains("changed", "release_type"), F.lit(False))).alias("release_changed"))


@query(f"""WITH {EXTRACTIONS} SELECT model, count(*) AS n, coalesce((SELECT arg_min(prefix, ord) FROM (VALUES {', '.join(f'({i}, {p[0]!r})' for i, p in enumerate(PRICES))}) AS t(ord, prefix) WHERE starts_with(model, prefix)), '') AS prefix FROM extractions GROUP BY 1""")
def model_prices(spark, sf):
    """The price list's prefix for each model that made an extraction."""
    models = extractions(spark, sf).groupBy("model").agg(F.count(F.lit(1)).alias("n"))
    prices = usage.price_table(spark, PRICES).select("ord", "prefix", F.col("prefix").alias("hit"))
    return control.by_prefix(models, prices, "model", "hit").select("model", "n", F.coalesce("hit", F.lit("")).alias("prefix"))




_AXES_SQL = "[{'axis': 'faithfulness', 'k': 3}, {'axis': 'completeness', 'k': 4}, {'axis': 'concision', 'k': 5}]"


@query(f"""
WITH r AS (SELECT doc_id % 97 AS item_id, length(coalesce(text, '')) AS n, unnest({_AXES_SQL}) AS a FROM documents), s AS (SELECT item_id, n, a.axis AS axis, 1 + n % a.k AS score, n % 5 < 4 AS judged, n % 11 = 0 AS human FROM r),
c AS (SELECT item_id, axis, score, count(*) AS c FROM s WHERE judged GROUP BY ALL), h AS (SELECT item_id, min(n) AS n FROM s WHERE human GROUP BY 1),
t AS (SELECT item_id, axis, CAST(sum(c) AS BIGINT) AS n, round(sum(score * c) / sum(c), 3) AS mean, arg_min(score, (-c, score)) AS mode, CAST(max(score) - min(score) AS BIGINT) AS spread, round(max(c) / sum(c), 3) AS mode_ratio, string_agg(score || '=' || c, ';' ORDER BY score) AS distribution FROM c GROUP BY ALL)
SELECT t.item_id, t.axis, t.n, mean, mode, spread, mode_ratio, distribution, CASE WHEN h.n IS NOT NULL THEN 1 + h.n % 2 END AS human, round(mean - (1 + h.n % 2), 3) AS gap FROM t LEFT JOIN h USING (item_id)""", text="human gap")
def repeat_axes(spark, sf):
    """Score statistics of repeated judgements on each axis, and how far they are from the human's."""
    d = _docs(spark, sf)
    scores = F.struct(*[(1 + F.col("n") % k).alias(a) for a, k in zip(evals.AXES, (3, 4, 5))])
    least = d.where("n % 11 = 0").groupBy((F.col("doc_id") % 97).alias("item_id")).agg(F.min("n").alias("_n"))
    rows = d.select((F.col("doc_id") % 97).alias("item_id"), "n", (F.col("n") % 5 < 4).alias("judged"), scores.alias("scores")).join(least, "item_id", "left")
    human = F.when(F.col("n") % 11 == 0, F.struct(*[(1 + F.col("_n") % 2).alias(a) for a in evals.AXES]))
    return evals.repeat_axes(rows.withColumn("human", human)).select("item_id", "axis", "n", "mean", "mode", "spread", "mode_ratio", "distribution", "human", "gap")


_MARKED = """'① (a) ' || ['담김', '없음', '이름만'][n % 3 + 1] || ' (b) 담김 ' || ['부분', '충족', '미충족', ''][n % 4 + 1] || ' ' || left(t, n % 120) || ' ② ' || ['충족', '분모 제외'][n % 2 + 1] || ' (a) ' || ['담김', '없음'][n % 5 % 2 + 1]"""


@query(f"""
WITH {_D}, r AS (SELECT doc_id % 97 AS item_id, n, n % 5 < 4 AND n % 6 < 5 AS legacy, n % 7 = 0 AS parse_failed FROM d),
p AS (SELECT item_id, '1' AS slot, ['partial', 'full', 'none', NULL][n % 4 + 1] AS s, [['a', ['담김', '없음', '이름만'][n % 3 + 1]], ['b', '담김']] AS e FROM r WHERE legacy
  UNION ALL SELECT item_id, '2', ['full', NULL][n % 2 + 1], [['a', ['담김', '없음'][n % 5 % 2 + 1]]] FROM r WHERE legacy),
q AS (SELECT *, len(list_filter(e, lambda x: x[2] = '담김')) AS held FROM p WHERE s IS NOT NULL),
k AS (SELECT item_id, slot || '(' || v[1] || ') ' || v[2] AS k, count(*) AS c FROM (SELECT item_id, slot, unnest(e) AS v FROM q) GROUP BY ALL),
f AS (SELECT item_id, count(*) AS checked, round(avg(CAST(s = CASE WHEN held = len(e) THEN 'full' WHEN held > 0 THEN 'partial' ELSE 'none' END AS INT)), 3) AS consistency FROM q GROUP BY 1)
SELECT b.item_id, coalesce(checked, 0) AS checked, consistency, coalesce((SELECT string_agg(k || '=' || c, ';' ORDER BY k) FROM k WHERE k.item_id = b.item_id), '') AS counts, parse_failures FROM (SELECT item_id, count(*) FILTER (WHERE parse_failed) AS parse_failures FROM r GROUP BY 1) b LEFT JOIN f USING (item_id)""", text="consistency")
def repeat_elements(spark, sf):
    """Element verdicts of rationales built around the texts, and whether the slots' states follow from them."""
    d = _docs(spark, sf).withColumn("t", F.regexp_replace("t", "[^A-Za-z ]", ""))  # no marks of its own
    spliced = re.sub(r"\[([^\]]*)\]\[(n %[^\]]*?) \+ 1\]", r"element_at(array(\1), cast(\2 + 1 as int))", _MARKED)
    n = F.col("n")
    rows = d.select((F.col("doc_id") % 97).alias("item_id"), (n % 5 < 4).alias("judged"), (n % 6 == 5).alias("coded"), (n % 7 == 0).alias("parse_failed"), F.expr(spliced).alias("rationale"))
    return evals.repeat_elements(rows)
