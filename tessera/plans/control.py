"""Queries on lookups, samples, hashes and keys of the control plane."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import control, usage
from tessera.plans.fixtures import MODELS, PRICES
from tessera.plans.registry import query
from tessera.session import table


@query("SELECT doc_id, left(sha256(replace(text, chr(13) || chr(10), chr(10))), 16) AS short, sha256(text) AS long_, source || '|' || lang AS gate_key FROM documents")
def prompt_hashes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", control.short_hash(F.col("text")).alias("short"), control.full_hash(F.col("text")).alias("long_"), control.gate_key(F.col("source"), F.col("lang")).alias("gate_key"))


@query("""SELECT page_id, CASE WHEN host = 'example.net' OR host LIKE '%.example.net' THEN 'example.net' WHEN contains(host, 'spam') THEN 'spam' END AS match FROM (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host FROM pages)""")
def endpoint_denylist(spark, sf):
    return table(spark, sf, "pages").select("page_id", control.denied(F.col("url"), ["example.net"], ["spam"]).alias("match"))


@query(f"SELECT m AS model, coalesce((SELECT arg_min(prefix, ord) FROM (VALUES {', '.join(f'({i}, {p[0]!r})' for i, p in enumerate(PRICES))}) AS t(ord, prefix) WHERE starts_with(m, prefix)), '') AS prefix FROM (SELECT unnest([{', '.join(map(repr, MODELS))}]) AS m)")
def price_prefix(spark, sf):
    models = spark.createDataFrame([(m,) for m in MODELS], "model string")
    prices = usage.price_table(spark, PRICES).select("ord", "prefix", F.col("prefix").alias("hit"))
    return control.by_prefix(models, prices, "model", "hit").select("model", F.coalesce("hit", F.lit("")).alias("prefix"))


@query("""WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) SELECT doc_id, source FROM r WHERE r <= greatest(2 + 5, 2 * 3)""")
def candidate_pool(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    return control.pool(d, d.select("source").distinct().withColumn("n", F.lit(2)), "source", "doc_id").select("doc_id", "source")


@query("""
WITH i AS (SELECT doc_id, source, CASE WHEN source <> 'src3' THEN 3 END AS n, doc_id % 4 > 0 AS ok FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source, ok ORDER BY doc_id) AS r FROM i),
s AS (SELECT *, ok AND (n IS NULL OR r <= n) AS inside FROM r),
c AS (SELECT *, sum(CASE WHEN inside THEN 1 ELSE 0 END) OVER (ORDER BY n IS NOT NULL, source, doc_id) AS upto FROM s)
SELECT doc_id, inside AND upto <= 60 AS taken FROM c""")
def shared_budget(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", F.when(F.col("source") != "src3", 3).alias("n"))
    return control.take(d, "source", ["doc_id"], F.col("doc_id") % 4 > 0, 60).select("doc_id", "taken")


@query("""WITH recent AS (SELECT doc_id FROM documents ORDER BY n_chars DESC, CAST(doc_id AS VARCHAR) LIMIT 15) SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM recent ORDER BY sha256(doc_id || 'x') LIMIT 3""")
def review_sample(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "n_chars")
    return control.review_sample(d, "n_chars", seed="x").select("doc_id")


@query("SELECT doc_id, CAST(CASE WHEN doc_id % 11 = 0 THEN 6 WHEN doc_id % 7 = 0 THEN 4 WHEN doc_id % 5 = 0 THEN 5 ELSE doc_id % 4 END AS INTEGER) AS code FROM documents")
def scheduled_exit(spark, sf):
    d = F.col("doc_id")
    return table(spark, sf, "documents").select("doc_id", control.scheduled_exit(d % 11 == 0, d % 7 != 0, d % 5 != 0, (d % 4).cast("int")).alias("code"))


@query("""SELECT user_id, count(*) FILTER (WHERE NOT (model = 'm1' AND prompt IS NOT DISTINCT FROM 'p1')) AS stale FROM (SELECT user_id, 'm' || (event_id % 2) AS model, CASE WHEN event_id % 3 > 0 THEN 'p1' END AS prompt FROM events) GROUP BY 1""")
def stale_extractions(spark, sf):
    e = F.col("event_id")
    stored = F.struct(F.when(e % 3 > 0, F.lit("p1")).alias("prompt"), F.concat(F.lit("m"), (e % 2).cast("string")).alias("model"))
    return table(spark, sf, "events").groupBy("user_id").agg(F.count_if(control.stale(stored, F.struct(F.lit("p1").alias("prompt"), F.lit("m1").alias("model")))).alias("stale"))


@query("SELECT 'run-' || strftime(ts, '%Y%m%dT%H%M%S') AS id, count(*) AS n FROM events GROUP BY 1")
def run_ids(spark, sf):
    return table(spark, sf, "events").groupBy(control.run_id("run", F.col("ts")).alias("id")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH p AS (SELECT event_id, [event_id % 3, event_id % 2, 0, 1] AS held, [2, 1, 0, 1] AS n, [['full', 'partial', 'none', 'excluded'][event_id % 4 + 1], 'full', 'none', CASE WHEN event_id % 5 > 0 THEN 'full' END] AS s FROM events),
x AS (SELECT event_id, unnest(s) AS s, unnest(held) AS held, unnest(n) AS n FROM p),
y AS (SELECT *, CASE WHEN held = n THEN 'full' WHEN held > 0 THEN 'partial' ELSE 'none' END AS d FROM x WHERE s IS NOT NULL AND s <> 'excluded' AND n > 0)
SELECT event_id, CAST(count(*) AS INTEGER) AS checked, CAST(count(*) FILTER (WHERE s = d) AS INTEGER) AS consistent FROM y GROUP BY 1""")
def element_consistency(spark, sf):
    e = F.col("event_id")
    first = F.element_at(F.array(*[F.lit(w) for w in ("full", "partial", "none", "excluded")]), (e % 4 + 1).cast("int"))
    states = F.array(first, F.lit("full"), F.lit("none"), F.when(e % 5 > 0, F.lit("full")))
    got = control.element_consistency(states, F.array(e % 3, e % 2, F.lit(0), F.lit(1)), F.array(*[F.lit(k).cast("long") for k in (2, 1, 0, 1)]))
    return table(spark, sf, "events").select("event_id", got.alias("x")).select("event_id", "x.*").where("checked > 0")
