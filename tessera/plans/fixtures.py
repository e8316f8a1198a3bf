"""The driver's tables as the logical tables of the data model, each in Spark and as a DuckDB CTE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table
from tessera.vocab import RELEASE_TYPES, TECH_DOMAINS

TODAY = "2024-01-31"
ALIASES = {"OpenAI": ["오픈AI", "open ai inc"], "The": ["thea", "thand"], "Anthem": ["In", "ander"], "Other": ["Er", "inther"], "Second": ["The"], "Andco": ["and", "of", "is", "er", "a", "un", "le", "de", "die"]}
PRICES = [("alpha-", 5.0, 25.0), ("beta", 1.0, 2.0), ("alpha", 9.0, 9.0)]
MODELS = ("alpha-2", "beta-1", "gamma-7")


def raw_items(spark: SparkSession, sf: str) -> DataFrame:
    """One feed item a page: url, title, body, source_name, feed_ord, published_at, tags."""
    p, d = table(spark, sf, "pages"), table(spark, sf, "documents")
    return p.join(d, p.page_id == d.doc_id).select(
        "page_id", "url", F.concat(F.lit("Item "), F.col("page_id").cast("string")).alias("title"), F.col("text").alias("body"), F.col("source").alias("source_name"), F.col("page_id").alias("feed_ord"),
        F.when(F.col("page_id") % 11 != 0, F.date_sub(F.lit(TODAY).cast("date"), (F.col("page_id") * 7 % 21).cast("int"))).alias("published_at"), F.array("lang").alias("tags"))


RAW_ITEMS = f"""raw_items AS (
  SELECT page_id, url, 'Item ' || page_id AS title, text AS body, source AS source_name, page_id AS feed_ord,
         CASE WHEN page_id % 11 <> 0 THEN date '{TODAY}' - CAST(page_id * 7 % 21 AS INTEGER) END AS published_at, [lang] AS tags
  FROM pages JOIN documents ON page_id = doc_id)"""


def _pick(words, index):
    return F.element_at(F.array(*[F.lit(w) for w in words]), (index + 1).cast("int"))


def extractions(spark: SparkSession, sf: str) -> DataFrame:
    """One record a document; the vocabulary values follow from doc_id."""
    d = F.col("doc_id")
    domains = F.slice(F.array_distinct(F.array(*[_pick(TECH_DOMAINS, d * k % 14) for k in (1, 5, 9)])), F.lit(1), (1 + d % 3).cast("int"))
    company = lambda k: F.struct(F.concat(F.lit("Co"), (d % k).cast("string")).alias("canonical"), (d % k % 2 == 0).alias("resolved"))
    return table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("source_name"), F.col("lang"), F.col("text"), domains.alias("tech_domains"), _pick(RELEASE_TYPES, d % 8).alias("release_type"), (1 + d % 5).cast("int").alias("impact"),
        F.when(d % 10 == 0, 2).otherwise(1).alias("attempts"), F.slice(F.array(company(7), company(11)), F.lit(1), (d % 3).cast("int")).alias("companies"),
        F.when(d % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("t"), (d % 5).cast("string")))).alias("prior_art"),
        _pick(MODELS, d % 3).alias("model"), (1000 + d % 500).alias("input_tokens"), (100 + d % 90).alias("output_tokens"), F.when(d % 7 != 0, d % 13).alias("thinking_tokens"))


def _sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


EXTRACTIONS = f"""extractions AS (
  SELECT doc_id, source AS source_name, lang, text,
         (SELECT list(v ORDER BY k) FROM (SELECT v, min(k) AS k FROM (SELECT unnest([{_sql_list(TECH_DOMAINS)}[doc_id % 14 + 1], {_sql_list(TECH_DOMAINS)}[doc_id * 5 % 14 + 1], {_sql_list(TECH_DOMAINS)}[doc_id * 9 % 14 + 1]]) AS v, unnest([1, 2, 3]) AS k) GROUP BY v))[1:1 + doc_id % 3] AS tech_domains,
         {_sql_list(RELEASE_TYPES)}[doc_id % 8 + 1] AS release_type, CAST(1 + doc_id % 5 AS INTEGER) AS impact, CASE WHEN doc_id % 10 = 0 THEN 2 ELSE 1 END AS attempts,
         [{{'canonical': 'Co' || (doc_id % 7), 'resolved': doc_id % 7 % 2 = 0}}, {{'canonical': 'Co' || (doc_id % 11), 'resolved': doc_id % 11 % 2 = 0}}][1:doc_id % 3] AS companies,
         CASE WHEN doc_id % 4 = 0 THEN [] ELSE ['t' || (doc_id % 5)] END AS prior_art, {_sql_list(MODELS)}[doc_id % 3 + 1] AS model,
         1000 + doc_id % 500 AS input_tokens, 100 + doc_id % 90 AS output_tokens, CASE WHEN doc_id % 7 <> 0 THEN doc_id % 13 END AS thinking_tokens
  FROM documents)"""


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """One run a day and source (event type): figures that follow from its events."""
    e = table(spark, sf, "events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("source"), F.col("event_id").alias("id"), (F.col("event_id") % 10).alias("k"))
    n = e.groupBy("day", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"), F.min("id").alias("first_id"), F.sort_array(F.collect_list("id")).alias("ids"))
    return n.select("day", "source", "n", "k", "first_id", "ids", (F.col("k") % 3 == 0).alias("drained"), F.date_sub("day", (7 + F.col("k") % 4).cast("int")).alias("cutoff"),
                    (F.col("k") % 4 != 0).alias("fetched"), (F.col("k") % 5 == 0).alias("tripped"), F.when(F.col("k") % 6 != 0, F.round(F.col("n") * 1.5, 1)).alias("depth_hours"))


RUNS = """runs AS (
  SELECT day, source, n, k, first_id, ids, k % 3 = 0 AS drained, day - CAST(7 + k % 4 AS INTEGER) AS cutoff, k % 4 <> 0 AS fetched, k % 5 = 0 AS tripped,
         CASE WHEN k % 6 <> 0 THEN round(n * 1.5, 1) END AS depth_hours
  FROM (SELECT CAST(ts AS DATE) AS day, event_type AS source, count(*) AS n, CAST(sum(event_id % 10) AS BIGINT) AS k, min(event_id) AS first_id, list(event_id ORDER BY event_id) AS ids FROM events GROUP BY 1, 2))"""
