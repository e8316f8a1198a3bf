"""Operator 9: mixing sources to target weights on a time-varying curriculum.

A source's target is its share of all words by weight, at most CEILING times its
own words; what is over goes to the other sources by weight. In closed form: with
the level x at which all min(CEILING * size, weight * x) add up to all words, that
minimum is the target.

Time runs from 0 to 1. A source is drawn at a rate that changes linearly
from START to 2 - START times its mean (odd ranks rise, even ranks fall), so its cumulative demand is
target * (s t + (1 - s) t^2). Its documents stand in a fixed random order, one
after another and again from the first once all are used. The words that
lie below the target are taken; a copy's training position is the time at which
the demand reaches its first word, by inverting the integral. mix() cuts the copy that the target
ends in after the last word taken, so its texts hold just the words that are taken.

Nulls and empties: null or empty texts have size 0, are taken 0 words and get
position null. A null source is a source of its own, the last one. Repeated rows are
documents of their own, in the order of all their columns where they tie. With no words at all, targets are 0. An empty table gives an empty
result. Extra columns are ignored, or kept by mix().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import materialise, prefix_sums, whole, words

WEIGHTS = (5, 2, 1)
CEILING = 3
START = 0.5
#: Documents of a bucket of the random order, about; the number of buckets follows the data.
BUCKET = 50_000


def targets(sizes: DataFrame) -> DataFrame:
    """sizes(source, source_size), a row a source: adds weight, target and rank. Only this table of sources is ordered as a whole."""
    by = W.orderBy(F.asc_nulls_last("source"))
    out = sizes.withColumn("rank", F.row_number().over(by) - 1)
    out = out.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int")))
    # Sources fill up in the order of size / weight; of the first k full ones, the level for the rest is level k.
    ratio = F.col("source_size").cast("double") / F.col("weight")
    up = W.orderBy(ratio, "rank")
    whole = W.partitionBy()
    out = out.withColumn("all", F.sum("source_size").over(whole)).withColumn("heavy", F.sum("weight").over(whole))
    before = up.rowsBetween(W.unboundedPreceding, -1)
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * CEILING
    gone = F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (F.col("all") - full).cast("double") / (F.col("heavy") - gone)
    # The right level is the first that leaves its own source unfilled.
    out = out.withColumn("level", F.when(F.col("weight") * level <= CEILING * F.col("source_size"), level))
    out = out.withColumn("level", F.first("level", ignorenulls=True).over(up.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    target = F.least((CEILING * F.col("source_size")).cast("double"), F.col("weight") * F.col("level"))
    return out.select("source", "source_size", "rank", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def position(demand: Column, target: Column, rising: Column) -> Column:
    """Time at which the cumulative demand of a source reaches demand: the inverse of s t + (1 - s) t^2."""
    s = F.when(rising, F.lit(START)).otherwise(F.lit(2 - START))
    y = F.least(F.lit(1.0), demand / target)
    return F.round(2 * y / (s + F.sqrt(F.greatest(F.lit(0.0), s * s + 4 * (1 - s) * y))), 6)


def draw(doc_id: Column, text: Column) -> Column:
    """Random but fixed place of a document in its source's order."""
    return F.sha2(F.concat_ws("|", F.coalesce(doc_id.cast("long").cast("string"), F.lit("")), F.sha2(F.coalesce(text, F.lit("")), 256)), 256)


def _taken(docs: DataFrame, own: list[Column]) -> DataFrame:
    """One row per document: own, source, size, source_size, target, rank, before (words ahead of it) and draw."""
    sized = materialise(docs.select(*own, "source", words(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text")).alias("draw")), "sizes")
    goals = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    digits = next((d for d in range(1, 7) if 16**d * BUCKET >= sized.count()), 7)
    names = [c for c in sized.columns if c not in ("source", "size", "draw")]
    dealt = sized.withColumn("_bucket", F.conv(F.substring("draw", 1, digits), 16, 10).cast("int"))
    ahead = prefix_sums(dealt, ["source"], "_bucket", ["draw", *names], F.col("size"), "before")
    return ahead.join(goals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "_bucket")


def _of_copy(k: Column | int) -> Column:
    """Words taken of copy k of a document."""
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.round("target").cast("long") - (k * F.col("source_size") + F.col("before"))))


def taken(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken and position (of the first copy)."""
    found = _taken(docs, [F.col("doc_id").cast("long").alias("doc_id")])
    take = sum(_of_copy(k) for k in range(CEILING))
    when = position(F.col("before").cast("double"), F.col("target"), F.col("rank") % 2 == 0)
    return found.select("doc_id", "source", "size", "source_size", "target", take.alias("taken"), F.when(take > 0, when).alias("position"))


def _first_words(text: Column, n: Column) -> Column:
    """text up to the end of its n-th word."""
    return F.concat_ws("", F.slice(F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", n + 1), F.lit(1), n))


def mix(docs: DataFrame) -> DataFrame:
    """The documents in training order, with all their columns: a row for each copy that the mix takes.

    A copy that is taken in part holds the words taken. Rows are known by their content and draw. Of rows
    that are equal in all columns one stands for all, and is given the copies of each.
    """
    content = F.xxhash64("doc").alias("_content")
    rows = docs.select(whole(docs).alias("doc")).select("doc", content, draw(F.col("doc.doc_id"), F.col("doc.text")).alias("_draw"))
    found = _taken(docs.select(whole(docs).alias("doc")).select(content, "doc.doc_id", "doc.text", "doc.source"), [F.col("_content")])
    copies = F.array_compact(F.array(*[F.when(_of_copy(k) > 0, F.struct((k * F.col("source_size") + F.col("before")).alias("at"), _of_copy(k).alias("words"))) for k in range(CEILING)]))
    placed = found.select("_content", F.col("draw").alias("_draw"), "size", "target", "rank", F.explode(copies).alias("x"))
    at = position(F.col("x.at").cast("double"), F.col("target"), F.col("rank") % 2 == 0)
    placed = placed.select("_content", "_draw", at.alias("_time"), F.when(F.col("x.words") < F.col("size"), F.col("x.words").cast("int")).alias("_part"))
    key = ["_content", "_draw"]
    equal = materialise(found.groupBy("_content", F.col("draw").alias("_draw")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key), "equal")
    # The first scan drops rows that have equals, the second one keeps one of each; both tests are joins with the table of such rows alone, mostly a small one.
    once = rows.join(equal, key, "left_anti")
    several = rows.join(equal, key, "left_semi").dropDuplicates(key)
    out = once.unionByName(several).join(placed, key)
    cut = F.when(F.col("_part").isNull(), F.col("doc.text")).otherwise(_first_words(F.col("doc.text"), F.col("_part")))
    out = out.select(F.col("doc").withField("text", cut).alias("doc"), "_time", "_draw")
    return out.repartitionByRange("_time", "_draw").sortWithinPartitions("_time", "_draw").select("doc.*")


def query(docs: DataFrame) -> DataFrame:
    """Contract rows, range-sorted by position."""
    return taken(docs).orderBy(F.asc_nulls_last("position"), "doc_id").select("doc_id", "size", "source_size", "target", "taken", "position")


#: The same in DuckDB's SQL.
SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         sha256(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), sha256(coalesce(text, '')))) AS draw
  FROM documents),
sizes AS (SELECT source, sum(size) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sizes),
weighed AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM ranked),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - {CEILING} * coalesce(sum(source_size) OVER up, 0) AS DOUBLE) / (sum(weight) OVER () - coalesce(sum(weight) OVER up, 0)) AS level
  FROM weighed WINDOW up AS (ORDER BY CAST(source_size AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
found AS (
  SELECT source, source_size, rank, coalesce(least(CAST({CEILING} * source_size AS DOUBLE), weight * (
    SELECT arg_min(level, CAST(source_size AS DOUBLE) / weight * 1000000 + rank) FROM levels WHERE weight * level <= {CEILING} * source_size)), 0) AS target
  FROM levels),
ahead AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized),
mixed AS (
  SELECT a.doc_id, a.size, f.source_size, f.target, f.rank, a.before,
         greatest(0, least(a.size, round(target) - before)) + greatest(0, least(a.size, round(target) - (source_size + before))) + greatest(0, least(a.size, round(target) - (2 * source_size + before))) AS taken
  FROM ahead a JOIN found f ON a.source IS NOT DISTINCT FROM f.source),
timed AS (SELECT *, least(1.0, CAST(before AS DOUBLE) / target) AS y, CASE rank % 2 WHEN 0 THEN {START} ELSE {2 - START} END AS s FROM mixed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN round(2 * y / (s + sqrt(greatest(0.0, s * s + 4 * (1 - s) * y))), 6) END AS position
FROM timed
"""
