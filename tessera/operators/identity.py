"""Organisation names: alias index, resolution, queue of unknown names (W-13, J-05, J-06, A-22, A-23)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import normalization_key, strip
from tessera.vocab import ALIAS_ARTICLES

#: One trailing pair of brackets (ASCII or full width), none before it.
_PAREN = r"^([^()（）]+?)\s*[(（]([^()（）]+)[)）]\s*$"


def alias_index(spark: SparkSession, aliases: dict[str, list[str]]) -> DataFrame:
    """(key, canonical): every alias and canonical name; of two claims on a key the first registered wins."""
    rows, at = [], 0
    for canonical, names in aliases.items():
        for name in (canonical, *(names or [])):
            rows.append((at, name, canonical))
            at += 1
    df = spark.createDataFrame(rows, "ord int, name string, canonical string").withColumn("key", normalization_key(F.col("name")))
    return df.where("key <> ''").groupBy("key").agg(F.min_by("canonical", "ord").alias("canonical"))


def resolve(names: DataFrame, index: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds canonical, resolved and conflict. The dictionary is configuration, a few rows, and is broadcast."""
    small = F.broadcast(index)
    look = lambda df, col, out: df.join(small.select(F.col("key").alias(f"_{out}"), F.col("canonical").alias(out)), F.col(col) == F.col(f"_{out}"), "left").drop(f"_{out}")
    name = F.col(raw)
    df = names.withColumn("_k", normalization_key(name)).withColumn("_o", normalization_key(F.regexp_extract(strip(name), _PAREN, 1))).withColumn("_i", normalization_key(F.regexp_extract(strip(name), _PAREN, 2)))
    for col, out in (("_k", "_whole"), ("_o", "_outer"), ("_i", "_inner")):
        df = look(df, col, out)
    hits = F.array_distinct(F.array_compact(F.array("_outer", "_inner")))
    canonical = F.coalesce(F.col("_whole"), F.when(F.size(hits) == 1, hits[0]))
    out = df.withColumn("canonical", F.coalesce(canonical, strip(name))).withColumn("resolved", canonical.isNotNull())
    out = out.withColumn("conflict", F.when(F.col("_whole").isNull() & (F.size(hits) > 1), hits).otherwise(F.array().cast("array<string>")))
    return out.drop("_k", "_o", "_i", "_whole", "_outer", "_inner")


def unknown_queue(mentions: DataFrame) -> DataFrame:
    """mentions(ord, raw, article, at, conflict) to one row a key: first spelling and article, counts, articles in order, latest conflict."""
    m = mentions.withColumn("key", normalization_key(F.col("raw"))).where("key <> ''")
    # One row for each key and article first, so that a very common name is reduced before it meets itself.
    each = m.groupBy("key", "article").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n"), F.min_by("raw", "ord").alias("raw"), F.min_by("at", "ord").alias("at"), F.max(F.when(F.size("conflict") > 0, F.struct("ord", "conflict"))).alias("conflict"))
    return each.groupBy("key").agg(
        F.min_by("raw", "ord").alias("raw_name"), F.min_by("article", "ord").alias("source_article"), F.min_by("at", "ord").alias("first_seen"),
        F.sum("n").alias("occurrence_count"), F.count(F.lit(1)).alias("article_count"), F.max("conflict").alias("_c"), F.min("ord").alias("ord")).select("*", F.coalesce("_c.conflict", F.array().cast("array<string>")).alias("conflict")).drop("_c")


def alias_candidates(queue: DataFrame, least: int = ALIAS_ARTICLES) -> DataFrame:
    """Names in at least that many articles, the most frequent first."""
    return queue.where(F.col("article_count") >= least).orderBy(F.desc("article_count"), F.desc("occurrence_count"), "ord")


def prune_resolved(queue: DataFrame, index: DataFrame) -> DataFrame:
    """The queue without names that the dictionary resolves by now."""
    return queue.join(F.broadcast(index.select("key")), "key", "left_anti")


def alias_arrays_agree(a: Column, b: Column) -> Column:
    """Jaccard index of two name sets by matching key; two empty sets agree fully (F-20, F-22, X-01)."""
    keys = lambda x: F.array_distinct(F.transform(F.filter(x, lambda n: n.isNotNull() & (n != "")), normalization_key))
    return jaccard(keys(a), keys(b))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)
