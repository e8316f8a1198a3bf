"""Operator 2: secret scan with corpus-wide ownership frequency. DataFrame functions only.

Base spans come from the three patterns of KINDS, leftmost and non-overlapping for each.
Positions are sums of the lengths of the matches and of the gaps between them. The method adds
opaque tokens: long runs with digits and letters in both cases. Every value's hash is counted over the
whole corpus by distinct documents and owners; an opaque token becomes a span
only if at most OWNERS owners hold it, for one that more owners hold is a copied example.
Base spans stay whatever their counts, which live and examples report.

Hashes are counted in three steps (document, owner, hash), so one value that a third of
all rows share is reduced before it meets itself.

Nulls and empties: a null text counts as empty and has no spans; null owners and documents count as one
each. Equal rows give equal results, each its own row. An empty table gives an empty result. Extra columns
are ignored, or kept by redact().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, whole

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kinds in their order, each with its pattern, the group that is the value, and the value's least length.
KINDS = (("assign", ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24))
#: As searched: runs that are too short are never met, which changes no match.
SEARCHED = {"access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
OPAQUE = r"[A-Za-z0-9_-]{32,}"
OWNERS = 2
MARK = "[SECRET]"
SPAN = "struct<start:int,kind:int,end:int,hash:string>"


def _spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """All matches of a pattern: array of (start, kind, end, hash of the value)."""
    hits, values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.zip_with(F.split(text, pattern, -1), F.zip_with(hits, values, lambda h, v: F.struct(F.length(h).alias("n"), v.alias("v"))), lambda g, x: F.struct(F.length(g).alias("gap"), x.n.alias("n"), x.v.alias("v")))
    none = F.array().cast(f"array<{SPAN}>")
    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc.at + x.gap
        end = start + F.coalesce(x.n, F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), F.sha2(x.v, 256).alias("hash"))
        return F.struct(end.alias("at"), F.when(F.length(x.v) >= least, F.concat(acc.out, F.array(span))).otherwise(acc.out).alias("out"))

    return F.when(F.rlike(text, F.lit(pattern)), F.aggregate(parts, zero, step, lambda acc: acc.out)).otherwise(none)


def base_spans(text: Column) -> Column:
    """Base spans of a text, by start, then kind."""
    return F.array_sort(F.concat(*[_spans(text, k, SEARCHED.get(name, pattern), group, least) for k, (name, pattern, group, least) in enumerate(KINDS)]))


def found(text: Column) -> Column:
    """Base spans and opaque candidates of a text (kind 3), by start, then kind."""
    return F.array_sort(F.concat(base_spans(text), _opaque(text)))


def _opaque(text: Column) -> Column:
    mixed = rf"(?=[A-Za-z_-]*[0-9])(?=[a-z0-9_-]*[A-Z])(?=[A-Z0-9_-]*[a-z]){OPAQUE}"
    return _spans(text, 3, rf"(?<![A-Za-z0-9_-]){mixed}", 0, 32)


def ownership(spans: DataFrame) -> DataFrame:
    """spans(hash, repo, owner) to (hash, repos, owners): the distinct ones that hold each hash."""
    once = spans.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    held = once.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return held.groupBy("hash").agg(F.sum("n").alias("repos"), F.count(F.lit(1)).alias("owners"))


def _key(text: Column, doc_id: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.sha2(text, 256)), 256)


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, live, examples."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("owner"), _text().alias("text"))
    rows = rows.select("doc_id", "owner", "text", found(F.col("text")).alias("found"))
    rows = materialise(rows.select("doc_id", "owner", F.when(F.size("found") > 0, _key(F.col("text"), F.col("doc_id"))).alias("key"), "found"), "spans")
    some = rows.where("size(found) > 0")
    each = some.select("key", "owner", F.coalesce("doc_id", F.lit(-1)).alias("repo"), F.explode("found").alias("x")).select("key", "owner", "repo", "x.*")
    counts = ownership(each.select("hash", "repo", "owner"))
    judged = each.select("key", "start", "kind", "end", "hash").distinct().join(counts, "hash").withColumn("live", F.col("owners") <= OWNERS)
    extra = judged.groupBy("key").agg(
        F.collect_list(F.when((F.col("kind") == 3) & F.col("live"), F.struct("start", "kind", "end", "hash"))).alias("added"),
        F.count_if(F.col("live")).alias("live"), F.count_if(~F.col("live")).alias("examples"))
    none = rows.where("size(found) = 0").select("doc_id", F.lit(0).cast("long").alias("live"), F.lit(0).cast("long").alias("examples"), F.array().cast(f"array<{SPAN}>").alias("base"), F.array().cast(f"array<{SPAN}>").alias("all"))
    base = F.filter("found", lambda x: x.kind < 3)
    full = some.join(extra, "key").select("doc_id", "live", "examples", base.alias("base"), F.array_sort(F.concat(base, "added")).alias("all"))
    names = F.array(*[F.lit(k[0]) for k in KINDS], F.lit("opaque"))
    said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x.kind + 1), x.start.cast("string"), x.end.cast("string"))), ",")
    n = lambda k: F.size(F.filter("base", lambda x: x.kind == k)).cast("long")
    return none.unionByName(full).select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(said(F.col("base")), 256).alias("base_sha256"), said(F.col("all")).alias("spans"), "live", "examples")


def _masked(text: Column, spans: Column) -> Column:
    """text with each stretch that spans cover replaced by MARK."""
    def step(acc: Column, x: Column) -> Column:
        kept = F.when(x.start >= acc.at, F.concat(acc.out, F.substr(text, acc.at + 1, x.start - acc.at), F.lit(MARK))).otherwise(acc.out)
        return F.struct(F.greatest(acc.at, x.end).alias("at"), kept.alias("out"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc.out, F.substr(text, acc.at + 1)))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their columns; base spans and opaque tokens of few owners are masked, n_chars follows the text."""
    text, doc_id, source = F.coalesce("doc.text", F.lit("")), F.col("doc.doc_id"), F.col("doc.source")
    rows = docs.select(whole(docs).alias("doc"))
    # One cheap pattern parts the few texts with opaque runs, whose owners are counted first, from all others; each text is then searched once.
    has = F.rlike(text, F.lit(OPAQUE))
    rare = rows.where(has).select(_opaque(text).alias("found"), F.coalesce(source.cast("string"), F.lit("")).alias("owner"), F.coalesce(doc_id.cast("long"), F.lit(-1)).alias("repo"), _key(text, doc_id).alias("key"))
    each = materialise(rare.select("owner", "repo", "key", F.explode("found").alias("x")).select("owner", "repo", "key", "x.hash"), "opaque")
    few = ownership(each.select("hash", "repo", "owner")).where(F.col("owners") <= OWNERS).select("hash")
    live = each.select("key", "hash").distinct().join(few, "hash").groupBy("key").agg(F.collect_set("hash").alias("live"))
    plain = rows.where(~has).select("doc", base_spans(text).alias("spans"))
    known = rows.where(has).select("doc", _key(text, doc_id).alias("key")).join(live, "key", "left").select("doc", found(text).alias("found"), "live")
    known = known.select("doc", F.expr("filter(found, x -> x.kind < 3 or array_contains(coalesce(live, array()), x.hash))").alias("spans"))
    masked = F.when(F.size("spans") > 0, _masked(F.col("doc.text"), F.col("spans"))).otherwise(F.col("doc.text"))
    out = plain.unionByName(known).select("doc", masked.alias("text")).withColumn("doc", F.col("doc").withField("text", F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("doc", F.col("doc").withField("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select("doc.*")
