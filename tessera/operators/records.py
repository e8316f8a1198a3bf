"""Validation, export records, manifest, merge and contract checks
(P-05..P-08, P-14..P-18, P-26, P-28, A-01, A-27, A-28, A-31, J-09..J-11, F-31..F-33, X-02, B7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import urls as U
from tessera.operators.feeds import upper_median_by
from tessera.vocab import PLACEHOLDER, RELEASE_TYPES, TECH_DOMAINS, TEXT_MAX


def _words(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def violations(summary: Column, domains: Column, release: Column, prior_art: Column, score: Column, rationale: Column) -> Column:
    """Names of the broken rules of an extracted record; empty if it is valid (P-05)."""
    rules = (
        ("summary_length", ~F.length(summary).between(20, 600)), ("domain_count", ~F.size(domains).between(1, 3)), ("domain_vocab", F.size(F.array_except(domains, _words(TECH_DOMAINS))) > 0),
        ("release_vocab", ~release.isin(*RELEASE_TYPES)), ("tag_count", F.size(prior_art) > 8), ("score_range", ~score.between(1, 5)), ("rationale_length", ~F.length(rationale).between(15, 300)),
    )
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules]))


def gate_valid(reason: Column) -> Column:
    return F.coalesce(F.length(reason).between(10, 200), F.lit(False))


def golden_valid(status: Column, impact: Column, body: Column, by: Column, at: Column, whole: Column) -> Column:
    """A confirmed item has an impact, a body and its labeller, and no placeholder anywhere (P-07). whole: the row as JSON."""
    full = impact.isNotNull() & F.coalesce(F.trim(body) != "", F.lit(False)) & by.isNotNull() & at.isNotNull() & ~F.contains(whole, F.lit(PLACEHOLDER))
    return (status != "confirmed") | full


def slots_valid(slots: Column) -> Column:
    """slots: the four label arrays. The event has 1 to 3, the others 0 to 3, none blank, all distinct after strip (P-08)."""
    every = F.transform(F.flatten(slots), lambda s: F.trim(s))
    sizes = F.forall(slots, lambda s: F.size(s) <= 3) & (F.size(slots[0]) >= 1)
    return sizes & F.forall(every, lambda s: s != "") & (F.size(F.array_distinct(every)) == F.size(every))


def ontology_block(ontology: Column) -> Column:
    """The contract's ontology: impact flattened to score and rationale, companies projected to four fields (P-14).

    ontology: struct(tech_domains, release_type, companies array<struct(canonical, raw, resolved, role)>, prior_art, impact struct(score, rationale), summary). A missing list is empty, a company without resolved is not resolved.
    """
    company = lambda c: F.struct(c.canonical.alias("canonical"), c.raw.alias("raw"), F.coalesce(c.resolved, F.lit(False)).alias("resolved"), c.role.alias("role"))
    none = F.array().cast("array<struct<canonical:string,raw:string,resolved:boolean,role:string>>")
    return F.struct(
        ontology.tech_domains.alias("tech_domains"), ontology.release_type.alias("release_type"), F.coalesce(F.transform(ontology.companies, company), none).alias("companies"), F.coalesce(ontology.prior_art, F.array().cast("array<string>")).alias("prior_art"),
        ontology.impact.score.alias("impact_score"), ontology.impact.rationale.alias("impact_rationale"), ontology.summary.alias("summary"))


def export_records(store: DataFrame, version: str, vocab_version: str) -> DataFrame:
    """Contract records of stored rows (url, title, body, tags, source_name, published_at, collected_at, gate, extraction, ontology): 17 columns."""
    url, clamp = F.col("url"), T.clamp_text(F.coalesce("body", F.lit("")))
    provenance = F.struct(
        F.col("extraction.model").alias("extraction_model"), F.col("extraction.prompt_name").alias("prompt_version"), F.col("extraction.prompt_sha256").alias("prompt_sha256"), F.col("extraction.extracted_at").alias("extracted_at"),
        F.col("gate.model").alias("gate_model"), F.col("gate.prompt_name").alias("gate_prompt_version"), F.lit(vocab_version).alias("vocab_version"))
    named = store.withColumn("_c", clamp)
    return named.select(
        F.lit(version).alias("contract_version"), U.doc_id(url).alias("doc_id"), U.source_for(url).alias("source"), "source_name", U.canonical_url(url).alias("url"), "title", T.declared_lang(F.col("tags")).alias("lang"),
        F.col("_c.text").alias("text"), F.lit("source_text").alias("text_origin"), F.length("_c.text").cast("long").alias("text_chars"), F.col("_c.truncated").alias("text_truncated"), U.locator_for(url).alias("locator"),
        F.nullif(F.col("published_at").cast("string"), F.lit("")).alias("published_at"), F.col("collected_at").cast("string").alias("collected_at"), (F.length("_c.text") >= 1).alias("indexable"), "ontology", provenance.alias("provenance"))


def indexable(origin: Column, chars: Column) -> Column:
    return (origin == "source_text") & (chars >= 1)


def schema_sha256() -> Column:
    """Hash of both vocabularies in their order."""
    return F.sha2(F.lit("tech_domain=" + ",".join(TECH_DOMAINS) + ";release_type=" + ",".join(RELEASE_TYPES)), 256)


def manifest_counts(records: DataFrame) -> DataFrame:
    """(block, value, n): totals, records by source name, release type and domain, and unresolved company mentions.

    One pass: every record is exploded to the counters it adds to, which are summed on the map side.
    """
    one = lambda block, value, n=1: F.array(F.struct(F.lit(block).alias("block"), value.alias("value"), (F.lit(n) if isinstance(n, int) else n).cast("long").alias("n")))
    ok = (F.length("text") >= 1).cast("long")
    unresolved = F.size(F.filter("companies", lambda c: ~c.resolved))
    every = F.concat(
        one("total", F.lit("")), one("indexable", F.lit(""), ok), one("excluded_empty_text", F.lit(""), 1 - ok), one("companies_unresolved", F.lit(""), unresolved),
        one("by_source_name", F.col("source_name")), one("by_release_type", F.col("release_type")), F.transform("tech_domains", lambda d: F.struct(F.lit("by_tech_domain").alias("block"), d.alias("value"), F.lit(1).cast("long").alias("n"))))
    return records.select(F.explode(every).alias("x")).select("x.*").groupBy("block", "value").agg(F.sum("n").alias("n"))


def last_of_each(df: DataFrame, key: str, order: str) -> DataFrame:
    """Latest wins: the last row of each key (S-13, S-15, S-23)."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))).where("_r = 1").drop("_r")


def merge(snapshot: DataFrame, records: DataFrame, order: str) -> DataFrame:
    """Full outer upsert on doc_id: matched rows take ontology and url from the record and keep text, title and locator; adds merged.

    Of several records on an id the last one gives ontology and url; for a new id the first gives the text.
    """
    group = records.groupBy("doc_id").agg(
        F.max_by(F.struct("ontology", "url"), order).alias("_last"), F.min_by(F.struct("title", "text", "locator"), order).alias("_first"), F.count(F.lit(1)).alias("_n"))
    s = snapshot.select("doc_id", F.struct("title", "text", "locator", "url").alias("_s"))
    both = s.join(group, "doc_id", "full")
    return both.select(
        "doc_id", F.coalesce("_s.title", "_first.title").alias("title"), F.coalesce("_s.text", "_first.text").alias("text"), F.coalesce("_s.locator", "_first.locator").alias("locator"),
        F.coalesce("_last.url", "_s.url").alias("url"), F.col("_last.ontology").alias("ontology"), ((F.col("_s").isNotNull() & (F.col("_n") >= 1)) | (F.col("_n") > 1)).alias("merged"))


def broken_pairs(pairs: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Expected documents that the merged corpus lacks, or whose text it changed (J-10)."""
    lacking = pairs.join(after.select("doc_id"), "doc_id", "left_anti").withColumn("why", F.lit("missing"))
    old, new = before.select("doc_id", F.col("text").alias("_a")), after.select("doc_id", F.col("text").alias("_b"))
    drift = pairs.join(old, "doc_id").join(new, "doc_id").where("_a <> _b").select(*pairs.columns).withColumn("why", F.lit("text_changed"))
    return lacking.unionByName(drift)


TOP_KEYS = ("contract_version", "doc_id", "source", "source_name", "url", "title", "lang", "text", "text_origin", "text_chars", "text_truncated", "locator", "published_at", "collected_at", "indexable", "ontology", "provenance")
PROVENANCE_KEYS = ("extraction_model", "prompt_version", "prompt_sha256", "extracted_at", "vocab_version")


def checks(records: DataFrame, manifest: DataFrame, prompts: DataFrame, snapshot: DataFrame, pairs: DataFrame, version: str, expected: int) -> DataFrame:
    """The contract's numbered checks: (number, name, failures, status). A check passes if it counts no failures; 13 is always PENDING.

    records and manifest as of export_records() and manifest_counts(); prompts(prompt_version, sha256); pairs(case_id, doc_id).
    """
    rec = records
    n = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    missing = len([k for k in TOP_KEYS if k not in rec.columns])
    blank = reduce(lambda a, b: a | b, [F.coalesce(F.trim(F.col(f"provenance.{k}")) == "", F.lit(True)) for k in PROVENANCE_KEYS])
    hashes = rec.select(F.col("provenance.prompt_version").alias("prompt_version"), F.col("provenance.prompt_sha256").alias("_h")).join(prompts, "prompt_version", "left")
    merged = merge(snapshot, rec.withColumn("_o", F.col("doc_id")), "_o")
    matched = rec.join(snapshot.select("doc_id", F.col("text").alias("_t")), "doc_id").join(merged.select("doc_id", F.col("text").alias("_m"), "merged"), "doc_id")
    allowed = lambda col, words: F.size(F.array_except(col, _words(words))) > 0
    by = lambda block: F.coalesce(F.sum(F.when(F.col("block") == block, F.col("n"))), F.lit(0))
    ones = rec.agg(
        (F.lit(missing) + F.count_if(F.col("contract_version") != version) + F.count_if(~F.col("source").isin("arxiv", "news")) + F.abs(F.count(F.lit(1)) - expected) + F.count(F.lit(1)) - F.count_distinct("doc_id")).cast("long").alias("c1"),
        F.count_if(blank).alias("c2"), F.count_if(F.col("text_origin") != "source_text").alias("c4"),
        F.count_if((F.length("text") > TEXT_MAX) | (F.length("text") != F.col("text_chars"))).alias("c8"), F.count_if(F.col("indexable") != indexable(F.col("text_origin"), F.col("text_chars"))).alias("c9"),
        F.count_if(allowed(F.col("ontology.tech_domains"), TECH_DOMAINS) | ~F.col("ontology.release_type").isin(*RELEASE_TYPES)).alias("c10"), F.count_if(F.col("published_at") == "").alias("c11"), F.count(F.lit(1)).alias("rows"))
    parts = [
        ones.select(F.explode(F.array(*[F.struct(F.lit(k).alias("number"), F.col(f"c{k}").alias("n")) for k in (1, 2, 4, 8, 9, 10, 11)])).alias("x")).select("x.*"),
        n(hashes.where(F.col("sha256").isNull() | (F.col("sha256") != F.col("_h")))).select(F.lit(3).alias("number"), "n"),
        n(matched.where(~F.col("merged") | (F.col("_m") != F.col("_t")))).select(F.lit(5).alias("number"), "n"),
        n(broken_pairs(pairs, snapshot, merged)).select(F.lit(6).alias("number"), "n"),
        n(rec.groupBy("doc_id").agg(F.count_distinct(F.hash("text", "url", "title")).alias("v")).where("v > 1")).select(F.lit(7).alias("number"), "n"),
        manifest.agg(by("total").alias("t"), by("indexable").alias("i"), by("excluded_empty_text").alias("e"), by("by_source_name").alias("s"), by("by_release_type").alias("r")).select(F.lit(12).alias("number"), ((F.col("i") + F.col("e") != F.col("t")).cast("long") + (F.col("s") != F.col("t")).cast("long") + (F.col("r") != F.col("t")).cast("long")).alias("n")),
    ]
    names = {1: "end_to_end", 2: "provenance", 3: "prompt_hash", 4: "text_origin", 5: "arxiv_merge", 6: "golden_pairs", 7: "reproducible", 8: "text_limit", 9: "indexable", 10: "vocabulary", 11: "null_dates", 12: "manifest", 13: "consumer"}
    name = F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("number"))
    done = reduce(lambda a, b: a.unionByName(b), parts)
    pending = ones.select(F.lit(13).alias("number"), F.lit(None).cast("long").alias("n"))
    out = done.unionByName(pending)
    return out.select("number", name.alias("name"), F.coalesce("n", F.lit(0).cast("long")).alias("failures"), F.when(F.col("number") == 13, "PENDING").when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"))


def length_range(records: DataFrame, key: str) -> DataFrame:
    """Least, upper median and greatest text length, and rows left out of the index, of each key (A-27)."""
    sized = records.withColumn("_len", F.length("text").cast("long"))
    base = sized.groupBy(key).agg(F.min("_len").alias("shortest"), F.max("_len").alias("longest"), F.count_if(F.col("_len") < 1).alias("excluded"))
    return base.join(upper_median_by(sized, [key], "_len", "median"), key)


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def fingerprint_diff(approved: DataFrame, current: DataFrame) -> DataFrame:
    """(section, name, kind) of what differs between two fingerprints (section, name, value): added, removed or changed (J-15)."""
    a, b = approved.select("section", "name", F.col("value").alias("_a")), current.select("section", "name", F.col("value").alias("_b"))
    kind = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    return a.join(b, ["section", "name"], "full").select("section", "name", kind.alias("kind")).where("kind is not null")


def mismatches(approved: DataFrame, current: DataFrame) -> DataFrame:
    """(section, name, why) of what a current fingerprint has that the approved one does not allow (O-08).

    Both are (section, name, value). Sections limits.*: a limit may be lowered, not raised or added. Section endpoint: a null value cannot be resolved, which
    is a mismatch of its own. Other sections: values are equal. What the current one lacks narrows the run, and passes.
    """
    a = approved.select("section", "name", F.col("value").alias("_a"))
    got = current.select("section", "name", F.col("value").alias("_b")).join(a, ["section", "name"], "left")
    limit, before, after = F.col("section").startswith("limits."), F.col("_a"), F.col("_b")
    why = (F.when((F.col("section") == "endpoint") & after.isNull(), "unresolved").when(limit, F.when(before.isNull(), "added").when(after.cast("long") > before.cast("long"), "raised"))
           .when(~after.eqNullSafe(before), F.when(before.isNull(), "added").otherwise("changed")))
    return got.select("section", "name", why.alias("why")).where("why is not null")


def preflight(approval: DataFrame, found: DataFrame, now: Column, vendor_file: bool = False, schema: int = 1) -> DataFrame:
    """(key, detail) of all that stands against a scheduled run before any call (O-08): approval(schema, expires_at) of at most one row, found of mismatches()."""
    record = approval.agg(F.max(F.struct(F.lit(True).alias("there"), "schema", "expires_at")).alias("r")).select("r.*")
    state = (F.when(F.col("there").isNull(), "no approval").when(~F.coalesce(F.col("schema") == schema, F.lit(False)), "unreadable approval").when(F.col("expires_at").isNull() | (now >= F.col("expires_at")), "approval expired"))
    own = record.select(F.lit("approval").alias("key"), state.alias("detail")).where("detail is not null")
    if vendor_file:
        own = own.unionByName(record.select(F.lit("vendor_approval").alias("key"), F.lit("an approval of a vendor run is left over").alias("detail")))
    readable = record.select((F.coalesce(F.col("schema") == schema, F.lit(False))).alias("_ok"))
    return own.unionByName(found.join(F.broadcast(readable), F.col("_ok")).select(F.concat_ws(".", "section", "name").alias("key"), F.col("why").alias("detail")))


def qualifies(runs: DataFrame, limits: Column) -> DataFrame:
    """The latest finished run with mode config whose limit map equals the configured one (J-16). Maps are compared as sorted entries."""
    entries = lambda m: F.array_sort(F.map_entries(m))
    ok = runs.where((F.col("mode") == "config") & F.col("finished") & (entries(F.col("limits")) == entries(limits)))
    return ok.agg(F.max_by(F.struct("*"), "run_id").alias("r")).where("r is not null").select("r.*")
