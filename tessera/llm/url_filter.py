"""Operator 11: URL filter by rules and by a list of canonical URLs.

A few rules (host, path prefix) decide first; the longest that fits wins. The
other URLs are looked up in a list of any length. Its canonical URLs set bits
in a blocked Bloom filter: 256-bit blocks of eight words, one bit of each word for each URL,
so that a lookup touches one block. The filter is a table (block, four longs),
built by bit_or and broadcast; MAX_BLOCKS bounds it whatever the list's length (a longer list
only lets more false positives pass). URLs that miss it are settled where they are read. Possible hits
alone are shuffled, to an exact join with the list on the whole canonical URL,
which removes the false positives. The HEAVY most frequent canonical URLs among them are joined by
broadcast instead, so no task gets all rows of a popular URL.

Canonical: host in lower case (A-Z) without one leading `www.` and without the
ports 80 and 443, path without trailing slashes, query without empty and tracking
parameters, sorted, no scheme, no fragment.

Nulls and empties: a null URL, or one without `://`, has empty host and path,
fits no rule and no list entry, and is allowed. Null and such list entries are left out, repeated ones
count once. Repeated rows stay, each with the same verdict; a null page_id is kept. An empty list
allows what no rule blocks, an empty table gives an empty result. Very long URLs are used whole.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import counted, materialise

#: (verdict, host, path) of the query.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Host labels under which the query's list takes its URLs from the table.
LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
#: Rules are configuration, compiled into one expression.
MAX_RULES = 200
#: Filter bits for each listed URL, and the greatest filter: 2^18 blocks of 256 bits are 8 MB of bits.
BITS, MAX_BLOCKS = 16, 1 << 18
#: Canonical URLs joined by broadcast.
HEAVY = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
_TRACKING = r"^(utm_[^=]*|ref|ref_src|fbclid|gclid)(=|$)"
_WORDS = 4


def _part(url: Column, k: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, k), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty if there is none."""
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return _part(url, 2)


def canonical(url: Column) -> Column:
    """The canonical form, null where the URL has no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    pairs = F.array_sort(F.filter(F.split(_part(url, 3), "&"), lambda p: (p != "") & ~p.rlike(_TRACKING)))
    query = F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), query))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits (the longer host of two as long), null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; more than {MAX_RULES} belong in the list")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def blocks_for(n: int) -> int:
    """Number of blocks, a power of two, for n URLs."""
    return min(MAX_BLOCKS, 1 << max(0, (n * BITS - 1) // 256).bit_length())


def _block(key: Column, blocks: int) -> Column:
    return F.shiftrightunsigned(key, 40).bitwiseAND(F.lit(blocks - 1).cast("long"))


def _masks(key: Column) -> list[Column]:
    """Four longs; each holds two of the eight words, with one bit set in each word."""
    bit = lambda i, up: F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(key, 5 * i).bitwiseAND(F.lit(31).cast("long")) + up).cast("int"))
    return [bit(2 * j, 0).bitwiseOR(bit(2 * j + 1, 32)) for j in range(_WORDS)]


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """listed(canonical) as the filter's rows (_b, _w0.._w3): one for each block that is not empty, at most blocks."""
    key = listed.select(F.xxhash64("canonical").alias("_h"))
    bits = key.select(_block(F.col("_h"), blocks).alias("_b"), *[m.alias(f"_m{j}") for j, m in enumerate(_masks(F.col("_h")))])
    return bits.groupBy("_b").agg(*[F.bit_or(f"_m{j}").alias(f"_w{j}") for j in range(_WORDS)])


def with_maybe(urls: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """urls(canonical, ...) with _maybe: the filter has all bits of the URL."""
    keyed = urls.withColumn("_h", F.xxhash64("canonical"))
    keyed = keyed.withColumn("_b", F.when(F.col("canonical").isNotNull(), _block(F.col("_h"), blocks)))
    hit = F.lit(True)
    for j, m in enumerate(_masks(F.col("_h"))):
        hit &= F.col(f"_w{j}").bitwiseAND(m) == m
    got = keyed.join(F.broadcast(filter_), "_b", "left").withColumn("_maybe", F.coalesce(hit, F.lit(False)))
    return got.drop("_b", "_h", *[f"_w{j}" for j in range(_WORDS)])


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """pages(page_id, url) and listed(url) to (page_id, host, path, rule, verdict, passed).

    passed: the filter let the URL pass to the exact join; false where a rule decided.
    """
    spark = pages.sparkSession
    names, n = counted(listed.select(canonical(F.col("url")).alias("canonical")).where("canonical is not null").distinct(), "listed")
    blocks = blocks_for(n)
    url = F.col("url")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("_c"))
    ruled = parts.withColumn("_r", rule_for(F.col("host"), F.col("path"), rules))
    ruled = ruled.select("page_id", "host", "path", "_r.rule", F.col("_r.verdict").alias("_v"), F.when(F.col("_r").isNull(), F.col("_c")).alias("canonical"))
    # The filter is bounded by MAX_BLOCKS rows of five longs.
    probed = with_maybe(ruled, bloom(names, blocks), blocks)
    out = ["page_id", "host", "path", "rule", "verdict", "passed"]
    missed = probed.where("not _maybe").select("page_id", "host", "path", "rule", F.coalesce("_v", F.lit("allow")).alias("verdict"), F.lit(False).alias("passed"))
    hits = materialise(probed.where("_maybe").select("page_id", "host", "path", "rule", "canonical"), "url-hits")
    found = names.select("canonical", F.lit(True).alias("_in"))
    heavy = materialise(hits.groupBy("canonical").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "canonical").limit(HEAVY).select("canonical"), "url-heavy")
    marks = heavy.join(found, "canonical", "left").select("canonical", F.lit(True).alias("_heavy"), "_in")
    # At most HEAVY rows.
    split = hits.join(F.broadcast(marks.select("canonical", "_heavy", F.coalesce("_in", F.lit(False)).alias("_hin"))), "canonical", "left")
    many = split.where("_heavy").withColumn("_in", F.col("_hin"))
    few = split.where("_heavy is null").join(found, "canonical", "left")
    verdict = F.when(F.col("_in"), "block").otherwise("allow").alias("verdict")
    settled = [d.select("page_id", "host", "path", "rule", verdict, F.lit(True).alias("passed")) for d in (many, few)]
    return missed.unionByName(settled[0]).unionByName(settled[1]).select(*out)


def under_labels(pages: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """(url) of pages whose host has one of the labels: the list that the query derives from the table."""
    hit = F.arrays_overlap(F.split(host_of(F.col("url")), r"\."), F.array(*[F.lit(x) for x in labels]))
    return pages.where(hit).select("url")


def _fits(verdict: str, host: str, path: str) -> str:
    return f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN {{'rule': '{host}{path}', 'verdict': '{verdict}'}}"


_RULES_SQL = " ".join(_fits(*r) for r in sorted(RULES, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1]))))

SQL = f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''), '{_UPPER}', '{_LOWER}') AS host, coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path,
         list_sort(list_filter(string_split(coalesce(regexp_extract(url, '{_PARTS}', 3), ''), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '{_TRACKING}'))) AS pairs FROM pages),
keyed AS (
  SELECT *, regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') || CASE WHEN len(pairs) > 0 THEN '?' || array_to_string(pairs, '&') ELSE '' END AS c,
         CASE {_RULES_SQL} END AS r FROM parts),
listed AS (SELECT DISTINCT c AS url FROM keyed WHERE list_has_any(string_split(host, '.'), [{', '.join(f"'{x}'" for x in LABELS)}]))
SELECT page_id, host, path, r.rule AS rule, CASE WHEN r IS NOT NULL THEN r.verdict WHEN host <> '' AND c IN (SELECT url FROM listed) THEN 'block' ELSE 'allow' END AS verdict FROM keyed"""


def query(pages: DataFrame) -> DataFrame:
    return judge(pages, under_labels(pages)).select("page_id", "host", "path", "rule", "verdict")
