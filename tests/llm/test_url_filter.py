"""Operator 11 against a plain version that looks each URL up in a set."""

import random
import re

from pyspark.sql import functions as F

from tessera.llm import url_filter as U

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    tail = rest[len(host) + len(path) :]
    query = tail[1:].split("#")[0] if tail.startswith("?") else ""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path, query


def canon(url):
    host, path, query = parts(url)
    host = host.removeprefix("www.")
    for port in (":80", ":443"):
        host = host.removesuffix(port) if host.endswith(port) else host
    kept = sorted((p for p in query.split("&") if p and not (p.split("=")[0].startswith("utm_") or p.split("=")[0] in ("ref", "ref_src", "fbclid", "gclid"))), key=str.encode)
    return host and host + path.rstrip("/") + ("?" + "&".join(kept) if kept else "")


def plain(url, listed):
    host, path, _ = parts(url)
    fit = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fit) if fit else None
    verdict = rule[2] if rule else "block" if canon(url) and canon(url) in listed else "allow"
    return host, path, rule and rule[1], verdict


URLS = [None, "", "no scheme", "://", "x://", "http://", "https://Example.ORG", "https://example.org/", "http://a.example.org/es/x", "https://notexample.org/es/", "https://example.org/en/1?x", "https://example.org/en/12", "https://example.com/fr/1", "http://COM/de/",
        "https://www.list.net/a/?utm_source=x&b=2&a=1#f", "http://list.net:80/a?a=1&b=2", "https://list.net/A", "https://list.net?x=1", "https://list.net#x", "https://ÄÖ.net/é", "http://list.net/a://b?c", "https://list.net/" + "long/" * 20_000, "https://list.net/a\nb"]


def test_like_a_set(spark):
    rnd = random.Random(5)
    made = [f"http{rnd.choice(['', 's'])}://{rnd.choice(['', 'www.'])}h{rnd.randrange(40)}.net/p{rnd.randrange(300)}{rnd.choice(['', '/', '#t', '?ref=x', '?q=1'])}" for _ in range(6000)]
    urls = URLS + URLS[:9] + made + [made[0]] * 3000  # a URL of a third of all rows
    names = [u for i, u in enumerate(made) if i % 3 == 0] + ["https://list.net/a?b=2&a=1", "http://www.list.net/" + "long/" * 20_000, None, "junk", "https://ÄÖ.net/é/"]
    listed = {canon(u) for u in names if canon(u)}
    pages = spark.createDataFrame([(i if i % 50 else None, u, "x", 1) for i, u in enumerate(urls)], "page_id long, url string, canonical string, _b int").withColumn("rule", F.lit(3))
    got = U.judge(pages, spark.createDataFrame([(u,) for u in names], "url string")).collect()
    want = sorted(repr((i if i % 50 else None, *plain(u, listed))) for i, u in enumerate(urls))
    assert sorted(repr(tuple(r)[:5]) for r in got) == want
    blocked = [r for r in got if r.verdict == "block" and r.rule is None]
    assert blocked and all(r.passed for r in blocked)


def test_filter_passes_all_listed_and_few_others(spark):
    n = 3000
    blocks = U.blocks_for(n)
    assert blocks * 256 >= n * U.BITS and U.blocks_for(0) == U.blocks_for(1) == 1 and U.blocks_for(10**9) == U.MAX_BLOCKS
    url = F.concat(F.lit("h.net/"), F.col("id").cast("string"))
    listed = spark.range(n).select(url.alias("canonical"))
    bits = U.bloom(listed, blocks)
    assert bits.count() <= blocks
    got = U.with_maybe(spark.range(10 * n).select("id", url.alias("canonical")), bits, blocks)
    inside, wrong = got.agg(F.count_if(F.col("_maybe") & (F.col("id") < n)), F.count_if(F.col("_maybe") & (F.col("id") >= n))).first()
    assert inside == n and wrong < 0.01 * 9 * n


def test_a_full_filter_is_still_exact(spark, monkeypatch):
    monkeypatch.setattr(U, "MAX_BLOCKS", 1)
    monkeypatch.setattr(U, "HEAVY", 2)
    url = F.concat(F.lit("http://h.net/"), F.col("id").cast("string"))
    pages, listed = spark.range(2000).select(F.col("id").alias("page_id"), url.alias("url")), spark.range(0, 2000, 2).select(url.alias("url"))
    got = U.judge(pages, listed)
    assert got.where("(verdict = 'block') <> (page_id % 2 = 0)").count() == 0 and got.count() == 2000 and got.where("passed and verdict = 'allow'").count() > 900


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    one = spark.createDataFrame([(1, "https://a.net/x")], "page_id long, url string")
    assert U.judge(none, one).count() == 0
    assert [tuple(r)[:5] for r in U.judge(one, none).collect()] == [(1, "a.net", "/x", None, "allow")]
