"""Operator 13 against all pairs of groups over all terms, in Python integers."""

import random
import re
from collections import Counter

import pytest

from tessera.llm import divergence as D


def plain(docs, least):
    docs = [(t or "", g or "", s or "") for t, g, s in docs]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t, _, _ in docs]
    out = set()
    for lang in {g for _, g, _ in docs}:
        mine = [(s, w) for (_, g, s), w in zip(docs, words) if g == lang]
        df = Counter(x for _, w in mine for x in set(w))
        kept = sorted(x for x in df if df[x] >= least)
        count = {s: Counter(x for s2, w in mine if s2 == s for x in w if df[x] >= least) for s in {s for s, _ in mine}}
        whole = sum(count.values(), Counter())
        p = lambda c, x: 1 + 10**9 * (c[x] + 5) // (sum(c.values()) + 5 * len(kept))
        for s, c in count.items():
            pairs = [(-sum(abs(p(c, x) - p(d, x)) for x in kept), o.encode(), o) for o, d in count.items() if o != s]
            terms = [(p(whole, x) - p(c, x), x.encode(), x) for x in kept if c[x] and p(c, x) > p(whole, x)]
            for part, found in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, o, -v, r) for r, (v, _, o) in enumerate(sorted(found), 1) if part == "pair" or r <= 50}
    return out


def run(spark, docs, **how):
    df = spark.createDataFrame([(t, g, s, "x", 7, 1, "y") for t, g, s in docs], "text string, lang string, source string, term string, p long, block int, part string")
    got = [tuple(r) for r in D.audit(df.repartition(3), **how).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    vocab = ["the", "Of", "naïve", "ÉTÉ", "日本", "x" * 300] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)]
    docs = []
    for i in range(500):
        source = "hot" if i % 3 == 0 else f"s{i % 13}"
        lo = rnd.randrange(0, 140)
        docs.append((rnd.choice([" ", "-", "\x00", "1"]).join(rnd.choice(vocab[:6] + vocab[lo : lo + 12]) for _ in range(rnd.randrange(40))), rnd.choice(["en", "en", "de"]), source))
    return docs + [docs[0]] * 40 + [(None, "en", None), ("", None, "s1"), ("the of", None, None), (None, None, None), ("1 2 3", "xx", "a"), ("only here", "xx", "b")]


@pytest.mark.parametrize("light, tile, block", [(8, 2048, 64), (0, 2048, 64), (1000, 2048, 64), (3, 20, 3), (5, 100, 2)])
def test_like_all_pairs(spark, corpus, light, tile, block):
    assert run(spark, corpus, least=6, light=light, tile=tile, block=block) == plain(corpus, 6)


def test_no_terms_and_empty_table(spark, corpus):
    assert run(spark, corpus, least=10_000) == plain(corpus, 10_000) != set()
    assert run(spark, []) == set()


def test_ties_take_the_first_in_bytes(spark):
    docs = [("a b", "en", s) for s in ("B", "a", "é", "Z")]
    got = run(spark, docs, least=1)
    assert got == plain(docs, 1) and {r[3]: r[5] for r in got if r[1] == "a"} == {"B": 1, "Z": 2, "é": 3}


def test_long_texts_are_cut_at_separators():
    text = b"Ab " * 5 + b"c" * 50 + b" d"
    held, D.PIECE = D.PIECE, 8
    try:
        parts = list(D.terms_of(text))
    finally:
        D.PIECE = held
    assert sum(parts, []) == [b"ab"] * 5 + [b"c" * 50, b"d"] and len(parts) > 1


def test_share_of_large_counts(spark):
    from pyspark.sql import functions as F

    rows = [(0, 0, 1), (4 * 10**15, 8 * 10**15, 1000), (10**9, 10**9, 1), (7, 100, 33), (10**12 + 1, 3 * 10**12, 10**6)]
    got = spark.createDataFrame(rows, "c long, n long, v long").select(D.share(F.col("c"), F.col("n"), F.col("v"))).collect()
    assert [r[0] for r in got] == [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in rows]
