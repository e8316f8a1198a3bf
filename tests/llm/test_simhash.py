import random
import re

import numpy as np
import xxhash

from tessera.llm import banding
from tessera.llm import simhash as S


def slow(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints):
    root = list(range(len(prints)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    f = np.array(prints, np.uint64)
    for i, j in zip(*np.nonzero(np.bitwise_count(f[:, None] ^ f[None]) <= 2)):
        a, b = top(i), top(j)
        root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(prints))]


def test_fingerprints(spark, odd_docs, no_docs):
    got = S.near_duplicates(odd_docs).collect()
    assert len(got) == 13
    want = sorted(f"{slow(r.text):016x}" for r in odd_docs.collect())
    assert sorted(r.fingerprint for r in got) == want
    assert {r.component_id for r in got if r.doc_id in (1, 6)} == {1}
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {2}
    assert S.near_duplicates(no_docs).count() == 0
    kept = S.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len(set(classes(list({int(r.fingerprint, 16) for r in got}))))
    assert S.keep_one(no_docs).count() == 0


def planted(rnd, n=300):
    """Random prints, chains at distance 1 and 2, a hot ball and exact copies."""
    out = [rnd.getrandbits(64) for _ in range(n)]
    for k in range(40):
        x = out[k]
        for _ in range(rnd.randint(1, 4)):
            x ^= 1 << rnd.randrange(64)
            if rnd.random() < 0.6:
                x ^= 1 << rnd.randrange(64)
            out.append(x)
    c = rnd.getrandbits(64)
    out += [c ^ (1 << b) for b in range(64)] + [c ^ (1 << b) ^ (1 << ((b * 7 + 1) % 64)) for b in range(30)]
    return list(dict.fromkeys(out))


def components_of(spark, prints, cap):
    signed = [int(np.array([p], np.uint64).view(np.int64)[0]) for p in prints]
    reps = spark.createDataFrame([(x,) for x in signed], "fp long")
    label = {r.node: r.label for r in S.components(S.links(reps, cap)).collect()}
    return [label.get(x, x) for x in signed]


def test_links_are_whole(spark, monkeypatch):
    prints = planted(random.Random(5))
    want = classes(prints)
    same = lambda got: len(set(zip(got, want))) == len(set(got)) == len(set(want))
    assert same(components_of(spark, prints, 2048))
    assert same(components_of(spark, prints, 2))  # all buckets by one-bit neighbours
    for thresholds in ((0, 0, 0), (1, 0), (0, 1), (-1, 0, 1), (2,)):
        parts = S.group_bits(np.eye(64) * len(prints) / 2, len(prints), len(thresholds))
        monkeypatch.setattr(S, "plan", lambda reps, distance, parts=parts, ts=thresholds: [(b, t) for b, t in zip(parts, ts) if t >= 0])
        assert same(components_of(spark, prints, 2048)), thresholds


def test_allocation():
    costs = [{-1: 0.0, 0: 5.0, 1: 50.0}, {-1: 0.0, 0: 7.0, 1: 1.0}, {-1: 0.0, 0: 90.0, 1: 95.0}]
    assert S.allocate(costs) == (1.0, [-1, 1, -1]) or sum(S.allocate(costs)[1]) == 0
    cost, ts = S.allocate(costs)
    assert sum(ts) == S.DISTANCE - 2 and cost == min(costs[0][a] + costs[1][b] + costs[2][c] for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if a + b + c == 0)
    assert abs(S.within(np.full(10, 0.5), 10).sum() - 1) < 1e-9


def test_components_of_a_long_chain(spark):
    rnd = random.Random(6)
    nodes = list(range(500))
    rnd.shuffle(nodes)
    edges = list(zip(nodes[:-1], nodes[1:])) + [(1000, 1001), (1001, 1000), (7, 7)]
    got = {r.node: r.label for r in S.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[n] for n in nodes} == {0} and got[1001] == got[1000] == 1000


def words(rnd, n):
    return ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def alike(a, b):
    x, y = (set(S.shingles(t).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def test_near_copies_go(spark):
    rnd = random.Random(7)
    docs = [words(rnd, rnd.randint(80, 200)) for _ in range(120)]
    passage = words(rnd, 60)
    texts = [" ".join(d) for d in docs] + [" ".join(words(rnd, 60) + passage + words(rnd, 60)) for _ in range(20)]
    clean = len(texts)
    for d in docs[:60]:
        d = list(d)
        d[rnd.randrange(len(d))] = "changed"
        texts.append(" ".join(d))
    texts += texts[:10]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in S.keep_one(df).collect()}
    assert set(range(clean)) <= kept  # what only shares a passage stays
    assert len([i for i in kept if i >= clean]) <= 3 and not any(i >= clean + 60 for i in kept)


def near_pairs(texts):
    """All pairs of distinct five-word shingle sets alike to 0.8, by brute force."""
    sets = [set(S.shingles(t).tolist()) for t in texts]
    return [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8]


def variants(rnd, base, n, most, word=None):
    out = []
    for _ in range(n):
        d = list(base)
        for _ in range(rnd.randint(0, most)):
            d[rnd.randrange(len(d))] = word or rnd.choice("abcdefgh") * 6
        out.append(" ".join(d))
    return out


def groups_of(spark, pairs):
    return {r.node: r.label for r in S.components(spark.createDataFrame(pairs, "a long, b long")).collect()}


def test_near_links_are_verified_and_those_of_brute_force(spark):
    rnd = random.Random(8)
    texts = variants(rnd, words(rnd, 150), 120, 3) + variants(rnd, words(rnd, 150), 300, 6)  # a dense group, and a loose one
    texts += [" ".join(words(rnd, 150)) for _ in range(60)]
    texts = list(dict.fromkeys(texts))
    df = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    near = near_pairs(texts)  # of all pairs, not of those that a fingerprint finds
    assert len(near) > 1000
    want = groups_of(spark, near)
    for cap in (2048, 16):  # in one block, and in pairs of blocks
        got = S.near_copies(df, cap).collect()
        assert all(abs(alike(texts[r.a], texts[r.b]) - r.likeness) < 1e-9 and r.likeness >= 0.8 for r in got)
        label = groups_of(spark, [(r.a, r.b) for r in got])
        assert np.mean([label.get(i, -i) == label.get(j, -j) for i, j in near]) > 0.99
        assert all(want[a] == want[b] for a, b in label.items())


def test_every_pair_of_a_bucket_is_verified(spark, monkeypatch):
    rnd = random.Random(10)
    one, two = words(rnd, 100), words(rnd, 100)
    texts = [words(rnd, 100), one, [*one[:-1], "changed"], words(rnd, 100), two, [*two[:-1], "changed"], words(rnd, 100)]
    sets = [S.shingles(" ".join(t)).view(np.int64).tolist() for t in texts]
    monkeypatch.setattr(banding, "ROUNDS", ((0, 1, 0),))
    keys = spark.createDataFrame([(7, 0.0, i, len(s)) for i, s in enumerate(sets)], "key long, band float, node long, size int")  # one bucket, its centre unlike all
    for cap in (3, 100):
        got = banding.verified(keys, 7, spark.createDataFrame(list(enumerate(sets)), "node long, item array<long>"), S.JACCARD, 0.8, cap=cap)[0]
        assert {(r.a, r.b) for r in got.collect()} == {(1, 2), (4, 5)}


def test_prefixes_hold_every_alike_pair():
    rng = np.random.default_rng(3)
    for trial in range(30):
        base = [np.unique(rng.integers(0, 400, n)) for n in rng.integers(1, 120, 6)]
        sets = [np.unique(np.concatenate([rng.permutation(b)[: max(1, int(len(b) * rng.uniform(0.8, 1)))], rng.integers(0, 400, int(rng.integers(0, 9)))])) for b in base for _ in range(6)]
        group = rng.integers(0, 12, len(sets))
        found = {(x, int(y)) for x, ys in banding.share_prefix(sets, 0.8, group) for y in ys}
        want = {(x, y) for y in range(len(sets)) for x in range(y) if group[x] != group[y] and S._like(sets[x].view(np.uint64), sets[y].view(np.uint64)) >= 0.8}
        assert want <= found


def test_a_common_passage_makes_no_square():
    """Texts that share most of their words, but not enough: what is compared grows with their number."""
    rng, compared = np.random.default_rng(4), {}
    for n in (200, 400, 800):
        passage = rng.integers(0, 1 << 62, 210)
        sets = [np.unique(np.concatenate([passage, rng.integers(0, 1 << 62, 90)])) for _ in range(n)]
        sets += [np.append(s[:-3], rng.integers(1 << 62, 1 << 63, 3)) for s in sets[: n // 4]]
        compared[n] = sum(len(ys) for _, ys in banding.share_prefix(sets, 0.8, np.arange(len(sets))))
        assert compared[n] >= n // 4
    assert compared[800] <= 4.4 * compared[200]


def test_large_buckets_are_split_by_what_their_sets_do_not_share(spark):
    rng = np.random.default_rng(5)
    passage = rng.integers(0, 1 << 62, 210)
    sets = [np.unique(np.concatenate([passage, rng.integers(0, 1 << 62, 90)])) for _ in range(80)]
    sets += [np.unique(np.append(s[:-3], rng.integers(0, 1 << 62, 3))) for s in sets[:30]]
    keys = spark.createDataFrame([(7, 0.0, i, len(s)) for i, s in enumerate(sets)], "key long, band float, node long, size int")
    items = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sets)], "node long, item array<long>")
    dealt = banding._open(keys.withColumn("label", keys.node), 110, 16)
    assert dealt.first().blocks > 1
    smaller = banding._open(banding._split(dealt, items, 0.8), 110, 16, pairs=True)
    assert smaller.groupBy("key").count().agg({"count": "max"}).first()[0] == 2 and smaller.select("node").distinct().count() == 60
    got = banding.verified(keys, 110, items, S.JACCARD, 0.8, cap=16)[1]
    assert {(r.node, r.label) for r in got.collect()} == {(i, i % 80) for i in [*range(30), *range(80, 110)]}


def test_bands_meet_by_likeness():
    rng = np.random.default_rng(11)
    met = 0
    for _ in range(300):
        own = rng.integers(1, 1 << 63, 360, dtype=np.uint64)  # 320 shared of 400: alike to 0.8
        a, b = S.bands(np.unique(own)), S.bands(np.unique(np.concatenate([own[:320], rng.integers(1, 1 << 63, 40, dtype=np.uint64)])))
        met += bool((a == b).any())
    assert met >= 294 and not len(S.bands(np.zeros(0, np.uint64))) and len(S.bands(S.shingles("one word"))) == S.BANDS


def test_near_copies_of_odd_tables(spark, odd_docs, no_docs):
    named = odd_docs.selectExpr("monotonically_increasing_id() AS node", "text")
    assert {r.likeness for r in S.near_copies(named).collect()} == {1.0}  # the equal texts alone
    assert S.near_copies(no_docs.selectExpr("doc_id AS node", "text")).count() == 0
