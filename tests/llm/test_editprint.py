import hashlib
import random

import numpy as np

from tessera.llm import editprint as E
from tessera.llm.components import components


def one_walk(text):
    """The walk by its definition."""
    pos, out = 0, []
    for c in text:
        out.append(pos)
        cls = ((ord(c) * 2654435761) % (1 << 32)) >> 25
        pos += int(E.STEP[((pos & (E.PERIOD - 1)) << 7) | cls])
    return out, pos


def test_walk_together_is_walk_alone():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abc é漢") for _ in range(rnd.choice([0, 1, 5, 300]))) for _ in range(200)]
    chars = [E.code_points(t) for t in texts]
    n = np.array([len(c) for c in chars], np.int64)
    pos, end = E.walk(np.concatenate(chars), n, np.zeros(len(n), np.int64))
    at = 0
    for t, e, k in zip(texts, end, n):
        p, z = one_walk(t)
        assert pos[at : at + k].tolist() == p and e == z
        at += k


def test_contract(spark, odd_docs, no_docs):
    got = E.fingerprints(odd_docs).collect()
    assert len(got) == 13
    rows = sorted(((r.doc_id, r.text or "") for r in odd_docs.collect()), key=lambda r: (r[0] is None, -(r[0] or 0)))
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, []).append(t)
    fp = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.n_chars in [len(t) for t in by_id[r.doc_id]]
    for r in got:
        if len(by_id[r.doc_id]) == 1:
            assert fp.setdefault(by_id[r.doc_id][0], r.fingerprint) == r.fingerprint
    four = next(r for r in got if r.doc_id == 4)
    t, nxt = by_id[4][0], by_id[3][0]
    assert four.edited_sha256 == hashlib.sha256((t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]).encode()).hexdigest()
    assert E.fingerprints(no_docs).count() == 0


def test_next_across_buckets(spark):
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(0, 90)))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for r in E.fingerprints(df).collect():
        t, nxt = rows[r.doc_id][1], rows[r.doc_id - 1][1]
        k = len(t) // 3
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - k] + nxt[:k]).encode()).hexdigest()


def edited(text, rnd, share):
    out = []
    for c in text:
        x = rnd.random()
        out.append("" if x < share / 3 else c + "q" if x < 2 * share / 3 else "z" if x < share else c)
    return "".join(out)


def test_likeness_follows_edits(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcdefghijklmnop ") for _ in range(2000)) for _ in range(30)]
    like = lambda a, b: E.likeness(*(x[4] for x in E.block([a, b], ["", ""])))
    assert np.mean([like(t, edited(t, rnd, 0.002)) for t in texts]) > 0.5
    assert np.mean([like(a, b) for a, b in zip(texts, texts[1:])]) < 0.1
    assert like(texts[0], texts[0]) == 1 and like("", "") == 1 and like("", "a") == 0


def one_print(text):
    """Digits of a text by the definition: the character that stands at each sampled position of its walk."""
    pos, end = one_walk(text)
    out = []
    for k, at in enumerate(E.SAMPLES.tolist()):
        if at >= end:
            break
        c = ord(text[max(i for i, p in enumerate(pos) if p <= at)])
        out.append(((((c + 1) * int(E.SALT[k])) ^ (int(E.SALT[k]) >> 7)) * 40503 >> 13) & 15)
    return end, out


def one_likeness(a, b):
    if not a and not b:
        return 1.0
    weight = [E.SAMPLES[k + 1] - E.SAMPLES[k] if k + 1 < len(E.SAMPLES) else E.SAMPLES[k] * 0.066 for k in range(max(len(a), len(b)))]
    share = sum(w for w, x, y in zip(weight, a, b) if x == y) / sum(weight)
    return share if share == 1 else max(0.0, (share - 1 / 16) * 16 / 15)


def test_query_is_that_of_brute_force(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("abcdefgh é漢") for _ in range(rnd.choice([0, 1, 2, 40, 700]))) for _ in range(60)]
    texts[21] = "".join(rnd.choice("abcdefgh ") for _ in range(700))
    texts[20], texts[31] = texts[21][:-9] + "x", texts[21]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    prints = [one_print(t) for t in texts]
    got = {r.doc_id: r for r in E.near(df).collect()}
    assert len(got) == 60
    for i, t in enumerate(texts):
        nxt = texts[i - 1]  # descending ids; after the last, the greatest
        k = len(t) // 3
        end, edited = one_print(t[: len(t) - k] + nxt[:k])
        name = lambda end, d: f"{end:x}:" + "".join(f"{x:x}" for x in d)
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (name(*prints[i]), name(end, edited))
        assert abs(got[i].near_edited - one_likeness(prints[i][1], edited)) < 1e-9 and abs(got[i].near_next - one_likeness(prints[i][1], prints[i - 1][1])) < 1e-9
    root = list(range(60))
    for i in range(60):
        for j in range(i):
            if (prints[i][1] and prints[j][1] and one_likeness(prints[i][1], prints[j][1]) >= 0.8) or prints[i] == prints[j]:
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    same = [got[i].class_id == root[i] for i in range(60)]
    assert np.mean(same) > 0.95 and got[31].class_id == got[21].class_id == got[20].class_id == 20


def classes(spark, df):
    return {r.doc_id: r.class_id for r in E.near(df).collect()}


def test_classes(spark, odd_docs, no_docs):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abcdefghijklmnop ") for _ in range(1500)) for _ in range(40)]
    texts += [t[:-100] + "x" * 100 for t in texts[:20]] + texts[:5]
    got = classes(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert got == {i: i if i < 40 else i - 40 if i < 60 else i - 60 for i in range(65)}
    odd = E.near(odd_docs).collect()
    assert len(odd) == 13 and {r.class_id for r in odd if r.doc_id in (1, 6)} == {1} and {r.class_id for r in odd if not r.n_chars} == {2}
    assert E.near(no_docs).count() == 0


def test_links_cover_brute_force_wherever_the_edit_is(spark):
    rnd = random.Random(5)
    some = lambda n: "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n))
    texts = []
    for n in [1500] * 8 + [6000] * 6 + [60_000] * 3:
        t, k = some(n), n // 20
        texts += [t, some(k) + t[k:], t[: n // 2] + some(k) + t[n // 2 + k :], t[:-k] + some(k)]
    names = [E.text_of(0, x[4]) for x in E.block(texts, [""] * len(texts))]
    prints = [E.digits_of(x) for x in names]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if E.likeness(prints[i], prints[j]) >= 0.8}
    assert len([1 for i, j in want if i % 4 == 0 and j == i + 1]) > 5  # another opening
    links = E.near_classes(spark.createDataFrame(list(enumerate(names)), "node long, fingerprint string"))[0].collect()
    assert {(r.a, r.b) for r in links} <= want
    label = {r.node: r.label for r in components(spark.createDataFrame([(r.a, r.b) for r in links], "a long, b long")).collect()}
    assert np.mean([label.get(i, -i) == label.get(j, -j) for i, j in want]) >= 0.95


def test_groups_of_copies_that_are_unlike_each_others_centre(spark):
    """Texts of a group are changed in two stretches each, so that many pairs are alike and many are not."""
    rnd = random.Random(6)
    some = lambda n: "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n))
    texts = []
    for _ in range(8):
        base = some(3000)
        for _ in range(40):
            t = base
            for k in (rnd.randrange(60, 280), rnd.randrange(60, 280)):
                at = rnd.randrange(0, len(t) - k)
                t = t[:at] + some(k) + t[at + k :]
            texts.append(t)
    names = [E.text_of(0, x[4]) for at in range(0, len(texts), 64) for x in E.block(texts[at : at + 64], [""] * len(texts[at : at + 64]))]
    prints = [E.digits_of(x) for x in names]
    want = [(i, j) for g in range(0, 320, 40) for j in range(g, g + 40) for i in range(g, j) if E.likeness(prints[i], prints[j]) >= 0.8]
    assert len(want) > 300
    label = {r.node: r.label for r in E.near_classes(spark.createDataFrame(list(enumerate(names)), "node long, fingerprint string"))[1].collect()}
    assert np.mean([label.get(i, -i) == label.get(j, -j) for i, j in want]) >= 0.97


def test_may_be_alike_holds_every_alike_pair():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 16, 120)
    items = [np.where(rng.random(n) < p, rng.integers(0, 16, n), base[:n]).astype(np.int8) for n in (0, 0, 1, 60, 100, 118, 120) for p in (0.0, 0.1, 0.3)]
    found = {(x, int(y)) for x, ys in E.may_be_alike(items, 0.8, np.arange(len(items))) for y in ys}
    assert found == {(x, y) for y in range(len(items)) for x in range(y) if E.likeness(items[x], items[y]) >= 0.8}
