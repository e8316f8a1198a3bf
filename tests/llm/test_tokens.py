import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import huffman as H
from tessera.llm import packing as P
from tessera.llm import tokens as K

PATH = K.default_path()
CODER = K.Coder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab 's've'll're \n\t  ²½é_1٣漢á\x1c\x85\xa0.,İß\r\x00😀"), max_size=30), max_size=6))
def test_ids_are_the_library_s(texts):
    assert CODER.encode(texts) == CODER.whole(texts)


def test_long_pieces_and_small_tables(monkeypatch):
    texts = ["x" * 900 + " y", "<|endoftext|>", "", "a" * 70_000] + [" ".join(str(random.Random(i).random()) for _ in range(50)) for i in range(60)]
    monkeypatch.setattr(K, "BLOCK", 5_000)
    monkeypatch.setattr(K, "MOST", 5_001)
    assert K.Coder(PATH).encode(texts) == CODER.whole(texts)


def ids_of(text, end):
    return np.append(np.frombuffer(CODER.whole([text or ""])[0], "<u2"), end).astype("<u4")


def test_packing_contract(spark, odd_docs, no_docs):
    got = P.pack(odd_docs).collect()
    seqs, pieces = {}, {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 2048
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault((r.doc_id, len(ids_of(r.text, 1))), []).append(ids_of(r.text, 1))
    assert set(texts) == set(pieces)
    for key, rows in pieces.items():
        assert sum(r.length for r in rows) == key[1] * len(texts[key])
        ok = {(r.start, r.length): {zlib.crc32(t[r.start : r.start + r.length].tobytes()) for t in texts[key]} for r in rows}
        assert all(r.ids_crc32 in ok[r.start, r.length] for r in rows)
    assert P.pack(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 2047), st.integers(1, 400), max_size=30))
def test_plan(hist):
    rows, tiers = P.plan(hist)
    n = sum(m for _, m in tiers)
    seqs, held = {}, {}
    for k, lo, hi, _, _, start, size, q, base, copies, at in rows:
        for r in range(lo, hi):
            seqs.setdefault(base + (r + q) // copies, []).append((at + (r + q) % copies * size, size))
            held.setdefault((k, r), []).append((start, size))
    assert set(held) == {(k, r) for k, m in hist.items() for r in range(m)} and sorted(seqs) == list(range(n))
    for (k, _), parts in held.items():
        at = 0
        for start, size in sorted(parts):
            assert start == at
            at += size
        assert at == k
    wasted = 0
    order = [size for size, m in tiers for _ in range(m)]
    assert order == sorted(order, reverse=True) and order == [P.context(sum(size for _, size in seqs[k])) for k in range(n)]
    for s in seqs.values():
        at = 0
        for offset, size in sorted(s):
            assert offset == at
            at += size
        assert at <= 2048
        wasted += 0 if at & (at - 1) == 0 else 2048 - at
    total = sum(k * m for k, m in hist.items())
    assert wasted <= 0.01 * total + 2048


def test_tiers_are_filled_by_shorter_ones():
    # 1500 + 548 fill the long window, 700 + 324 the next tier, 300 + 212 the one below; 100 is left for a long window.
    groups = P.by_tier({1500: 2, 548: 2, 700: 3, 324: 3, 300: 1, 212: 1, 100: 1})
    got = {(P.context(P.total_of(c)), tuple(sorted(length for length, _ in c))): n for n, c in groups}
    assert got == {(2048, (548, 1500)): 2, (1024, (324, 700)): 3, (512, (212, 300)): 1, (2048, (100,)): 1}


def test_steps_hold_one_tier_and_equal_tokens(spark):
    rnd = random.Random(3)
    docs = spark.createDataFrame([(i, "word " * rnd.choice([1, 30, 63, 200, 900, 3000])) for i in range(600)], "doc_id long, text string")
    got = P.pack(docs, step=4096).toPandas()
    steps = got.drop_duplicates("sequence_id").groupby("step_group").agg(tier=("tier", "nunique"), size=("tier", "first"), n=("tier", "size"))
    assert (steps.tier == 1).all() and (steps.n * steps["size"] <= 4096).all()
    assert all((g.n * g["size"] < 4096).sum() <= 1 for _, g in steps.groupby("size"))  # the last one of a tier alone may be smaller
    lengths = got.groupby("sequence_id").agg(n=("length", "sum"), tier=("tier", "first"))
    assert all(P.context(n) == t for n, t in zip(lengths.n, lengths.tier)) and sorted(got.step_group.unique()) == list(range(len(steps)))


def best_cost(w, limit):
    """Package-merge by lists of symbols."""
    leaves = sorted((x, (i,)) for i, x in enumerate(w))
    level = leaves
    for _ in range(limit - 1):
        pairs = [(a[0] + b[0], a[1] + b[1]) for a, b in zip(level[::2], level[1::2])]
        level = sorted(leaves + pairs, key=lambda x: x[0])
    n = [0] * len(w)
    for _, ids in level[: 2 * len(w) - 2]:
        for i in ids:
            n[i] += 1
    return sum(a * b for a, b in zip(n, w))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10_000), min_size=2, max_size=30), st.integers(5, 16))
def test_lengths_are_optimal_and_limited(w, limit):
    n = H.lengths(np.array(w), limit).astype(int)
    assert n.max() <= limit and abs(sum(2.0**-n) - 1) < 1e-9
    assert sum(n * np.array(w)) == best_cost(w, limit)


def test_round_trip_from_any_checkpoint():
    rng = np.random.default_rng(1)
    docs = [rng.zipf(1.3, n).clip(0, 50_000).astype(np.uint16) for n in (0, 1, 255, 256, 257, 5000)]
    length = H.lengths(np.bincount(np.concatenate(docs), minlength=65536))
    sym, size = H.table(length)
    for d, (bits, marks) in zip(docs, H.encode(docs, length, H.codes(length))):
        marks = np.frombuffer(marks, "<i8")
        n = np.minimum(H.EVERY, len(d) - H.EVERY * np.arange(len(marks)))
        assert H.decode(bits, marks.copy(), n, sym, size).tolist() == d.tolist()
        for k in range(len(marks)):
            assert H.decode(bits, marks[k : k + 1].copy(), n[k : k + 1], sym, size).tolist() == d[k * H.EVERY : (k + 1) * H.EVERY].tolist()


def test_files(spark, odd_docs, no_docs, tmp_path):
    H.write(odd_docs, f"file://{tmp_path}/x")
    got = sorted(H.read(spark, f"file://{tmp_path}/x").collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in odd_docs.collect()), key=lambda i: (i is not None, i or 0))
    want = sorted(zlib.crc32(ids_of(r.text, 0).tobytes()) for r in odd_docs.collect())
    assert sorted(r.ids_crc32 for r in got) == want
    H.write(no_docs, f"file://{tmp_path}/y")
    assert H.read(spark, f"file://{tmp_path}/y").count() == 0


def test_too_many_symbols():
    with pytest.raises(ValueError):
        H.lengths(np.ones(40), 5)
