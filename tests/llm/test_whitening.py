"""Operator 12 against exact fractions, and its merge formula against one pass."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm import whitening as H

SCHEMA = "vec_id long, embedding array<double>, label int, n long, component string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "x") for i, v in enumerate(vectors)], SCHEMA)


def exact(vectors):
    """(x rows, S, covariance with divisor n) in integers and fractions."""
    x = [[math.floor(64 * float(c)) + 1000000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    cov = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3) for j in range(d)] for i in range(d)]
    return x, s, cov


def test_against_fractions(spark):
    rng = np.random.default_rng(3)
    good = (rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6)) * 3 + 50).tolist()
    good += [good[0]] * 200  # a vector of a third of all rows
    odd = [None, [], [1.0] * 5 + [None], [1.0] * 5 + [math.nan], [math.inf] + [1.0] * 5, [1.0, 2.0]]
    table = frame(spark, good + odd).repartition(7)
    x, s, cov = exact(good)
    n, values = len(good), np.linalg.eigvalsh(np.array(cov, dtype=float))[::-1]
    got = H.whiten(table).collect()
    assert len(got) == n * 6 and {r.n for r in got} == {n} and {r.vec_id for r in got} == set(range(n))
    by = {(r.vec_id, r.component): r for r in got}
    assert max(r.identity_error for r in got) < 1e-9 and len({r.identity_error for r in got}) == 1
    white = np.array([[by[i, k].whitened for k in range(1, 7)] for i in range(n)])
    assert np.abs(white.T @ white / n - np.eye(6)).max() < 1e-9
    for i in range(n):
        assert by[i, 1].deviation == sum((n * a - b) ** 2 for a, b in zip(x[i], s))
    centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(r, s)] for r in x])
    vectors = centred.T @ white / n / np.sqrt(values)  # V v sqrt(e) / e = v sqrt(e)
    assert np.allclose(np.array(cov, dtype=float) @ vectors, vectors * values, rtol=1e-9, atol=1e-9 * values[0]) and np.allclose((vectors**2).sum(axis=0), 1)
    assert np.allclose([by[0, k].explained for k in range(1, 7)], values / float(sum(cov[i][i] for i in range(6))), rtol=1e-9)


def test_merge_equals_one_pass():
    rng = np.random.default_rng(1)
    rows = rng.integers(-50, 50, (1000, 5)) + 10**6
    whole, seen = H.moments(rows), None
    for part in np.split(rows, [1, 7, 300, 999]):
        seen = H.moments(part) if seen is None else H.merge(H.moments(part), seen)
    none = H.Moments(0, np.array([0] * 5, dtype=object), np.zeros(5), np.zeros((5, 5)))
    assert H.merge(none, seen) is seen and H.merge(seen, none) is seen
    assert seen.n == 1000 and list(seen.total) == rows.sum(axis=0).tolist() == list(whole.total)
    assert np.allclose(seen.mean, rows.mean(axis=0), rtol=1e-15) and np.allclose(seen.scatter, np.cov(rows.T, bias=True) * 1000, rtol=1e-9, atol=1e-3)


def test_components(spark):
    rng = np.random.default_rng(2)
    wide = rng.normal(size=(300, 40))
    got = H.whiten(frame(spark, wide.tolist()), components=32)
    assert got.count() == 300 * 32 and got.agg({"component": "max"}).first()[0] == 32
    flat = np.hstack([wide[:, :2] * 9, wide[:, :1] * 9])  # a repeated column: two components remain
    rows = H.whiten(frame(spark, flat.tolist())).collect()
    assert len(rows) == 600 and max(r.identity_error for r in rows) < 1e-6 and abs(sum(r.explained for r in rows) / 300 - 1) < 1e-9


@pytest.mark.parametrize("vectors", [[], [None, [math.nan]], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_nothing_to_whiten(spark, vectors):
    got = H.whiten(frame(spark, vectors))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.count() == 0


def test_very_large_entries(spark):
    rows = H.whiten(frame(spark, [[1e300, 0.0], [-1e300, 1.0], [3.0, 2.0]])).collect()
    assert len(rows) == 3 and all(r.deviation is None or r.deviation >= 0 for r in rows)
    by = H.Whitener(3, (30, 0), np.array([10.0, 0.0]), np.eye(2), np.ones(2))
    assert by.deviations(np.array([[10, 0], [11, 0], [1 << 40, 0]])) == [0, 9, None]
