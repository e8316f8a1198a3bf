"""The bucketed table: what a write touches, and that it holds what the plain one holds."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.sources.tables import BucketedTable, KeyedTable

SCHEMA = "k string, v int"


def rows(spark, *x):
    return spark.createDataFrame(list(x), SCHEMA)


def test_a_write_replaces_the_buckets_it_touches(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "t"), "k", SCHEMA, buckets=16)
    assert t.read().count() == 0 and t.versions() == []
    t.put_new(rows(spark, *[(f"k{i}", i) for i in range(200)]))
    before = t.manifest()
    assert len(before) == 16 and t.read().count() == 200
    t.upsert(rows(spark, ("k7", 70), ("k7", 71), ("new", 1)), order="v")
    after = t.manifest()
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2 and {r.k: r.v for r in t.read().collect()} == {f"k{i}": i for i in range(200)} | {"k7": 71, "new": 1}
    # Nothing new: no version.
    t.put_new(rows(spark, ("k7", 9), ("new", 9)))
    t.upsert(rows(spark, ("x", 1)).limit(0))
    assert t.manifest() == after and len(t.versions()) == 2


def test_a_lost_driver_leaves_the_version_before(spark, tmp_path, monkeypatch):
    t = BucketedTable(spark, str(tmp_path / "t"), "k", SCHEMA, buckets=4)
    t.upsert(rows(spark, ("a", 1)))
    (tmp_path / "t" / "_m=2").write_text('{"0": ')  # a manifest that was not finished
    (tmp_path / "t" / "w=2").mkdir()
    assert [tuple(r) for r in t.read().collect()] == [("a", 1)]
    t.upsert(rows(spark, ("a", 2)))
    assert [tuple(r) for r in t.read().collect()] == [("a", 2)] and t.versions() == [1, 2]


@pytest.mark.parametrize("keep", [1, 3])
def test_old_folders_go(spark, tmp_path, keep):
    t = BucketedTable(spark, str(tmp_path / "t"), "k", SCHEMA, keep=keep, buckets=4)
    for i in range(5):
        t.upsert(rows(spark, (f"k{i % 2}", i)))
    assert len(t.versions()) == keep and {r.k: r.v for r in t.read().collect()} == {"k0": 4, "k1": 3}
    held = {f.split("/")[0] for v in t.versions() for f in t.manifest(v).values()}
    assert {p.name for p in Path(tmp_path / "t").iterdir() if p.name.startswith("w=")} == held


def test_like_the_plain_table(spark, tmp_path):
    rnd = random.Random(2)
    plain, other = KeyedTable(spark, str(tmp_path / "p"), "k", SCHEMA), BucketedTable(spark, str(tmp_path / "b"), "k", SCHEMA, buckets=5)
    for _ in range(4):
        batch = rows(spark, *[(rnd.choice([None, "a", "b", "c", "d", "e", "f", "g"]), rnd.randrange(100)) for _ in range(3)])
        batch = batch.groupBy("k").agg(F.max("v").alias("v"))
        for t in (plain, other):
            t.put_new(batch.where("k is not null"))
            t.upsert(batch.where("v % 2 = 0 and k is not null"))
    assert sorted(map(tuple, plain.read().collect())) == sorted(map(tuple, other.read().collect()))
    other.overwrite(rows(spark, ("z", 1)))
    assert [tuple(r) for r in other.read().collect()] == [("z", 1)]
