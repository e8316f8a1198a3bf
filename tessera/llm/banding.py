"""Verified links of items that share a band, in bounded rows: by centres first, then by what splits a bucket, or block by block.

An item is a list of whole numbers; a Measure says how alike two are. Nodes are distinct numbers. Empty tables give no links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import counted, materialise
from tessera.llm.components import components

#: The share of the bands whose buckets are linked to a centre in each round, and how the centre is chosen (by a hash with that seed).
ROUNDS = ((0.0, 0.25, 0), (0.0, 1.0, 1))
#: Items that meet one copy of their centre; numbers of a block of items that are compared, about.
MEMBERS, BLOCK = 256, 1_000_000
LINKS = "a long, b long, likeness double"
Like = Callable[[np.ndarray, np.ndarray], float]


@dataclass(frozen=True)
class Measure:
    """How alike two items are, and which items of a list may be alike enough.

    pairs(items, least, group): (x, ys) with ys all greater than x; every pair alike to least whose groups differ is among them.
    by_prefix: items are sets alike by their Jaccard index, so that two alike ones share one of the rarest numbers of each; a bucket is split by those.
    """

    one: Like
    pairs: Callable[[list[np.ndarray], float, np.ndarray], Iterator[tuple[int, np.ndarray]]]
    by_prefix: bool = False


def prefix_length(n: int | np.ndarray, least: float):
    """How many of its n numbers, the rarest first, a set must look at to share one with every set alike to least by the Jaccard index."""
    return n - np.ceil(least * n - 1e-9).astype(int) + 1 if isinstance(n, np.ndarray) else n - int(np.ceil(least * n - 1e-9)) + 1


def share_prefix(items: list[np.ndarray], least: float, group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Pairs of sets, of different groups, that share a number of their prefixes in the order of rising frequency."""
    size = np.array([len(i) for i in items])
    owner = np.repeat(np.arange(len(items)), size)
    _, token, count = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    order = np.lexsort((rank[token], owner))
    place = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
    head = order[place < np.repeat(prefix_length(size, least), size)]
    head = head[count[token[head]] > 1]
    head = head[np.argsort(token[head], kind="stable")]
    runs = np.split(owner[head], np.flatnonzero(np.diff(token[head])) + 1) if len(head) else []
    found: set[int] = set()
    for run in runs:
        if len(run) > 1 and len(np.unique(group[run])) > 1:
            a, b = np.triu_indices(len(run), 1)
            a, b = run[a], run[b]
            apart = group[a] != group[b]
            found.update((np.minimum(a, b)[apart] * len(items) + np.maximum(a, b)[apart]).tolist())
    keys = np.array(sorted(found), np.int64)
    for part in np.split(keys, np.flatnonzero(np.diff(keys // len(items))) + 1) if len(keys) else []:
        yield int(part[0] // len(items)), part % len(items)


def lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The lists of a column, as views: no Python number is made of them."""
    at, flat = column.offsets.to_numpy(), column.values.to_numpy()
    for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
        yield flat[s:e]


def _told(out: list[tuple[int, int, float]]) -> pa.RecordBatch:
    cols = list(zip(*out)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "likeness"])


def _to_centre(measure: Measure, least: float):
    """Rows (centre, part, kind, node, item) in that order to links: kind 0 is the centre itself, those after it are compared with it alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            out = []
            for centre, kind, node, found in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), lists(batch.column(4))):
                if not kind:
                    own = found.copy()
                elif (near := measure.one(own, found)) >= least:
                    out.append((min(centre, node), max(centre, node), near))
            yield _told(out)

    return run


def _compare(rows: list[tuple], measure: Measure, least: float) -> list[tuple[int, int, float]]:
    """Pairs of rows (block, node, label, item) of different labels are compared unless links connect them already; a spanning forest of the links comes out.

    If there are two blocks, only pairs across them count, as each block has a row sequence of its own.
    """
    side, node, label, items = zip(*rows)
    two, across, group, out = len(set(side)) > 1, np.array(side), np.array(label), []
    for x, ys in measure.pairs(list(items), least, group.copy()):
        fit = group[x] != group[ys]
        if two:
            fit &= across[x] != across[ys]
        for y in ys[fit].tolist():
            if group[x] != group[y] and (near := measure.one(items[x], items[y])) >= least:
                group[group == group[y]] = group[x]
                out.append((min(node[x], node[y]), max(node[x], node[y]), near))
    return out


def _alike(measure: Measure, least: float):
    """Rows (key, lo, hi, block, node, label, item), in order of their first four columns, to the links of each (key, lo, hi)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            out = []
            for part, lo, hi, *row, found in zip(*(batch.column(k).to_pylist() for k in range(6)), lists(batch.column(6))):
                if (part, lo, hi) != key:
                    out += _compare(held, measure, least) if len(held) > 1 else []
                    key, held = (part, lo, hi), []
                held.append((*row, found.copy()))  # a copy, so that no batch is held
            yield _told(out)
        yield _told(_compare(held, measure, least) if len(held) > 1 else [])

    return run


def buckets(signed: DataFrame) -> tuple[DataFrame, int]:
    """signed(node, size, keys array<long>) to (key, band, node, size) of the keys that several items have, and their number; band is the share of an item's keys before it."""
    keys = signed.select("node", "size", (F.size("keys")).alias("of"), F.posexplode("keys").alias("band", "key"))
    several = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return counted(keys.join(several, "key").select("key", (F.col("band") / F.col("of")).cast("float").alias("band"), "node", "size"), "buckets")


def _labelled(keys: DataFrame, label: DataFrame) -> DataFrame:
    """keys with the label of each node; a node that label does not hold is its own."""
    return keys.join(label.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").drop("_node").withColumn("label", F.coalesce("label", "node"))


def _roughly(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node linked to each, and the one linked to that. Finer than components, which costs a round some comparisons, and no result."""
    up = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))
    return up.join(up.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left").select("node", F.coalesce("next", "label").alias("label"))


def _centred(keys: DataFrame, n: int, items: DataFrame, seed: int, measure: Measure, least: float, fit) -> DataFrame:
    """Links of each bucket's items to the bucket's centre, one item of it, where their labels differ."""
    order = F.col("node") if not seed else F.xxhash64("node", F.lit(seed))
    centres = keys.groupBy("key").agg(F.min_by(F.struct("node", "size", "label"), order).alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key", "c")
    pairs = keys.join(centres, "key").where((F.col("label") != F.col("c.label")) & fit(F.col("size"), F.col("c.size"))).select(F.col("c.node").alias("centre"), "node").distinct()
    pairs = materialise(pairs, "pairs", rows=n)
    parts = pairs.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"))
    members = pairs.join(parts, "centre").select("centre", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"), "node")
    own = parts.select("centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), F.col("centre").alias("node"))
    rows = members.unionByName(own).join(items, "node").select("centre", "part", "kind", "node", "item")
    return rows.repartition("centre", "part").sortWithinPartitions("centre", "part", "kind", "node").mapInArrow(_to_centre(measure, least), LINKS)


def _open(keys: DataFrame, n: int, cap: int, pairs: bool = False) -> DataFrame:
    """Rows of buckets whose items have several labels, with a block each of about cap items or BLOCK numbers. A bucket of two has been compared whole by its centre, unless pairs."""
    size = F.greatest(F.ceil(F.count(F.lit(1)) / cap), F.ceil(F.sum("size") / BLOCK)).cast("int")
    open_ = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("who"), size.alias("blocks"), F.min("label").alias("lo"), F.max("label").alias("hi")).where(f"lo <> hi and n > {1 if pairs else 2}")
    open_ = open_.groupBy("who", "n").agg(F.min_by(F.struct("key", "blocks"), "key").alias("x")).select("x.*")  # buckets of the same items count once
    return materialise(keys.join(open_, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "open", rows=n)


def _split(dealt: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """Buckets of several blocks to smaller ones (key, node, size, label): one for each number that prefixes of their sets share.

    A number's frequency is that in the bucket, so what all its sets have in common, such as a template, is in no prefix.
    """
    sets = dealt.select("key", "node", "label", "size").join(items, "node")
    each = sets.select("key", "node", F.explode("item").alias("x"))
    often = each.groupBy("key", "x").agg(F.count(F.lit(1)).alias("often"))
    head = F.slice(F.array_sort(F.collect_list(F.struct("often", "x"))), 1, (F.count(F.lit(1)) - F.ceil(F.count(F.lit(1)) * F.lit(least) - 1e-9) + 1).cast("int"))
    heads = each.join(often, ["key", "x"]).groupBy("key", "node").agg(head.alias("head"))  # one set each
    several = heads.select("key", "node", F.explode(F.filter("head", lambda h: h.often > 1)).alias("h")).select("key", "node", F.xxhash64("key", "h.x").alias("sub"))
    return several.join(dealt.select("key", "node", "label", "size"), ["key", "node"]).select(F.col("sub").alias("key"), "node", "size", "label")


def _blocked(dealt: DataFrame, items: DataFrame, measure: Measure, least: float) -> DataFrame:
    """Links between all items of different labels of a bucket, by pairs of blocks."""
    # A block of items goes to the rows of its pairs with all blocks, itself too.
    rows = dealt.select("key", "block", "node", "label", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "label").join(items, "node").select("key", "lo", "hi", "block", "node", "label", "item")
    return rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "block", "node").mapInArrow(_alike(measure, least), LINKS)


def verified(keys: DataFrame, n: int, items: DataFrame, measure: Measure, least: float, cap: int = 2048, fit: Callable[[Column, Column], Column] = lambda a, b: F.lit(True)) -> tuple[DataFrame, DataFrame]:
    """keys of buckets() and their number, items(node, item array) to links (a, b, likeness) that connect just what those of all pairs that share a bucket would, and their components (node, label).

    In each round a bucket's items are compared with its centre alone, one item of the bucket, unless links connect them
    already; what a round costs is in proportion to the bucket rows. Items of a bucket that the rounds leave unconnected
    are then compared with each other, so no pair that shares a bucket is lost. A bucket of more than cap items, or about BLOCK numbers, is
    first split by the prefixes of its sets if the measure allows that; what is larger still is compared block by block.
    fit: whether items of these sizes can be alike enough.
    """
    found = None
    for lo, hi, seed in ROUNDS:
        some = keys.where((F.col("band") >= lo) & (F.col("band") < hi))
        some = some.withColumn("label", F.col("node")) if found is None else _labelled(some, _roughly(found))
        new = materialise(_centred(some, n, items, seed, measure, least, fit), "links", rows=n)
        found = new if found is None else found.unionByName(new)
    label = components(found)
    dealt = _open(_labelled(keys, label), n, cap)
    if dealt.isEmpty():
        return found, label
    if measure.by_prefix:
        large = dealt.where("blocks > 1")
        if not large.isEmpty():
            smaller = _open(materialise(_split(large, items, least), "split"), n, cap, pairs=True)
            found = found.unionByName(materialise(_blocked(smaller, items, measure, least), "links"))
        dealt = dealt.where("blocks = 1")
    found = found.unionByName(materialise(_blocked(dealt, items, measure, least), "links"))
    return found, components(found)
