"""Operator 4: SimHash near-duplicates by the generalised pigeonhole principle.

Distinct fingerprints are probed in parts: groups of correlated bits, each with
its own threshold. If the thresholds of m parts add up to DISTANCE - m + 1,
any two fingerprints within DISTANCE are within the threshold in at least one
part (a threshold of -1 leaves a part out). The grouping uses the
correlations of all fingerprints' bits, and a dynamic programme allocates the thresholds
at least estimated cost: keys emitted, and candidate pairs, which are estimated from
the measured collisions of each part and the bits' frequencies.

Candidates of a bucket are verified by their full Hamming distance, in one row
of the bucket; a spanning star of each linked set is all that leaves it. A
bucket of over CAP fingerprints is not gathered: its members emit themselves
and their 64 one-bit neighbours as keys instead. Two fingerprints within 2 bits share
such a key, and two that share one are within 2 bits, so this is exact too, and such
a key has 65 members at most.

Nulls and empties: a text that is null or has no words has fingerprint zero
and is linked like any other. Equal fingerprints are one class. A null doc_id
takes part but is no component_id unless its component has no other. Repeated
rows give repeated rows. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.banding import Measure, buckets, lists, share_prefix, verified
from tessera.llm.common import counted, materialise, slices, whole
from tessera.llm.components import components

DISTANCE = 2
SHINGLE = 3
SEED = 42
CAP = 2048
#: What a key costs, which is shuffled twice, in candidate pairs, which are an exclusive or inside an array.
KEY_COST = 64
SALTS = 16
#: For near copies: words of a shingle, bands of each text and minima of a band. A pair alike to 0.8 shares a band with a chance of 0.998.
NEAR_SHINGLE, BANDS, WIDTH = 5, 16, 5
_draw = np.random.default_rng(SEED)
_MINIMA = _draw.integers(1, 1 << 63, (BANDS * WIDTH, 1), dtype=np.uint64) | np.uint64(1)
_MIX = _draw.integers(1, 1 << 63, (BANDS, WIDTH), dtype=np.uint64) | np.uint64(1)


def hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased (A-Z) words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: splits at \x20 and \x09-\x0D, lowers A-Z alone
    if not words:
        return np.zeros(0, np.uint64)
    one, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(one, SEED)], np.uint64)
    n = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(n + 1) - 1
    start = end - n
    return np.array([digest(one[a:b], SEED) for a, b in zip(start.tolist(), end[shingle - 1 :].tolist())], np.uint64)


def fingerprint(h: np.ndarray) -> int:
    """Bit k is 1 if it is set in over half of h."""
    if not len(h):
        return 0
    total = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        total += np.unpackbits(h[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(h), bitorder="little").tobytes(), "little")


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for full in batches for part in slices(full, 1)):
        fp = np.array([fingerprint(hashes(t or "")) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((64, 64))
    for batch in batches:
        b = _bits(np.asarray(batch.column(0), np.int64).astype("<i8")).astype(np.float32)
        total += b.T @ b
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel()[at].astype(np.int64), pa.int64())], names=["at", "n"])


def group_bits(gram: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in parts of about equal size, correlated ones together."""
    p = np.diag(gram) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((gram / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    left, out = set(range(64)), []
    for k in range(parts):
        size = -(-len(left) // (parts - k))
        seed = max(left, key=lambda b: (corr[b, sorted(left)].sum(), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < size:
            nxt = max(left, key=lambda b: (corr[b, group].mean(), -b))
            group.append(nxt)
            left.remove(nxt)
        out.append(sorted(group))
    return out


def within(p: np.ndarray, most: int) -> np.ndarray:
    """Chances that two independent draws of bits with frequencies p differ in 0, ..., most bits."""
    out = np.zeros(most + 1)
    out[0] = 1
    for q in 2 * p * (1 - p):
        out[1:] = out[1:] * (1 - q) + out[:-1] * q
        out[0] *= 1 - q
    return out


def allocate(costs: list[dict[int, float]], distance: int = DISTANCE) -> tuple[float, list[int]]:
    """Thresholds of the parts, adding up to distance - parts + 1, of least total cost; costs[k][t]: that of part k at threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for (s, (c, ts)), (t, x) in product(best.items(), part.items()):
            if s + t not in new or c + x < new[s + t][0]:
                new[s + t] = (c + x, [*ts, t])
        best = new
    return best[distance - len(costs) + 1]


def plan(reps: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Parts and thresholds for these distinct fingerprints."""
    gram = np.zeros(64 * 64)
    for r in reps.select("fp").mapInArrow(_gram, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # 4096 rows at most
        gram[r["at"]] = r["n"]
    n, gram = reps.count(), gram.reshape(64, 64)
    choices = [group_bits(gram, n, m) for m in range(max(1, -(-(distance + 1) // 3)), distance + 2)]  # each threshold is 2 at most
    flat = [(m, k, bits) for m, parts in enumerate(choices) for k, bits in enumerate(parts) if len(parts) > 1]
    keyed = reps.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(mask(bits))).alias("key")) for i, (_, _, bits) in enumerate(flat)])).alias("x")).select("x.*")
    pairs = {r["i"]: r["n"] for r in keyed.groupBy("i", "key").count().groupBy("i").agg(F.sum((F.col("count") * (F.col("count") - 1) / 2).cast("double")).alias("n")).collect()}  # a row a part
    p, best = np.diag(gram) / max(n, 1), None
    for m, parts in enumerate(choices):
        costs = []
        for k, bits in enumerate(parts):
            d = within(p[bits], 2)
            same = next((pairs.get(i, 0.0) for i, (a, b, _) in enumerate(flat) if (a, b) == (m, k)), 0.0)
            cost = {-1: 0.0, 0: KEY_COST * n + same}
            cost[1] = KEY_COST * (2 + len(bits)) * n + same * (d[0] + d[1]) / d[0]
            # At threshold 2 both sides emit their one-bit neighbours; if all bits are one part, no false candidate remains, see stars().
            cost[2] = KEY_COST * (1 + len(bits)) * n + (0 if len(bits) == 64 else same * d.sum() / d[0])
            costs.append(cost)
        got = allocate(costs, distance)
        if best is None or got[0] < best[0]:
            best = (got[0], parts, got[1])
    return [(bits, t) for bits, t in zip(best[1], best[2]) if t >= 0]


def mask(bits: list[int]) -> int:
    return int(np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)[0])


def flips(bits: list[int]) -> list[int]:
    return [mask([b]) for b in bits]


def stars(fps: DataFrame) -> DataFrame:
    """Edges that connect fingerprints within 2 bits: by shared one-bit neighbours, at most 65 members a key."""
    around = F.transform(F.array(F.lit(0).cast("long"), *[F.lit(x).cast("long") for x in flips(list(range(64)))]), lambda x: x.bitwiseXOR(F.col("fp")))
    keys = fps.select("fp", F.explode(around).alias("key"))
    groups = keys.groupBy("key").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    return groups.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a <> b").distinct()


def _verify(distance: int):
    """Rows of (base fingerprints, probing ones) to links within distance: a star of each linked set of a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((0, 2), np.uint64)]
            for base, probe in zip(lists(batch.column(0)), lists(batch.column(1))):
                found.append(_row_links(base.view(np.uint64), probe.view(np.uint64), distance))
            a = np.unique(np.concatenate(found), axis=0).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0], pa.int64()), pa.array(a[:, 1], pa.int64())], names=["a", "b"])

    return run


def _row_links(base: np.ndarray, probe: np.ndarray, distance: int) -> np.ndarray:
    """Links of one row, larger fingerprint first. The work is on arrays of at most 256 by the row's length."""
    q, b = np.unique(np.concatenate([base, probe])), np.unique(base)
    own = np.searchsorted(q, b)
    gap = np.empty((len(q), len(b)), np.uint8)
    for at in range(0, len(q), 256):
        np.bitwise_count(q[at : at + 256, None] ^ b[None], out=gap[at : at + 256])
    gap[own, np.arange(len(b))] = 255
    near = gap <= distance
    if not near.any():
        return np.zeros((0, 2), np.uint64)
    # Labels: the smallest index that each reaches, passed on along links and then from label to label.
    label = np.arange(len(q))
    while True:
        new = label.copy()
        for at in range(0, len(q), 256):
            part = near[at : at + 256]
            new[at : at + 256] = np.minimum(new[at : at + 256], np.where(part, label[own][None], len(q)).min(1))
            new[own] = np.minimum(new[own], np.where(part, label[at : at + 256, None], len(q)).min(0))
        new = new[new]
        if (new == label).all():
            break
        label = new
    star = np.flatnonzero(label != np.arange(len(q)))
    return np.stack([q[star], q[label[star]]], 1)


def links(reps: DataFrame, cap: int = CAP, n: int | None = None) -> DataFrame:
    """Edges (a, b) that connect just the distinct fingerprints within DISTANCE bits, directly or over others."""
    found = plan(reps, DISTANCE)
    if any(t == 2 and len(bits) == 64 for bits, t in found):
        return stars(reps)
    probes = []
    for k, (bits, t) in enumerate(found):
        key = F.col("fp").bitwiseAND(F.lit(mask(bits)))
        entry = lambda flip, probe, k=k, key=key: F.struct(F.lit(k).alias("part"), key.bitwiseXOR(F.lit(flip)).alias("key"), F.lit(probe).alias("probe"))
        probes.append(F.array(entry(0, 0), *[entry(x, 0 if t == 2 else 1) for x in flips(bits)]) if t else F.array(entry(0, 0)))
    keys = reps.select("fp", F.explode(F.concat(*probes)).alias("x")).select("fp", "x.*")
    sizes = keys.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr("probe = 0")).alias("bases")).where("n > 1 and bases > 0")
    sizes = materialise(sizes, "sizes", rows=n and 8 * n)
    near = keys.join(sizes.where(F.col("n") <= cap), ["part", "key"])
    rows = near.groupBy("part", "key").agg(F.collect_list(F.when(F.col("probe") == 0, F.col("fp"))).alias("base"), F.collect_list(F.when(F.col("probe") == 1, F.col("fp"))).alias("probes"))
    edges = rows.select("base", "probes").mapInArrow(_verify(DISTANCE), "a long, b long")
    large = sizes.where(F.col("n") > cap)
    return edges.unionByName(stars(keys.join(large, ["part", "key"]).select("fp").distinct()))


def near_duplicates(docs: DataFrame, cap: int = CAP) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, links (other fingerprints of the component)."""
    prints = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_prints, "doc_id long, fp long"), "prints")
    reps, n = counted(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    label = components(links(reps, cap, n))
    named = reps.join(label, reps.fp == label.node, "left").select("fp", "rep", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("prints"))
    # A third of all documents may share a fingerprint: both sides are salted.
    classes = named.join(least, "label").select("fp", "component_id", "prints", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    out = prints.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(classes, ["fp", "salt"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", F.col("prints").alias("prints_in_component"))


def shingles(text: str, size: int = NEAR_SHINGLE) -> np.ndarray:
    """Distinct hashes of a text's shingles of size words."""
    return np.unique(hashes(text, size))


def bands(own: np.ndarray) -> np.ndarray:
    """BANDS keys of a set of shingles, each made of WIDTH minima of the set under different orders; none of an empty set."""
    if not len(own):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * WIDTH, np.iinfo(np.uint64).max)
    for at in range(0, len(own), 4096):
        np.minimum(least, (own[None, at : at + 4096] * _MINIMA).min(1), out=least)
    return ((least.reshape(BANDS, WIDTH) ^ (least.reshape(BANDS, WIDTH) >> np.uint64(31))) * _MIX).sum(1, dtype=np.uint64).view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, _row, text) to op4's fingerprint, the number of five-word shingles and the band keys."""
    for batch in (part for full in batches for part in slices(full, 2)):
        fp, size, keys = [], [], []
        for t in batch.column(2).to_pylist():
            t = t or ""
            own = shingles(t)
            fp.append(fingerprint(hashes(t)))
            size.append(len(own))
            keys.append(bands(own))
        cols = [pa.array(np.array(fp, np.uint64).view(np.int64), pa.int64()), pa.array(size, pa.int32()), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["_id", "_row", "fp", "size", "keys"])


SIGNED = "_id long, _row long, fp long, size int, keys array<long>"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for full in batches for part in slices(full, 1)):
        found = pa.array([shingles(t or "").view(np.int64) for t in batch.column(1).to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["node", "item"])


def _like(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two sorted sets of unsigned numbers."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return both / (len(a) + len(b) - both)


#: Jaccard index of sets of shingles; two alike ones share a rare shingle.
JACCARD = Measure(_like, share_prefix, by_prefix=True)


def _fit(likeness: float):
    """Whether sets of these sizes can be alike enough."""
    return lambda a, b: F.least(a, b) / F.greatest(a, b) >= likeness


def near_copies(texts: DataFrame, cap: int = CAP, likeness: float = 0.8) -> DataFrame:
    """texts(node long, text) to verified links (a, b, likeness) of near copies: distinct sets of five-word shingles alike to likeness.

    Candidates are all pairs of texts that share one of BANDS keys of WIDTH minima of their sets. The links connect just
    what all verified candidate pairs would. A null text, or one without words, is no near copy; nodes must be distinct.
    An empty table gives no links.
    """
    signed = materialise(texts.select("node", F.lit(0).cast("long"), "text").mapInArrow(_signed, SIGNED).select(F.col("_id").alias("node"), "size", "keys"), "signed")
    keys, n = buckets(signed)
    sets = materialise(texts.join(keys.select("node").distinct(), "node").select("node", "text").mapInArrow(_sets, "node long, item array<long>"), "sets")
    return verified(keys, n, sets, JACCARD, likeness, cap, _fit(likeness))[0]


def keep_one(docs: DataFrame, cap: int = CAP, likeness: float = 0.8) -> DataFrame:
    """The documents with their columns, one of each group of copies: that of the smallest (doc_id, content); a null doc_id comes last.

    First the components of near_duplicates(); then, of what stays, the near copies as near_copies() finds them.
    Rows are named by doc_id and a hash of all columns; of equal rows one stays. All documents whose text is null or
    has no words are one group. An empty table gives an empty one.
    """
    rows = docs.select(whole(docs).alias("doc")).select("doc", F.xxhash64("doc").alias("_row"), F.coalesce(F.col("doc.doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("_id"))
    signed, n = counted(rows.select("_id", "_row", "doc.text").mapInArrow(_signed, SIGNED), "prints")
    reps = materialise(signed.groupBy("fp").agg(F.min(F.struct("_id", "_row")).alias("least")), "reps", rows=n)
    label = components(links(reps.select("fp"), cap, n))
    named = reps.join(label, reps.fp == label.node, "left").select("least", F.coalesce("label", "fp").alias("label"))
    kept = named.groupBy("label").agg(F.min("least").alias("least")).select("least.*")
    kept = materialise(signed.join(kept, ["_id", "_row"]).dropDuplicates(["_id", "_row"]).select("_id", "_row", F.xxhash64("_id", "_row").alias("node"), "size", "keys"), "kept", rows=n)
    keys, n = buckets(kept)
    # The texts move once: rows of a key stay together for the removal of equal ones.
    tried = keys.select("node").distinct().withColumn("tried", F.lit(True))
    narrow = kept.select("_id", "_row", "node").join(tried, "node", "left")
    left = materialise(rows.join(narrow, ["_id", "_row"]).dropDuplicates(["_id", "_row"]).select("doc", "_id", "_row", "node", "tried"), "left")
    sets = materialise(left.where("tried").select("node", "doc.text").mapInArrow(_sets, "node long, item array<long>"), "sets")
    _, found = verified(keys, n, sets, JACCARD, likeness, cap, _fit(likeness))
    ids = kept.select("node", "_id", "_row").join(found, "node")
    first = ids.groupBy("label").agg(F.min_by("node", F.struct("_id", "_row")).alias("first"))
    gone = ids.join(first, "label").where("node <> first").select("node")
    return left.join(gone, "node", "left_anti").select("doc.*")
