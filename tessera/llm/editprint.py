"""Operator 3: document fingerprints by a randomised edit embedding.

Every text walks through one shared random table: at each position of the
embedded string the walk writes the current character and, by a random bit of
(position, character), moves on to the next one; a character is written three
times at most. Edits shift the input but soon fall back into the same walk, so
edit distance becomes Hamming distance between embedded strings.

A fingerprint samples the embedded string at fixed positions: the first ones
densely, then at growing steps, so that it covers texts of any length. Each
sample is four hash bits of (position, character). Likeness is the share of
equal samples, each weighted by the stretch of positions it stands for, less
what unrelated samples agree on by chance.

near_classes() bands the samples, probes the bands and verifies the candidates; near() gives every document its class.

Nulls and empties: null counts as empty; an empty text's fingerprint is "0:",
alike (1) to another empty one and unlike (0) to any other. Rows are ordered by
descending doc_id, null last, then by content; repeated rows each have their
own next row. The next document of a single row is that row itself. Texts of equal fingerprints are
one class, and a class without any doc_id has none as its class_id. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.banding import Measure, buckets, verified
from tessera.llm.common import counted, materialise, partitions, slices

SEED = 20_240_501
PERIOD, CLASSES = 2048, 128
#: Walks of fewer texts than this go one by one; more advance together.
TOGETHER = 48
#: Samples by which the length scales of bands differ.
SCALE = 8
ALIKE = 0.8
#: How often unlike texts agree on a sample (letters are not equally frequent), how many unlike partners a band may bring a text, and how often an alike pair may share no band.
CHANCE, STRANGERS, MISSED = 1 / 8, 0.25, 0.02


def _samples() -> np.ndarray:
    """Positions: 48 first ones, then each 1.066 times the last, with a seeded offset, to 2**31."""
    rng, out, at = np.random.default_rng(SEED), list(range(48)), 48.0
    while at < 1 << 31:
        step = max(1.0, at * 0.066)
        out.append(int(at + rng.random() * step))
        at += step
    return np.unique(np.array(out, np.int64))


SAMPLES = _samples()
WEIGHTS = np.diff(np.append(SAMPLES, SAMPLES[-1] * 1.066))
_rng = np.random.default_rng(SEED + 1)
#: Positions that a character takes: 1, 2 or 3 with chances 1/2, 1/4, 1/4.
STEP = np.array([1, 1, 2, 3], np.uint8)[_rng.integers(0, 4, PERIOD * CLASSES)]
SALT = _rng.integers(1, 1 << 31, len(SAMPLES), dtype=np.int64) | 1
DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def walk(flat: np.ndarray, n: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start position of every character, and the end of every walk. Text k has n[k] characters of flat and starts at begin[k]."""
    cls = ((flat * np.uint32(2654435761)) >> np.uint32(25)).astype(np.int64)
    pos = np.empty(len(flat), np.int64)
    by = np.argsort(-n, kind="stable")
    at = (np.cumsum(n) - n)[by]
    left, j = n[by], begin[by].copy()
    many = len(left) - np.searchsorted(left[::-1], np.arange(int(n.max(initial=0))), side="right")
    alone = int(np.searchsorted(-many, -TOGETHER, side="right"))  # from this character on, fewer texts than TOGETHER go on
    for m in many[:alone].tolist():
        here = at[:m]
        pos[here] = j[:m]
        j[:m] += STEP[((j[:m] & (PERIOD - 1)) << 7) | cls[here]]
        at[:m] += 1
    step = STEP.tolist() if alone < len(many) else []
    for k in range(int(many[alone]) if alone < len(many) else 0):
        a, z, p, out = int(at[k]), int(at[k] + left[k] - alone), int(j[k]), []
        for c in cls[a:z].tolist():
            out.append(p)
            p += step[((p & 2047) << 7) | c]
        pos[a:z] = out
        j[k] = p
    end = np.empty(len(n), np.int64)
    end[by] = j
    return pos, end


def digits(chars: np.ndarray, pos: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Samples of the positions in [lo, hi), from characters starting at pos."""
    a, z = np.searchsorted(SAMPLES, [lo, hi])
    char = chars[np.searchsorted(pos, SAMPLES[a:z], side="right") - 1].astype(np.int64)
    return ((((char + 1) * SALT[a:z]) ^ (SALT[a:z] >> 7)) * 40503 >> 13) & 15


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    k, most = min(len(a), len(b)), max(len(a), len(b))
    if not most:
        return 1.0
    share = float(WEIGHTS[:k][a[:k] == b[:k]].sum() / WEIGHTS[:most].sum())
    return share if share == 1 else max(0.0, (share - 1 / 16) / (1 - 1 / 16))


def may_be_alike(items: list[np.ndarray], least: float, group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """All pairs alike to least: each item against all later ones at once."""
    size = np.array([len(i) for i in items])
    full = np.full((len(items), int(size.max(initial=0))), -1, np.int8)
    for row, own in zip(full, items):
        row[: len(own)] = own
    total = np.append(0.0, np.cumsum(WEIGHTS))
    for x in range(len(items) - 1):
        k = size[x]
        same = (full[x + 1 :, :k] == full[x, :k]) @ WEIGHTS[:k]
        share = same / np.maximum(total[np.maximum(size[x + 1 :], k)], 1e-300)
        near = (share - 1 / 16) / (1 - 1 / 16)
        ys = np.flatnonzero((near >= least - 1e-9) | (size[x + 1 :] + k == 0))
        if len(ys):
            yield x, ys + x + 1


def text_of(end: int, d: np.ndarray) -> str:
    return f"{end:x}:" + DIGITS[d].tobytes().decode()


def digits_of(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(fingerprint.partition(":")[2].encode(), np.uint8)
    return np.where(raw > 57, raw - 87, raw - 48).astype(np.int64)


def block(texts: list[str], nexts: list[str]) -> list[tuple]:
    """For each text (n_chars, edited_sha256, fingerprint, edited fingerprint, digits, edited digits)."""
    chars = [code_points(t) for t in texts]
    n = np.array([len(c) for c in chars], np.int64)
    pos, end = walk(np.concatenate(chars), n, np.zeros(len(n), np.int64))
    off = np.cumsum(n) - n
    kept = n - n // 3
    tails = [code_points(x[: int(k)]) for x, k in zip(nexts, n // 3)]
    begin = np.array([pos[o + k] if k < m else e for o, k, m, e in zip(off, kept, n, end)], np.int64)
    tn = np.array([len(t) for t in tails], np.int64)
    tpos, tend = walk(np.concatenate(tails), tn, begin)
    toff, out = np.cumsum(tn) - tn, []
    for k, text in enumerate(texts):
        own = pos[off[k] : off[k] + n[k]]
        d = digits(chars[k], own, 0, int(end[k])) if n[k] else np.zeros(0, np.int64)
        head = d[: int(np.searchsorted(SAMPLES, begin[k]))]
        tail = digits(tails[k], tpos[toff[k] : toff[k] + tn[k]], int(begin[k]), int(tend[k])) if tn[k] else head[:0]
        e = np.concatenate([head, tail])
        edited = text[: int(kept[k])] + nexts[k][: int(n[k]) // 3]
        out.append((int(n[k]), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), text_of(int(end[k]), d), text_of(int(tend[k]), e), d, e))
    return out


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, guest, doc_id, text) in order; a row's next document is the one after it in its bucket, at the end a guest."""
    held: list[tuple] = []  # rows whose results are not out yet; the last one waits for the row after it

    def results(rows: list[tuple]) -> pa.RecordBatch:
        # The last row only serves as the next of the one before it.
        texts = [r[3] for r in rows]
        found = block(texts, [*texts[1:], ""])
        got = [(rows[k][2], *found[k][:4], likeness(found[k][4], found[k][5]), likeness(found[k][4], found[k + 1][4])) for k in range(len(rows) - 1) if not rows[k][1] and rows[k][0] == rows[k + 1][0]]
        cols = list(zip(*got)) or [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=NAMES)

    size = 0
    for batch in batches:
        for row in (row for part in slices(batch, 3) for row in zip(*(part.column(k).to_pylist() for k in range(4)))):
            row = (*row[:3], CODEC.decompress(row[3][8:], int.from_bytes(row[3][:8], "little"), asbytes=True).decode("utf-8", "surrogatepass"))
            held.append(row)
            size += len(row[3])
            if size > 6_000_000 and len(held) > 1:
                yield results(held)
                held, size = held[-1:], len(held[-1][3])
    if len(held) > 1:
        yield results(held)


#: Texts are moved in this form: eight bytes of length, and the compressed text.
CODEC = pa.Codec("zstd")


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, hash, text), compressed."""
    for batch in (part for full in batches for part in slices(full, 1)):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
        small = [len(t).to_bytes(8, "little") + CODEC.compress(t, asbytes=True) for t in raw]
        order = [int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True) for t in raw]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(order, pa.int64()), pa.array(small, pa.binary())], names=["doc_id", "place", "text"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and likeness to that and to the next document."""
    parts = partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_squeeze, "doc_id long, place long, text binary")
    found = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [k / parts for k in range(1, max(2, parts))], 10000), F.max(F.col("doc_id").cast("long")), F.count(F.lit(1)) != F.count("doc_id")).first()
    cuts, top, nulls = sorted(set(found[0] or []), reverse=True), found[1], found[2]
    if cuts and cuts[0] == top:
        cuts = cuts[1:]
    ends = F.array(*[F.lit(int(c)).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")  # a literal, once a plan
    # Bucket k has the ids in (cuts[k], cuts[k - 1]], in descending order; the first id of a bucket is a guest in the one before,
    # the greatest id one in the last; null ids are last.
    last = len(cuts)
    spot = F.coalesce(F.size(F.filter(ends, lambda c: c >= F.col("doc_id"))), F.lit(last)).cast("int")
    spot = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(spot)
    guest = F.when(F.array_contains(ends, F.col("doc_id")), spot - 1)
    wrap = F.when(F.col("doc_id") == F.lit(top), F.lit(last)) if top is not None else F.when(F.col("doc_id").isNull(), F.lit(last))
    seats = F.array_compact(F.array(F.struct(spot.alias("bucket"), F.lit(0).alias("guest")), F.when(guest.isNotNull(), F.struct(guest.alias("bucket"), F.lit(1).alias("guest"))), F.when(wrap.isNotNull(), F.struct(wrap.alias("bucket"), F.lit(2).alias("guest")))))
    seated = rows.select(F.explode(seats).alias("s"), "doc_id", "place", "text").select("s.bucket", "s.guest", "doc_id", "text", "place")
    order = ["bucket", "guest", F.desc_nulls_last("doc_id"), "place", "text"]
    return seated.repartitionById(max(1, last + 1), F.col("bucket")).sortWithinPartitions(*order).mapInArrow(_run, OUT)


def banding_for(n: int, threshold: float = ALIKE) -> tuple[int, int]:
    """(bands, width) for n fingerprints: bands so wide that unlike ones rarely meet, however many there are, and so many that a pair alike to threshold shares one with a chance of 1 - MISSED."""
    width = max(4, int(np.ceil(np.log(max(n, 1) / STRANGERS) / np.log(1 / CHANCE))))
    share = (threshold * 15 / 16 + 1 / 16) ** width
    return int(np.ceil(np.log(MISSED) / np.log(1 - share))), width


def _levels(n: int, threshold: float) -> range:
    """Levels, of SCALE samples each, at which a fingerprint of n samples is banded: every level that the longest of another one can be, alike to threshold."""
    total = np.cumsum(WEIGHTS)
    least = int(np.searchsorted(total, threshold * total[n - 1] * (1 - 1e-9))) + 1
    return range(min(least, n) // SCALE, n // SCALE + 1)


def _band_keys(level: int, bands: int, width: int, seed: int) -> np.ndarray:
    """Sample numbers of each band at a level: drawn by weight over all samples that the level holds."""
    weight = WEIGHTS[: max(1, level * SCALE)]
    return np.random.default_rng([seed, level]).choice(len(weight), (bands, width), p=weight / weight.sum())


def _keys(threshold: float, bands: int, width: int):
    """(node, fingerprint) to (node, size, keys, item): at every level that an alike one can share, a key for each band; item: the samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple] = {}
        for batch in batches:
            keys, items = [], []
            for fp in batch.column(1).to_pylist():
                d = digits_of(fp)
                found = []
                for level in _levels(len(d), threshold) if len(d) else ():
                    if level not in drawn:
                        mix = np.random.default_rng([SEED + 8, level]).integers(1, 1 << 63, (bands, width), dtype=np.uint64) | np.uint64(1)
                        drawn[level] = _band_keys(level, bands, width, SEED + 7), mix
                    at, mix = drawn[level]
                    found.append(((d[at].astype(np.uint64) + np.uint64(1)) * mix).sum(1, dtype=np.uint64).view(np.int64))
                keys.append(np.stack(found, 1).ravel() if found else np.zeros(0, np.int64))  # a band's levels side by side
                items.append(d.astype(np.int8))
            size = pa.array([len(d) for d in items], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(keys, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.int8()))], names=["node", "size", "keys", "item"])

    return run


def near_classes(prints: DataFrame, threshold: float = ALIKE, n: int | None = None, cap: int = 512) -> tuple[DataFrame, DataFrame]:
    """n distinct fingerprints(node, fingerprint), counted if n is not given, to verified links (a, b, likeness) of likeness threshold or more, and their components (node, label).

    Bands of samples, drawn by weight over all samples of a length scale, are probed at the scales that both lengths
    of a pair can share; banding_for(n) says how many and how wide. Every pair that shares a band is verified or connected by others; pairs that share none are missed. Nodes are
    distinct; a null fingerprint is none, and is left out.
    """
    some = prints.where("fingerprint is not null")
    bands, width = banding_for(some.count() if n is None else n, threshold)
    signed = materialise(some.mapInArrow(_keys(threshold, bands, width), "node long, size int, keys array<long>, item array<byte>"), "signed")
    keys, rows = buckets(signed.select("node", "size", "keys"))
    tried = signed.select("node", "item").join(keys.select("node").distinct(), "node", "left_semi")
    return verified(keys, rows, materialise(tried, "tried"), Measure(likeness, may_be_alike), threshold, cap)


def near(docs: DataFrame, threshold: float = ALIKE) -> DataFrame:
    """fingerprints() with each document's class_id, the smallest doc_id that links of fingerprints reach, and prints_in_class, its number of different fingerprints."""
    found = materialise(fingerprints(docs), "fingerprints")
    # Two hashes name a fingerprint; the pair of them is its key.
    named = found.groupBy(F.xxhash64("fingerprint").alias("node"), F.xxhash64("fingerprint", F.lit(1)).alias("twin")).agg(F.min("doc_id").alias("rep"), F.first("fingerprint").alias("fingerprint"))
    named, n = counted(named, "prints")
    _, label = near_classes(named.dropDuplicates(["node"]).select("node", "fingerprint"), threshold, n)
    linked = named.select("node", "twin", "rep").join(label, "node")
    least = linked.groupBy("label").agg(F.min("rep").alias("class_id"), F.count(F.lit(1)).alias("prints_in_class"))
    alone = named.join(label, "node", "left_anti").select("node", "twin", F.col("rep").alias("class_id"), F.lit(1).cast("long").alias("prints_in_class"))
    classes = linked.join(least, "label").select("node", "twin", "class_id", "prints_in_class").unionByName(alone)
    # A third of all documents may share a fingerprint: Spark splits such a join.
    return found.withColumn("node", F.xxhash64("fingerprint")).withColumn("twin", F.xxhash64("fingerprint", F.lit(1))).join(classes, ["node", "twin"]).select(*found.columns, "class_id", "prints_in_class")
