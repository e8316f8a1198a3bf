"""Operator 6: hierarchical multi-length packing.

Every document's ids are cut into full windows and one remainder, which is routed to a tier: the
smallest power of two that holds it. The tiers are packed from the longest down. A
tier's remainders open windows of its size, and their gaps are filled by best fit from the shorter tiers.
A window that is filled to the last id is a sequence of that tier, which needs no padding. What
the tiers leave is packed by best fit, longest first, into windows of the longest tier. Where such a window stays badly
filled, its longest piece is cut at the largest power of two in it and the tail
fills a gap elsewhere; so again, until little padding is left.

A step group holds sequences of one tier and about STEP tokens, so that all steps cost about the same.

The plan works on the histogram of remainder lengths, at most WINDOW numbers
whatever the corpus, so the driver holds no documents. Documents get their
place by rank among remainders of the same length; ranks come from bucket sums.

Nulls and empties: a null or empty text is the end id alone. Repeated rows are
packed each on its own. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import tokens
from tessera.llm.common import materialise, partitions, prefix_sums

WINDOW = 2048
END_ID = 1
LEAST_TIER = 64
STEP = 256 * WINDOW
PADDING = 0.01  # of all remainders' tokens: below it, nothing more is cut


def tier(length: int) -> int:
    """The largest power of two that length holds."""
    return 1 << (length.bit_length() - 1)


def fill(counts: dict[int, int], window: int = WINDOW, opens: int = 0) -> tuple[list[tuple[int, list[tuple[int, int]]]], dict[int, int]]:
    """Best fit, longest first, on counts by length: (number of windows, [(length, copies)]) groups of equal windows, and what is not placed. Lengths of at most opens only fill gaps."""
    gaps: dict[int, list] = defaultdict(list)
    rest: dict[int, int] = {}
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            gap = next((g for g in range(length, window + 1) if gaps.get(g)), None)
            if gap is None and length <= opens:
                rest[length] = n
                break
            if gap is None:
                many, content, gap = n, [], window
            else:
                many, content = gaps[gap].pop()
            copies = min(gap // length, n)
            used = min(many, n // copies)
            if used < many and content:
                gaps[gap].append((many - used, content))
            gaps[gap - copies * length].append((used, [*content, (length, copies)]))
            n -= used * copies
    return [(n, content) for g in sorted(gaps) for n, content in gaps[g]], rest


def total_of(content: list[tuple[int, int]]) -> int:
    return sum(length * copies for length, copies in content)


def context(tokens: int, window: int = WINDOW) -> int:
    """The tier of a sequence: its own length at a power of two, else the window that it is padded to."""
    return window if tokens & (tokens - 1) else tokens


def by_tier(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups of equal windows: those that the tiers fill, from the longest down, and those of what is left."""
    done, left = [], dict(counts)
    size = window
    while size >= LEAST_TIER:
        groups, rest = fill({k: n for k, n in left.items() if k <= size}, size, size // 2)
        longer = {k: n for k, n in left.items() if k > size}
        left = Counter(longer) + Counter(rest)
        for n, content in groups:
            if total_of(content) == size:
                done.append((n, content))
            else:
                for length, copies in content:
                    left[length] += n * copies
        size //= 2
    return done + fill(dict(left), window)[0]


def halves(length: int) -> list[tuple[int, int]]:
    """(start, size) of the heads that may be cut from a remainder one after another: the powers of two in length, down to LEAST_TIER."""
    out, start = [], 0
    while length - start >= LEAST_TIER:
        out.append((start, tier(length - start)))
        start += out[-1][1]
    return out


def plan(hist: dict[int, int], window: int = WINDOW) -> tuple[list[tuple], list[tuple[int, int]]]:
    """hist: remainders by length. Gives the rows (rest, lo, hi, head, depth, start, size, q, base, copies, at) and (tier, number of sequences), in the order of sequences.

    A remainder of length rest and rank in [lo, hi) has a piece of that start and size, its head number head, or at 0 what is left
    after depth heads; the piece is in sequence base + (rank + q) div copies, at offset at + ((rank + q) mod copies) * size.
    """
    cut = {k: [(0, 0), *((start + size, i + 1) for i, (start, size) in enumerate(halves(k)))] for k in hist}  # start of the tail at each depth
    depths = {k: [n, *[0] * (len(cut[k]) - 1)] for k, n in hist.items()}  # remainders by depth
    total = sum(k * n for k, n in hist.items())
    while True:
        sizes: Counter[int] = Counter()
        members = defaultdict(list)
        for k, ns in depths.items():
            for c, n in enumerate(ns):
                size = k - cut[k][c][0]
                if n and size:
                    sizes[size] += n
                    members[size].append((k, c))
        groups = by_tier(dict(sizes), window)
        wasted = [(window - total_of(c), n, c) for n, c in groups]
        wasted = [(g, n, c) for g, n, c in wasted if (window - g) & (window - g - 1)]  # a power of two needs no padding
        if sum(g * n for g, n, _ in wasted) <= PADDING * total:
            break
        moved = 0
        for gap, n, content in wasted:
            size = max((k for k, _ in content if k >= LEAST_TIER), default=0)
            if gap <= PADDING * window or not size:
                continue
            for k, c in members[size]:
                m = min(n, depths[k][c])
                depths[k][c] -= m
                depths[k][c + 1] += m
                n, moved = n - m, moved + m
        if not moved:
            break
    rows: list[tuple] = []
    made = []  # (tier, number of sequences, a head's place or None, content) of all sequences
    for k, ns in depths.items():
        rank = 0
        for c, n in enumerate(ns):
            made += [(size, n, (k, rank, c, i + 1, start), []) for i, (start, size) in enumerate(halves(k)[:c]) if n]
            rank += n
    made += [(context(total_of(content), window), n, (), content) for n, content in groups]
    seq, tiers = 0, Counter()
    spans = defaultdict(list)  # of class ranks by size: (from, to, base, copies, offset)
    used: Counter[int] = Counter()
    for size, n, head, content in sorted(made, key=lambda m: (-m[0], *m[1:])):
        if head:
            k, rank, c, number, start = head
            rows.append((k, rank, rank + n, number, c, start, size, -rank, seq, 1, 0))
        offset = 0
        for length, copies in content:
            spans[length].append((used[length], used[length] + n * copies, seq, copies, offset))
            used[length] += n * copies
            offset += length * copies
        tiers[size] += n
        seq += n
    for size, found in spans.items():
        at = 0  # class ranks run over the members of the class in order
        for k, c in sorted(members[size]):
            n, rank = depths[k][c], sum(depths[k][:c])
            for a, b, base, copies, offset in found:
                lo, hi = max(a, at), min(b, at + n)
                if lo < hi:  # class rank = rank of the remainder - rank + at
                    rows.append((k, lo - at + rank, hi - at + rank, 0, c, cut[k][c][0], size, at - rank - a, base, copies, offset))
            at += n
    return rows, sorted(tiers.items(), reverse=True)


PIECES = "doc_id long, doc_tokens long, crcs array<long>, rest int, heads array<long>, tails array<long>"


def pieces_of(path: str):
    """Tokenise: per document the checksums of its full windows, and of its remainder's heads and of what is left after each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.coder(path)
        for batch in batches:
            ids, n, crcs, rest, heads, tails = batch.column(0), [], [], [], [], []
            for b in coder.encode([t or "" for t in batch.column(1).to_pylist()]):
                wide = np.append(np.frombuffer(b, "<u2").astype("<u4"), np.uint32(END_ID)).astype("<u4")
                raw = memoryview(wide.tobytes())
                full, left = divmod(len(wide), WINDOW)
                n.append(len(wide))
                rest.append(left)
                crcs.append([zlib.crc32(raw[k * WINDOW * 4 : (k + 1) * WINDOW * 4]) for k in range(full)])
                last, cuts = raw[full * WINDOW * 4 :], halves(left)
                heads.append([zlib.crc32(last[4 * a : 4 * (a + z)]) for a, z in cuts])
                tails.append([zlib.crc32(last[4 * a :]) for a in (0, *(a + z for a, z in cuts))])
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(crcs, lists), pa.array(rest, pa.int32()), pa.array(heads, lists), pa.array(tails, lists)], names=["doc_id", "doc_tokens", "crcs", "rest", "heads", "tails"])

    return run


def pack(docs: DataFrame, path: str | None = None, step: int = STEP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier (the context size of its sequence), step_group.

    step: tokens of a step group, all of one tier.
    """
    spark = docs.sparkSession
    cut = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(pieces_of(path or tokens.default_path()), PIECES), "pieces")
    hist = {r[0]: r[1] for r in cut.where("rest > 0").groupBy("rest").count().collect()}  # at most WINDOW - 1 rows
    full = cut.agg(F.sum(F.size("crcs"))).first()[0] or 0
    rows, tiers = plan(hist)
    tiers = list((Counter(dict(tiers)) + Counter({WINDOW: full})).items())
    bounds, first, groups = [], 0, 0  # of each tier: size, first sequence, first step group
    for size, n in sorted(tiers, reverse=True):
        bounds.append((size, first, groups))
        first, groups = first + n, groups + -(-n * size // step)
    # As many rows as the histogram's plan has, a few for each length, so the broadcast has a fixed bound.
    table = spark.createDataFrame(rows or [(0,) * 11], "rest int, lo long, hi long, head int, depth int, begin int, size int, q long, base long, copies long, at long")
    dealt = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "tails"), F.lit(4 * partitions(spark))))
    order = ["doc_id", "tails", "doc_tokens", "crcs"]
    ranked = prefix_sums(dealt, [], "_bucket", order, F.size("crcs").cast("long"), "_first")
    ranked = prefix_sums(ranked, ["rest"], "_bucket", order, F.lit(0), "_zero", rank="_rank")
    placed = ranked.alias("d").join(F.broadcast(table).alias("p"), (F.col("d.rest") == F.col("p.rest")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi")), "left")
    q = F.col("_rank") + F.col("q")
    piece = F.struct(
        (F.size("crcs") * WINDOW + F.col("begin")).cast("long").alias("start"), F.col("size").cast("long").alias("length"),
        F.when(F.col("head") > 0, F.try_element_at("heads", F.col("head"))).otherwise(F.try_element_at("tails", F.col("depth") + 1)).alias("ids_crc32"),
        (full + F.col("base") + F.floor(q / F.col("copies"))).cast("long").alias("sequence_id"), (F.col("at") + q % F.col("copies") * F.col("size")).cast("long").alias("offset"))
    windows = F.transform("crcs", lambda c, i: F.struct((i * WINDOW).cast("long").alias("start"), F.lit(WINDOW).cast("long").alias("length"), c.alias("ids_crc32"), (F.col("_first") + i).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    none = F.slice(windows, 1, 0)
    every = F.concat(F.when(F.col("depth").isNull() | (F.col("depth") == 0) | (F.col("head") == 1), windows).otherwise(none), F.when(F.col("depth").isNotNull(), F.array(piece)).otherwise(none))
    out = placed.select("doc_id", "doc_tokens", F.explode(every).alias("x"))
    tier, group = F.lit(WINDOW), F.lit(0).cast("long")
    for size, at, base in bounds:  # one for each power of two at most
        here = F.col("x.sequence_id") >= at
        tier = F.when(here, F.lit(size)).otherwise(tier)
        group = F.when(here, F.lit(base) + F.floor((F.col("x.sequence_id") - at) * size / F.lit(step))).otherwise(group)
    return out.select("doc_id", "x.start", "x.length", "x.ids_crc32", "doc_tokens", "x.sequence_id", "x.offset", tier.alias("tier"), group.cast("long").alias("step_group"))
