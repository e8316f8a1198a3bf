"""Operator 10: token ids in a canonical, length-limited Huffman format.

File format: a Parquet directory whose rows are independent blocks, in
ascending (bucket, block) order. A block holds the bit streams of some
documents, each starting at a byte; checkpoints give the bit offset of every
EVERY-th id inside its document, so a decoder can start at any of them. The
code book (one length a symbol) is its own one-row table beside the blocks.

Code lengths come from the global counts by package-merge, at most LIMIT bits,
and codes are canonical: ordered by length, then id.

Nulls and empties: a null or empty text is the end id alone. Repeated rows are
written each on its own; rows with the same doc_id are ordered by content, a
null doc_id comes first. An empty table gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm import tokens
from tessera.llm.common import materialise, partitions

END_ID = 0
LIMIT = 16
EVERY = 256
BLOCK = 1 << 16  # ids in a block at least, but for the last of a bucket


def lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most limit bits, by package-merge; 0 for ids that do not occur."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes")
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    level, kept = leaf, []
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaf, pairs])
        by = np.argsort(both, kind="stable")
        level = both[by]
        kept.append(by < len(leaf))
    take = 2 * len(used) - 2
    for is_leaf in reversed(kept):
        n = int(is_leaf[:take].sum())
        out[order[:n]] += 1
        take = 2 * (take - n)
    out[order[:take]] += 1
    return out


def codes(length: np.ndarray) -> np.ndarray:
    """Canonical codes for the lengths."""
    out = np.zeros(len(length), np.int64)
    used = np.flatnonzero(length)
    by = used[np.lexsort((used, length[used]))]
    code, last = 0, 0
    for s in by.tolist():
        code <<= int(length[s]) - last
        last = int(length[s])
        out[s] = code
        code += 1
    return out


def table(length: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """For each limit-bit window: the symbol it starts with, and that symbol's length."""
    used = np.flatnonzero(length)
    by = used[np.lexsort((used, length[used]))]
    n = 1 << (limit - length[by].astype(np.int64))
    sym, size = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.uint8)
    total = int(n.sum())
    sym[:total], size[:total] = np.repeat(by, n), np.repeat(length[by], n)
    return sym, size


def encode(docs: list[np.ndarray], length: np.ndarray, code: np.ndarray) -> list[tuple[bytes, bytes]]:
    """(bit stream, checkpoints as little-endian 64-bit bit offsets) of each id array."""
    n = np.array([len(d) for d in docs], np.int64)
    if not n.sum():
        return [(b"", b"")] * len(docs)
    ids = np.concatenate(docs)
    bits = length[ids].astype(np.int64)
    end = np.cumsum(bits)
    last = np.cumsum(n)
    doc_end = np.where(last > 0, end[np.maximum(last, 1) - 1], 0)
    doc_start = np.concatenate([[0], doc_end[:-1]])
    size = (doc_end - doc_start + 7) // 8
    base = np.concatenate([[0], np.cumsum(size)[:-1]]) * 8
    inside = end - bits - np.repeat(doc_start, n)
    pos = inside + np.repeat(base, n)
    value = code[ids] << (32 - (pos & 15) - bits)
    words = int(size.sum()) // 2 + 2
    packed = np.bincount(pos >> 4, value >> 16, words) + np.bincount((pos >> 4) + 1, value & 0xFFFF, words)
    raw = packed.astype(">u2").tobytes()
    first = last - n
    out = []
    for a, k, b, z in zip(first.tolist(), n.tolist(), (base // 8).tolist(), size.tolist()):
        out.append((raw[b : b + z], inside[a : a + k : EVERY].astype("<i8").tobytes()))
    return out


def decode(payload: bytes, start_bit: np.ndarray, n: np.ndarray, sym: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Ids of all segments, one after another: segment k has n[k] ids from bit start_bit[k]. All segments advance together."""
    raw = np.frombuffer(payload + b"\0" * 4, np.uint8).astype(np.uint32)
    window = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    by = np.argsort(-n, kind="stable")
    place = (np.cumsum(n) - n)[by]
    pos, left = start_bit[by].copy(), n[by]
    out = np.empty(int(n.sum()), np.uint32)
    active = len(left) - np.searchsorted(left[::-1], np.arange(int(n.max(initial=0))), side="right")
    for step, m in enumerate(active.tolist()):
        p = pos[:m]
        w = (window[p >> 3] >> (8 - (p & 7)).astype(np.uint32)) & 0xFFFF
        out[place[:m] + step] = sym[w]
        pos[:m] += size[w]
    return out


def _tokenise(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = tokens.coder(path), np.array([END_ID], "<u2").tobytes()
        for batch in batches:
            ids = [b + end for b in coder.encode([t or "" for t in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(65536, np.int64)
    for batch in batches:
        for b in batch.column(0).to_pylist():
            total += np.bincount(np.frombuffer(b, "<u2"), minlength=65536) if len(b) > 65536 else 0
        small = b"".join(b for b in batch.column(0).to_pylist() if len(b) <= 65536)
        total += np.bincount(np.frombuffer(small, "<u2"), minlength=65536)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["id", "n"])


def _encode(book: bytes, bounds: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = np.frombuffer(book, np.uint8)
        code, cuts = codes(length), np.array(bounds, np.int64)
        for batch in batches:
            keys, raw = batch.column(0), batch.column(1).to_pylist()
            out, part, held = [], [], 0
            for b in raw:
                part.append(np.frombuffer(b, "<u2"))
                held += len(part[-1])
                if held > 1_000_000:
                    out += encode(part, length, code)
                    part, held = [], 0
            out += encode(part, length, code)
            ids = keys.to_pylist()
            bucket = np.searchsorted(cuts, np.array([-(1 << 63) if i is None else i for i in ids], np.int64), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), keys, pa.array([len(b) // 2 for b in raw], pa.int64()), pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary())], names=["bucket", "doc_id", "n", "bits", "marks"])

    return run


BLOCKS = "bucket int, block int, first long, doc_ids array<long>, n array<long>, bytes array<long>, marks binary, bits binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents to blocks; first: ids of the bucket before the block."""
    bucket, block, before, held, rows = None, 0, 0, 0, []

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([bucket], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()),
            pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([[r[1] for r in rows]], pa.list_(pa.int64())), pa.array([[len(r[2]) for r in rows]], pa.list_(pa.int64())),
            pa.array([b"".join(r[3] for r in rows)], pa.binary()), pa.array([b"".join(r[2] for r in rows)], pa.binary())],
            names=["bucket", "block", "first", "doc_ids", "n", "bytes", "marks", "bits"])

    for batch in batches:
        for b, *row in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if rows and (b != bucket or held >= BLOCK):
                yield flush()
                before += held
                block, held, rows = block + 1, 0, []
            if b != bucket:
                bucket, block, before = b, 0, 0
            rows.append(row)
            held += row[1]
    if rows:
        yield flush()


def _decode(book: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sym, size = table(np.frombuffer(book, np.uint8))
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                rows = batch.slice(at, 32).to_pylist()
                bits, starts, sizes, docs, base = [], [], [], [], 0
                for r in rows:
                    marks, k, start = np.frombuffer(r["marks"], "<i8"), 0, r["first"]
                    for doc, n, b in zip(r["doc_ids"], r["n"], r["bytes"]):
                        m = -(-n // EVERY)
                        starts.append(marks[k : k + m] + base * 8)
                        sizes.append(np.minimum(EVERY, n - EVERY * np.arange(m)))
                        docs.append((r["bucket"], doc, start, n))
                        k, base, start = k + m, base + b, start + n
                    bits.append(r["bits"])
                ids = decode(b"".join(bits), np.concatenate(starts), np.concatenate(sizes), sym, size)
                raw, at_id, crc = memoryview(ids.astype("<u4").tobytes()), 0, []
                for _, _, _, n in docs:
                    crc.append(zlib.crc32(raw[4 * at_id : 4 * (at_id + n)]))
                    at_id += n
                b, doc, start, n = zip(*docs)
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], names=["bucket", "doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def write(docs: DataFrame, out: str, path: str | None = None) -> None:
    """Tokenise docs(doc_id, text) and write the format under the folder out, which any executor can reach."""
    spark = docs.sparkSession
    ids = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokenise(path or tokens.default_path()), "doc_id long, ids binary"), "ids")
    total = np.zeros(65536, np.int64)
    for r in ids.select("ids").mapInArrow(_count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # a row for each id of the vocabulary at most
        total[r["id"]] = r["n"]
    book = lengths(total).tobytes()
    parts = partitions(spark)
    bounds = ids.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10000)).first()[0] if parts > 1 else None
    done = ids.mapInArrow(_encode(book, sorted(set(bounds or []))), "bucket int, doc_id long, n long, bits binary, marks binary")
    dealt = done.repartitionById(parts, F.col("bucket")).sortWithinPartitions("bucket", "doc_id", "n", F.crc32("bits"), "bits")
    spark.createDataFrame([(bytearray(book),)], "lengths binary").coalesce(1).write.parquet(f"{out}/book")
    dealt.mapInArrow(_blocks, BLOCKS).write.option("compression", "uncompressed").parquet(f"{out}/blocks")


def read(spark: SparkSession, out: str) -> DataFrame:
    """Decode the files: doc_id, start, n_tokens, ids_crc32, in no given order."""
    book = bytes(spark.read.schema("lengths binary").parquet(f"{out}/book").first()[0])
    blocks = spark.read.schema(BLOCKS).parquet(f"{out}/blocks")
    sums = blocks.groupBy("bucket").agg(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)).alias("_n"))
    offsets = sums.select("bucket", F.coalesce(F.sum("_n").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row a bucket: as many as there are partitions
    found = blocks.mapInArrow(_decode(book), "bucket int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return found.join(F.broadcast(offsets), "bucket").select("doc_id", (F.col("start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")
