"""Operator 7: toxicity by a factorisation machine over hashed terms.

A term is a word (lower case, letters only) or one of its beginnings of STEMS
letters, which catch inflected forms; each is hashed to one of BUCKETS numbers. The
machine has a weight for each kept number and a vector of FACTORS values, whose inner
products weigh pairs of terms, such as an insult with the mention of a group, which
added weights miss. A document's features are the distinct kept numbers of its
whole text, so length neither dilutes nor cuts anything.

Training: a sample of labelled rows, the least by hash of doc_id, at most SAMPLE of them and TERMS
numbers in all (documented bounds; their share of the corpus does not matter). One task fits
the machine in three steps. All numbers of LEAST documents are admitted. Weights alone are fitted
with an L1 penalty at the level that noise reaches, which sets most of them to nothing. The errors
left are then summed over the documents of each pair of numbers that may share enough of them, by dense blocks for
the PAIRED most frequent numbers and document by document for pairs with a rarer one: of the pairs
beyond what noise reaches over all pairs, the PAIRS clearest of either kind stay, even if their members are neutral alone.
The whole machine is fitted to the numbers that stay. All is fixed by seed.

Nulls and empties: a null or empty text gets the score of no features. Labels
that are null, or of rows without a document, are left out; of several labels the highest
counts. With no labels at all every score is 0. Repeated rows are scored each on
its own. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.llm.common import materialise, slices, whole

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 20
STEMS = (3, 4, 5, 6)
SAMPLE, TERMS = 16_000, 8_000_000
FACTORS = 4
LEAST = 4  # documents of the sample that an admitted number occurs in at least
PAIRED, PAIRS = 2048, 200  # most frequent numbers, whose pairs are summed as dense blocks, and pairs of a kind that stay at most: the size of the model
THRESHOLD = 0.3
REMEMBER = 4 << 20  # characters of the words that a worker remembers
SEED = 7


def numbers(word: str) -> list[int]:
    raw = [word, *(word[:k] + "-" for k in STEMS if len(word) > k)]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in raw]


def features(text: str | None) -> set[int]:
    """All hashed terms of a text."""
    out: set[int] = set()
    for w in set(WORD.findall((text or "").lower())):
        out.update(numbers(w))
    return out


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, toxic) to (doc_id, toxic, n, terms): the hashed terms, four bytes each."""
    for batch in (part for full in batches for part in slices(full, 1)):
        found = [np.sort(np.fromiter(features(t), "<i4")) for t in batch.column(1).to_pylist()]
        cols = [batch.column(0), batch.column(2), pa.array(map(len, found), pa.int32()), pa.array([x.tobytes() for x in found], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "toxic", "n", "terms"])


class Table:
    """The sample: documents with their numbers, worked on in parts so that no array of all of them is made."""

    def __init__(self, col: np.ndarray, size: np.ndarray, width: int, part: int = 1 << 20) -> None:
        self.col, self.size, self.n, self.width = col, size, len(size), width
        self.end = np.cumsum(size)
        self.cuts = [0, *sorted({int(np.searchsorted(self.end, k)) for k in range(part, len(col), part)} - {0, self.n}), self.n]

    def parts(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        for lo, hi in zip(self.cuts[:-1], self.cuts[1:]):
            if hi > lo:
                yield slice(lo, hi), np.repeat(np.arange(hi - lo), self.size[lo:hi]), self.col[self.end[lo] - self.size[lo] : self.end[hi - 1]]

    def rows(self, kept: np.ndarray) -> list[list[int]]:
        """Of each document, the indices into kept (sorted numbers) of its numbers."""
        at = np.full(self.width, -1)
        at[kept] = np.arange(len(kept))
        out: list[list[int]] = [[] for _ in range(self.n)]
        for rows, row, col in self.parts():
            own = at[col]
            for r, c in zip((rows.start + row[own >= 0]).tolist(), own[own >= 0].tolist()):
                out[r].append(c)
        return out

    def times(self, v: np.ndarray) -> np.ndarray:
        """Sum of v over each document's numbers."""
        return np.concatenate([np.zeros(0), *(np.bincount(row, v[col], rows.stop - rows.start) for rows, row, col in self.parts())])

    def back(self, u: np.ndarray) -> np.ndarray:
        """Sum of u over each number's documents."""
        return sum((np.bincount(col, u[rows][row], self.width) for rows, row, col in self.parts()), np.zeros(self.width))


def sparse_weights(x: Table, y: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Weights by logistic loss with an L1 penalty, and the errors left; numbers are scaled to equal variance, and the penalty is the largest of as many pure noise terms (accelerated proximal gradient)."""
    df = x.back(np.ones(x.n))
    scale = 1 / np.sqrt(df * (1 - df / x.n) + 0.5)
    share = y.mean()
    penalty = np.sqrt(2 * np.log(x.width + 1) * share * (1 - share))
    u = np.random.default_rng(SEED).normal(size=x.width)
    for _ in range(6):  # the steepest curvature, by power iteration
        r = x.times(scale * (u / np.linalg.norm(u)))
        u = scale * x.back(r - r.mean())
    steep = 0.3 * np.linalg.norm(u) + 1e-9
    bias, w, z, t = float(np.log((y.sum() + 1) / (x.n - y.sum() + 1))), np.zeros(x.width), np.zeros(x.width), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(bias + x.times(scale * z), -30, 30)))
        bias -= 0.5 * float((p - y).mean() / max((p * (1 - p)).mean(), 0.02))
        new = z - scale * x.back((p - y) - (p - y).mean()) / steep
        new = np.sign(new) * np.maximum(np.abs(new) - penalty / steep, 0)
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / later * (new - w), new, later
    return scale * w, y - 1 / (1 + np.exp(-np.clip(bias + x.times(scale * w), -30, 30)))


def _rare_pairs(x: Table, left: np.ndarray, alone: np.ndarray, some: np.ndarray, dense: np.ndarray, df: np.ndarray, least: float, limit: float, part: int = 1 << 19) -> list[tuple[float, int, int]]:
    """(-z, a, b) of telling pairs of the numbers some of which a is not in dense: the documents of a are looked at, and what they have beside it. Only some's numbers are held, and about part places of rare ones at a time."""
    at = np.full(x.width, -1, np.int32)
    at[some] = np.arange(len(some), dtype=np.int32)
    col, size, end = np.empty(int(df[some].sum()), np.int32), np.zeros(x.n, np.int64), 0
    for rows, row, c in x.parts():
        own = at[c]
        size[rows] = np.bincount(row[own >= 0], minlength=rows.stop - rows.start)
        own = own[own >= 0]
        col[end : end + len(own)], end = own, end + len(own)
    begin = np.append(0, np.cumsum(size))
    rare = np.ones(len(some), bool)
    rare[at[dense]] = False
    ids = np.flatnonzero(rare)
    found: list[tuple[float, int, int]] = []
    for these in np.split(ids, np.flatnonzero(np.diff(np.cumsum(df[some[ids]]) // part)) + 1):
        mine = np.zeros(len(some), bool)
        mine[these] = True
        place = np.flatnonzero(mine[col])
        place = place[np.argsort(col[place], kind="stable")]
        for group in np.split(place, np.flatnonzero(np.diff(col[place])) + 1) if len(place) else []:
            a, docs = int(col[group[0]]), np.searchsorted(begin, group, side="right") - 1
            with_it = np.concatenate([col[begin[d] : begin[d + 1]] for d in docs.tolist()])
            n = np.bincount(with_it, minlength=len(some))
            n[a] = 0
            error = np.bincount(with_it, np.repeat(left[docs], size[docs]), len(some))
            z = np.abs(error - n * (alone[some[a]] + alone[some])) / np.sqrt(np.maximum(n, 1))
            z[rare & (np.arange(len(some)) < a)] = 0  # each pair once
            b = np.flatnonzero((n >= least) & (z > limit))
            b = b[np.argsort(-z[b], kind="stable")[:PAIRS]]
            found = sorted([*found, *zip((-z[b]).tolist(), [int(some[a])] * len(b), some[b].tolist())])[:PAIRS]
    return found


def telling_pairs(x: Table, left: np.ndarray, share: float) -> np.ndarray:
    """Numbers of the pairs over whose documents the errors left, less what each of the two has by itself, add up to more than the largest of as many sums of noise."""
    df = x.back(np.ones(x.n))
    least = 5 / (share * (1 - share))  # fewer common documents than this do not make a normal sum
    often = np.argsort(-df, kind="stable")
    some = np.sort(often[df[often] >= least])
    often = often[:PAIRED]
    at = np.full(x.width, -1)
    at[often] = np.arange(len(often))
    has = np.zeros((x.n, len(often)), bool)
    for rows, row, col in x.parts():
        own = at[col]
        has[rows.start + row[own >= 0], own[own >= 0]] = True
    reach = lambda pairs: np.sqrt(2 * np.log(pairs + 2) * left.var())
    limit = reach(len(often) ** 2 / 2)
    own_error = x.back(left) / np.maximum(df, 1)
    found, alone = [], own_error[often].astype(np.float32)
    for done in range(0, len(often), 512):
        n = np.zeros((min(512, len(often) - done), len(often)), np.float32)
        error = np.zeros_like(n)
        for k in range(0, x.n, 2048):
            block = has[k : k + 2048].astype(np.float32)
            n += block[:, done : done + 512].T @ block
            error += (block[:, done : done + 512] * left[k : k + 2048, None].astype(np.float32)).T @ block
        error -= n * (alone[done : done + 512, None] + alone[None])  # what each of the two has by itself
        z = np.abs(error) / np.sqrt(np.maximum(n, 1))
        z[np.arange(len(often))[None] <= done + np.arange(len(n))[:, None]] = 0  # each pair once
        i, j = np.nonzero((n >= least) & (z > limit))
        found = sorted([*found, *zip((-z[i, j]).tolist(), often[i + done].tolist(), often[j].tolist())])[:PAIRS]
    del has
    if len(some) > len(often):
        rare = _rare_pairs(x, left, own_error, some, often[df[often] >= least], df, least, reach(len(some) ** 2 / 2))
        found = [*found, *rare]
    return np.array(sorted({k for _, *pair in found for k in pair}), np.int64)


def choose(x: Table, y: np.ndarray) -> np.ndarray:
    """The numbers that stay: those with a weight, and those of pairs that tell."""
    if not x.width or not 0 < y.sum() < x.n:
        return np.zeros(0, np.int64)
    w, left = sparse_weights(x, y)
    return np.union1d(np.flatnonzero(w), telling_pairs(x, left, y.mean()))


class Machine:
    """bias, and for the kept numbers (sorted) weights and factors."""

    def __init__(self, kept: np.ndarray, bias: float, weight: np.ndarray, factor: np.ndarray) -> None:
        self.kept, self.bias, self.weight, self.factor = kept, bias, weight, factor

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        """Scores of documents given by indices into kept."""
        n = np.fromiter(map(len, rows), np.int64, len(rows))
        col = np.fromiter((c for r in rows for c in r), np.int64, int(n.sum()))
        return 1 / (1 + np.exp(-np.clip(self.raw(np.repeat(np.arange(len(rows)), n), col, len(rows))[0], -30, 30)))

    def raw(self, row: np.ndarray, col: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        s = np.stack([np.bincount(row, self.factor[col, f], n) for f in range(self.factor.shape[1])], 1) if len(col) else np.zeros((n, self.factor.shape[1]))
        q = np.bincount(row, (self.factor[col] ** 2).sum(1), n) if len(col) else np.zeros(n)
        linear = np.bincount(row, self.weight[col], n) if len(col) else np.zeros(n)
        return self.bias + linear + 0.5 * ((s**2).sum(1) - q), s


def fit(kept: np.ndarray, rows: list[list[int]], y: np.ndarray, rounds: int = 250, rate: float = 0.05, ridge: float = 2e-3) -> Machine:
    """Logistic loss, by Adam on the whole sample; rows hold indices into kept."""
    rng = np.random.default_rng(SEED)
    n, k = len(rows), len(kept)
    m = Machine(kept, float(np.log((y.sum() + 1) / (n - y.sum() + 1))), np.zeros(k), rng.normal(0, 0.01, (k, FACTORS)))
    sizes = np.fromiter(map(len, rows), np.int64, n)
    row, col = np.repeat(np.arange(n), sizes), np.fromiter((c for r in rows for c in r), np.int64, int(sizes.sum()))
    share = max(y.mean(), 1e-3)
    cost = np.where(y == 1, 0.5 / share, 0.5 / max(1 - share, 1e-3)) ** 0.5
    cost /= cost.sum()
    moments = [np.zeros(x) for x in (1, k, (k, FACTORS))], [np.zeros(x) for x in (1, k, (k, FACTORS))]
    for t in range(1, rounds + 1):
        raw, s = m.raw(row, col, n)
        g = cost * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y)
        gw = np.bincount(col, g[row], k) + ridge * m.weight / k**0.5
        gv = np.stack([np.bincount(col, g[row] * (s[row, f] - m.factor[col, f]), k) for f in range(FACTORS)], 1) + ridge * m.factor / k**0.5
        for i, (x, dx) in enumerate(((None, np.array([g.sum()])), (m.weight, gw), (m.factor, gv))):
            moments[0][i] = 0.9 * moments[0][i] + 0.1 * dx
            moments[1][i] = 0.999 * moments[1][i] + 0.001 * dx**2
            step = rate * (moments[0][i] / (1 - 0.9**t)) / (np.sqrt(moments[1][i] / (1 - 0.999**t)) + 1e-8)
            if x is None:
                m.bias -= float(step[0])
            else:
                x -= step
    return m


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: int = TERMS) -> Machine:
    """Fit a machine to a sample of the labels that are not held out, in one task."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most SAMPLE rows of two numbers, so the broadcast has a fixed size.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "toxic")
    numbered = rows.mapInArrow(_number, "doc_id long, toxic int, n int, terms binary").groupBy("doc_id").agg(F.min(F.struct("terms", "n", "toxic")).alias("x"))
    numbered = materialise(numbered.select("doc_id", "x.terms", "x.n", "x.toxic", F.xxhash64("doc_id").alias("place")), "labelled")
    sizes = sorted((r.place, r.doc_id, r.n) for r in numbered.select("place", "doc_id", "n").collect())  # SAMPLE rows at most
    fit_in = int(np.searchsorted(np.cumsum([n for _, _, n in sizes]), terms, side="right"))
    got = numbered if fit_in == len(sizes) else numbered.where(F.struct("place", "doc_id") < F.struct(*(F.lit(v).cast("long") for v in sizes[fit_in][:2])))
    n, total = fit_in, sum(n for _, _, n in sizes[:fit_in])
    if not n:
        return Machine(np.zeros(0, np.int64), -30.0, np.zeros(0), np.zeros((0, FACTORS)))
    # One task holds the bounded sample and the fit's arrays; the driver gets the machine alone.
    m = got.select("doc_id", "n", "terms", "toxic").coalesce(1).mapInArrow(_fitting(n, total), "kept array<long>, bias double, weight array<double>, factor array<double>").first()
    return Machine(np.array(m.kept, np.int64), m.bias, np.array(m.weight, float), np.array(m.factor, float).reshape(-1, FACTORS))


def _fitting(n: int, terms: int):
    """(doc_id, n, terms, toxic) of n documents and that many terms, in one partition, to a row of the fitted machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, admitted = _table(batches, n, terms)
        stay = choose(x, y)
        m = fit(admitted[stay], x.rows(stay), y)
        yield pa.RecordBatch.from_pydict({"kept": [m.kept], "bias": [m.bias], "weight": [m.weight], "factor": [m.factor.ravel()]})

    return run


def _table(batches: Iterator[pa.RecordBatch], n: int, terms: int) -> tuple[Table, np.ndarray, np.ndarray]:
    """(doc_id, n, terms, toxic) of n documents and that many terms to the table of admitted numbers, in the order of doc_id, the labels and the admitted numbers."""
    raw, names, size, y, end, k = np.empty(terms, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), 0, 0
    df = np.zeros(BUCKETS, np.int32)
    for doc_id, m, text, toxic in (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)):
        own = np.frombuffer(text, "<i4")
        raw[end : end + m] = own
        df[own] += 1  # a document's numbers are distinct
        names[k], size[k], y[k], end, k = doc_id, m, toxic, end + m, k + 1
    admitted = np.flatnonzero(df >= LEAST)
    at = np.full(BUCKETS, -1, np.int32)
    at[admitted] = np.arange(len(admitted), dtype=np.int32)
    order, begin, kept, end = np.argsort(names, kind="stable"), np.cumsum(size) - size, size.copy(), 0
    col = np.empty(int(df[admitted].sum()), np.int32)
    for i, k in enumerate(order.tolist()):
        own = at[raw[begin[k] : begin[k] + size[k]]]
        own = own[own >= 0]
        col[end : end + len(own)], kept[i], end = own, len(own), end + len(own)
    return Table(col, kept, len(admitted)), y[order], admitted


def _score(machine: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {int(x): i for i, x in enumerate(machine.kept)}
        seen: dict[str, tuple[int, ...]] = {}  # of each word met: its kept terms
        held = 0
        for batch in (part for full in batches for part in slices(full, full.num_columns - 1)):
            rows = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                got = set(WORD.findall((text or "").lower()))
                for w in got.difference(seen):
                    seen[w] = tuple(at[x] for x in numbers(w) if x in at)
                    held += len(w) + 24
                rows.append(sorted({x for w in got for x in seen[w]}))
                if held > REMEMBER:
                    seen, held = {}, 0
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(machine.scores(rows), pa.float64())], names=[*batch.schema.names[:-1], "score"])

    return run


def scores(docs: DataFrame, machine: Machine) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score(machine), "doc_id long, score double")
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, machine: Machine) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns; one pass, nothing is joined."""
    rest = docs.select(whole(docs).alias("doc")).select("doc", "doc.text")
    return rest.mapInArrow(_score(machine), StructType([rest.schema["doc"], StructField("score", DoubleType())])).where(F.col("score") < THRESHOLD).select("doc.*")
