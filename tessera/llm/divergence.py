"""Operator 13: divergence audit of sources within a language.

Each language keeps the terms that at least LEAST_DOCS of its documents have.
A group is a (language, source). With V kept terms and N occurrences of them, a term counted c times has the
share p = 1 + floor(1e9 (c + 5) / (N + 5 V)). Two groups differ by the sum over all kept
terms of |p - q|; a group stands out by the terms whose share exceeds the whole language's.

Heavy-light split. Terms of more than LIGHT groups are heavy: tiles of about TILE
terms by blocks of about BLOCK groups are dense numpy arrays, compared row by row. The other terms
are light. If no group had any term, two groups would differ by V |p0 - q0|, p0 being
the share of a term that a group lacks. The dense tiles correct this for the heavy terms that either group's block has;
a group's own light terms correct it against any q0 (from the counts of its distinct shares, by binary search), and the few pairs of a light term's
posting list, at most LIGHT (LIGHT - 1) / 2, correct what both have. All parts are longs and add up exactly.

Work: texts are counted where they are read (whole documents, in parts of PIECE bytes), counts
are summed before the shuffle, and dense tasks hold at most two blocks and one tile. Rows
grow with terms times groups and, as the result has a row for each pair of groups,
with the square of a language's sources.

Nulls and empties: null text, lang and source are ''. A group without kept terms has
all pairs and no term rows; a language without kept terms has pairs of value 0. Repeated rows are documents of their own. Of equal
values the item first in UTF-8 order has the lower rank. An empty table gives an empty result. Extra columns are
ignored. A count or an N + 5 V over 9e15 overflows and is an error.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import materialise

LEAST_DOCS = 30
TOP = 50
#: A term of more groups than this is heavy.
LIGHT = 8
#: Terms of a dense tile and groups of a block, about.
TILE, BLOCK = 2048, 64
#: Bytes of a text that are split at a time, and counts that a task holds before it hands them on.
PIECE, HELD = 4 << 20, 300_000

#: Letters and whatever is not ASCII; A-Z become a-z, all else a space.
_TO = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

COUNTS = "lang string, source string, term string, c long, docs long"


def terms_of(text: bytes):
    """Lists of the terms of a UTF-8 text, as bytes, in order."""
    at = 0
    while at < len(text):
        part = text[at : at + PIECE].translate(_TO)
        if at + PIECE < len(text):
            cut = part.rfind(b" ")
            while cut < 0 and at + len(part) < len(text):  # a term longer than a part
                part += text[at + len(part) : at + len(part) + PIECE].translate(_TO)
                cut = part.rfind(b" ")
            part = part if cut < 0 else part[: cut + 1]
        yield part.split()
        at += len(part)


def _count(batches):
    """(lang, source, term, c, docs) of a partition, summed as far as memory allows; a row with the empty term for each group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    n = 0

    def flush():
        for (lang, source), (c, docs) in held.items():
            terms = [b"", *c]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array([0, *c.values()], pa.int64()), pa.array([0, *(docs[t] for t in c)], pa.int64())], names=["lang", "source", "term", "c", "docs"])

    for batch in batches:
        texts = batch.column(2)
        for i, (lang, source) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            c, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(c)
            seen: set[bytes] = set()
            for part in terms_of(texts[i].as_buffer().to_pybytes()):
                c.update(part)
                seen.update(part)
            docs.update(seen)
            n += len(c) - before
            if n > HELD:
                yield from flush()
                held, n = {}, 0
    yield from flush()


def counts(docs: DataFrame) -> DataFrame:
    """documents to COUNTS: a row for each term of each group, and one with the empty term for each group."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    parts = docs.select(blank("lang"), blank("source"), blank("text")).mapInArrow(_count, COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(1e9 (count + 5) / (total + 5 kept)) in longs, three digits at a time; null without kept terms."""
    all_ = F.nullif(total + 5 * kept, F.lit(0))
    div = lambda a: F.call_function("div", a, all_)
    out, left = F.lit(1).cast("long"), count + 5
    for scale in (10**9, 10**6, 10**3, 1):
        out, left = out + div(left) * scale, left % all_ * 1000
    return out


def audit(docs: DataFrame, least: int = LEAST_DOCS, light: int = LIGHT, tile: int = TILE, block: int = BLOCK, top: int = TOP) -> DataFrame:
    """documents(text, lang, source) to (lang, source, part, item, value, rank)."""
    seen = materialise(counts(docs), "term-counts")
    # A row a kept term of a language.
    kept = materialise(seen.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("c").alias("total"), F.count(F.lit(1)).alias("k")).where(F.col("docs") >= least), "kept-terms")
    # A row a group: its size, its language's sizes, and its block.
    held = materialise(seen.where("term <> ''").join(kept.select("lang", "term", "total", (F.col("k") > light).alias("heavy")), ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"), F.count_if(F.col("k") > light).alias("v_heavy"))
    sizes = held.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = seen.where("term = ''").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    many = seen.where("term = ''").groupBy("lang").agg(F.count(F.lit(1)).alias("_g"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    groups = groups.join(many, "lang").select("lang", "source", zero("n"), zero("v"), zero("lang_n"), zero("v_heavy"), F.ceil(F.col("_g") / block).cast("int").alias("blocks"))
    groups = groups.select("*", F.ceil(F.col("v_heavy") / tile).cast("int").alias("tiles"), F.pmod(F.xxhash64("source"), "blocks").cast("int").alias("block"), F.coalesce(share(F.lit(0).cast("long"), F.col("n"), F.col("v")), F.lit(0)).alias("p0"))
    groups = materialise(groups, "groups")
    shares = held.join(groups, ["lang", "source"]).withColumn("p", share(F.col("c"), F.col("n"), F.col("v")))
    return pair_rows(shares, groups).unionByName(term_rows(shares, top))


def term_rows(shares: DataFrame, top: int = TOP) -> DataFrame:
    """The top terms of each group whose share exceeds the language's."""
    value = F.col("p") - share(F.col("total"), F.col("lang_n"), F.col("v"))
    found = shares.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value")).where("value > 0")
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top)


PAIR = "lang string, a string, b string, value long"


def _unite(parts: list[list]) -> pd.DataFrame:
    return pd.DataFrame(parts, columns=["lang", "a", "b", "value"])


def _light_base(df: pd.DataFrame) -> pd.DataFrame:
    """All pairs of two blocks: v |p0 - q0|, and each group's own light terms against the other's q0. A row a group, with its distinct light shares and how many terms have each."""
    df = df.sort_values("source").reset_index(drop=True)
    p0, v = df.p0.to_numpy(np.int64), df.v.to_numpy(np.int64)
    own = np.zeros((len(df), len(df)), dtype=np.int64)
    for i, (p, m) in enumerate(zip(df.ps, df.ms, strict=True)):
        if p is None or not len(p):
            continue
        p, m = np.asarray(p, dtype=np.int64), np.asarray(m, dtype=np.int64)
        order = np.argsort(p)
        p, m = p[order], m[order]
        cm, cs = np.append(0, np.cumsum(m)), np.append(0, np.cumsum(m * p))
        at = np.searchsorted(p, p0, side="right")
        apart = p0 * cm[at] - cs[at] + cs[-1] - cs[at] - p0 * (cm[-1] - cm[at])
        own[i] = apart - cm[-1] * np.abs(p0[i] - p0)
    value = v[:, None] * np.abs(p0[:, None] - p0) + own + own.T
    lang, low, high, names, place = df.lang.iloc[0], int(df.low.iloc[0]), int(df.high.iloc[0]), df.source.tolist(), df.block.to_numpy()
    return _unite([[lang, names[i], names[j], int(value[i, j])] for i in range(len(df)) for j in range(i + 1, len(df)) if low == high or place[i] != place[j]])


def _dense(df: pd.DataFrame) -> pd.DataFrame:
    """All pairs of two blocks over one tile of heavy terms: how much they differ more than by |p0 - q0| for each. Rows without a term give each group's p0."""
    base = df[df.term.isna()].sort_values("source")
    rest = df[df.term.notna()]
    names, place = base.source.tolist(), base.block.to_numpy()
    rows = pd.Series(range(len(names)), index=names)[rest.source].to_numpy()
    cols, terms = pd.factorize(rest.term)
    p0 = base.p.to_numpy(np.int64)
    full = np.repeat(p0[:, None], len(terms), axis=1)
    full[rows, cols] = rest.p.to_numpy(np.int64)
    lang, same = base.lang.iloc[0], base.low.iloc[0] == base.high.iloc[0]
    out = []
    for i, name in enumerate(names):
        far = np.abs(full[i + 1 :] - full[i]).sum(axis=1) - len(terms) * np.abs(p0[i + 1 :] - p0[i])
        out += [[lang, name, names[i + 1 + j], int(x)] for j, x in enumerate(far) if same or place[i] != place[i + 1 + j]]
    return _unite(out)


def _both_blocks(df: DataFrame) -> DataFrame:
    """A copy of each row for each pair (low, high) of blocks of its language that its own is in."""
    other = df.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.withColumn("low", F.least("block", "_o")).withColumn("high", F.greatest("block", "_o")).drop("_o")


def pair_rows(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """The distance of each group to each other group of its language."""
    # No terms at all, and light terms as if no pair shared one.
    few = shares.where("not heavy")
    levels = few.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m")).groupBy("lang", "source").agg(F.collect_list(F.struct("p", "m")).alias("_x"))  # distinct shares: about the root of a group's words
    one = groups.join(levels, ["lang", "source"], "left").select("lang", "source", "block", "blocks", "p0", "v", F.col("_x.p").alias("ps"), F.col("_x.m").alias("ms"))
    base = _both_blocks(one).groupBy("lang", "low", "high").applyInPandas(_light_base, PAIR)
    # Light terms that both have.
    post = few.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "p0"))).alias("_l"))  # at most LIGHT entries
    both = post.select("lang", F.explode(F.flatten(F.transform("_l", lambda x, i: F.transform(F.slice("_l", i + 2, F.size("_l")), lambda y: F.struct(x.alias("x"), y.alias("y")))))).alias("e"))
    x, y = F.col("e.x"), F.col("e.y")
    fix = F.abs(x.p - y.p) - F.abs(x.p - y.p0) - F.abs(x.p0 - y.p) + F.abs(x.p0 - y.p0)
    both = both.select("lang", x.source.alias("a"), y.source.alias("b"), fix.alias("value")).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    # Heavy terms.
    tiled = shares.where("heavy").select("lang", "source", "block", "blocks", F.pmod(F.xxhash64("term"), "tiles").cast("int").alias("tile"), "term", "p")
    empty = groups.where("tiles > 0").select("lang", "source", "block", "blocks", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"))
    dense = _both_blocks(tiled.unionByName(empty)).groupBy("lang", "low", "high", "tile").applyInPandas(_dense, PAIR)
    value = base.unionByName(both).unionByName(dense).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ends = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    rows = value.select("lang", "value", ends.alias("e")).select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.withColumn("rank", rank)


def query(docs: DataFrame) -> DataFrame:
    return audit(docs)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER} AS t FROM documents),
x AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM x GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM x JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c, CAST(1 + (1000000000 * (coalesce(c.c, 0) + 5))::HUGEINT // (g.n + 5 * v.v)::HUGEINT AS BIGINT) AS p,
             CAST(1 + (1000000000 * (kept.total + 5))::HUGEINT // (v.n + 5 * v.v)::HUGEINT AS BIGINT) AS q
      FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
both_ AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN both_ ON both_.lang = a.lang AND both_.source = a.source AND both_.item = b.source),
found AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
