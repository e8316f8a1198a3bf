import math
import os
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import mixing, packing, perspectives, pivots, secrets, simhash, toxicity
from tessera.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    clean = lambda x: None if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x) else round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    return sorted(repr(tuple(map(clean, r))) for r in df.itertuples(index=False, name=None))


def twin(name, **tables):
    con = duckdb.connect()
    for k, v in tables.items():
        con.register(k, v)
    return con.sql(ORACLES[name]).df()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twins(spark, name):
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(con.sql(ORACLES[name]).df())


def test_mixing(spark, odd_docs, no_docs):
    got = mixing.query(odd_docs).toPandas()
    assert rows(got) == rows(twin("op9_curriculum_mix", documents=pd.DataFrame([(r.doc_id, r.text, r.source) for r in odd_docs.collect()], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})))
    assert len(got) == 13 and (got.taken <= 3 * got["size"]).all()
    assert rows(mixing.query(odd_docs.repartition(5)).toPandas()) == rows(got)
    assert mixing.query(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0
    assert mixing.mix(odd_docs).columns == odd_docs.columns


def fill(sizes):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        rest = {s: left * weight[s] / sum(weight[x] for x in sizes if x not in full) for s in sizes if s not in full}
        over = {s for s, t in rest.items() if t > 3 * sizes[s] + 1e-9}
        if not over:
            return rest | {s: 3.0 * sizes[s] for s in full}
        full |= over


def test_targets_and_demand(spark):
    rnd = random.Random(1)
    for _ in range(3):
        sizes = {f"s{i}": rnd.choice([0, 1, 10, 300, 4000]) for i in range(rnd.randint(1, 9))} | {None: 50}
        got = {r.source: r for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        want = fill(sizes)
        assert all(abs(got[s].target - want[s]) < 1e-6 * (1 + want[s]) for s in sizes)
    docs = spark.createDataFrame([(i, "w " * rnd.randint(1, 30), f"s{min(3, int(rnd.expovariate(1)))}") for i in range(600)], "doc_id long, text string, source string")
    t = mixing.taken(docs).toPandas()
    for _, g in t.groupby("source"):
        assert g.taken.sum() == round(g.target.iloc[0])
    order = [r.doc_id for r in mixing.mix(docs).collect()]
    n = pd.Series(order).value_counts()
    assert n.max() <= 3 and order == [r.doc_id for r in mixing.mix(docs.repartition(3)).collect()]
    x = mixing.position(F.lit(3.0), F.lit(10.0), F.lit(True))
    y = spark.range(1).select(x.alias("x")).first().x
    assert abs(0.5 * y + 0.5 * y * y - 0.3) < 1e-5


def test_mix_takes_what_the_query_says(spark):
    """Repeated rows, and rows that tie in all but another column, are documents of their own; texts hold just the words taken."""
    equal = [(1, "a b c d", "s", 1)] * 6 + [(2, "e f  g h", "s", 1), (3, "x\ty", "t", 1), (3, "x\ty", "t", 2), (4, None, "t", 1), (5, "p q r s t u v w x y z " * 40, None, 1)]
    docs = spark.createDataFrame(equal, "doc_id long, text string, source string, row int")
    want = mixing.taken(docs).toPandas()
    got = mixing.mix(docs).withColumn("words", mixing.words(F.col("text"))).toPandas()
    assert got.groupby("doc_id").words.sum().to_dict() == {k: v for k, v in want.groupby("doc_id").taken.sum().to_dict().items() if v}
    assert got.columns.tolist() == ["doc_id", "text", "source", "row", "words"]
    full = {1: "a b c d", 2: "e f  g h", 3: "x\ty", 5: equal[-1][1]}
    assert all(full[i].startswith(t) and not t.endswith(" " * (len(t) < len(full[i]))) or t == full[i] for i, t in zip(got.doc_id, got.text))
    assert (got.text != got.doc_id.map(full)).sum() <= 3  # one a source at most is cut
    assert sorted(map(tuple, got.astype(str).to_numpy())) == sorted(map(tuple, mixing.mix(docs.repartition(3)).withColumn("words", mixing.words(F.col("text"))).toPandas().astype(str).to_numpy()))


def test_perspectives(spark):
    schema = "conv_id long, turn long, role string, text string, part string, own int"
    data = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", "yo"), (1, 2, "bob", "yo"), (1, 2, "ann", "tie"), (1, None, "bob", None), (2, 0, "system", "alone"), (None, 0, None, "x"), (3, 5, "a|b", "")]
    data += [(4, i, f"p{i % 3}", f"t{i}") for i in range(700)]
    df = spark.createDataFrame([(*r, "z", 1) for r in data], schema)
    got = perspectives.rotate(df).toPandas()
    assert rows(got) == rows(twin("op8_perspectives", conversations=pd.DataFrame(data, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})))
    ann = got[(got.conv_id == 1) & (got.speaker == "ann")].iloc[0]
    said = [ann.text[int(a) : int(b)] for a, b in (m.split(":") for m in ann["mask"].split(","))]
    assert said == ["hi < |end|><|end|>\n", "tie<|end|>\n"] and "<|user name=bob|>\nyo" in ann.text and "<|system|>\nbe kind" in ann.text
    assert set(got[got.conv_id == 1].speaker) == {"ann", "bob"} and 2 not in set(got.conv_id)
    long = got[(got.conv_id == 4) & (got.speaker == "p0")].sort_values("part")
    assert long.n_turns.tolist() == [128] * 5 + [60] and re.findall(r"t(\d+)<", "".join(long.text)) == [str(i) for i in range(700)]
    assert perspectives.rotate(df.limit(0)).count() == 0


def brute(data, k, every):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in data if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i is not None and i % every == 0:
            s = sorted((-sum(x * y for x, y in zip(q, v)), j if j is not None else math.inf, j) for b, (j, v) in enumerate(ok) if a != b)[:k]
            out += [(i, n + 1, j, -s_) for n, (s_, _, j) in enumerate(s)]
    return sorted(map(repr, out))


def test_top_k(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.normal(0, 0.3, 12).astype(np.float32).tolist()) for i in range(400)]
    data += [(500, data[0][1]), (501, data[0][1]), (500, data[0][1]), (None, data[7][1]), (600, None), (601, [None] * 12), (602, [math.nan] * 12), (603, [math.inf] * 12), (650, [0.5, 0.25]), (700, [0.0] * 12), (701, [])]
    df = spark.createDataFrame([(*r, 1, "x") for r in data], "vec_id long, embedding array<float>, label int, rid string").repartition(5)
    for k in (5, 1, 1000):
        got = sorted(repr((r.query_id, r["rank"], r.vec_id, r.score)) for r in pivots.top_k(df, k).collect())
        assert got == brute(data, k, 50)
    assert pivots.top_k(df.limit(0)).count() == 0 and pivots.top_k(df.where("vec_id = 7")).count() == 0


def blocks_of(x, p, size=200):
    near = np.argsort(p.nearest(x), kind="stable")
    return [pivots.Block(near[k : k + size], near[k : k + size], x[near[k : k + size]], p.table(x[near[k : k + size]])) for k in range(0, len(x), size)]


def share_evaluated(x, asked, chosen, k=5):
    """Of all pairs, after a comparison with brute force; and of blocks of clusters."""
    p = pivots.Pivots(chosen)
    found, done = pivots.search(pivots.Block(asked, asked, x[asked], p.table(x[asked])), blocks_of(x, p), k)
    for n, q in enumerate(asked.tolist()):
        s = x @ x[q]
        assert [(j, v) for i, j, _, v in found if i == n] == [(j, -v) for v, j in sorted((-s[j], j) for j in range(len(x)) if j != q)[:k]]
    return done / (len(asked) * len(x))


def test_bounds_leave_candidates_out():
    rng = np.random.default_rng(2)
    clusters = np.repeat(rng.normal(0, 100, (20, 16)), 100, 0).astype(np.int64) + rng.integers(-3, 4, (2000, 16))
    assert share_evaluated(clusters, np.arange(0, 2000, 50), clusters[::200]) < 0.15
    real = pd.read_parquet(os.path.join(os.path.dirname(SF.rstrip("/")), "sf0.1", "embeddings.parquet"))
    x = np.floor(256 * np.stack(real[real.embedding.notna()].embedding.to_numpy()).astype(float)).astype(np.int64)
    asked = np.arange(0, len(x), 50)
    assert share_evaluated(x, asked, x[1 : 1 + int(pivots.SHARE * x.shape[1])]) < 0.1  # no clusters: seven eighths of the width are needed
    few = pivots.Pivots(x[1:17])
    assert (pivots._safe(few.table(x[asked]) @ few.table(x).T) >= x[asked] @ x.T).all()  # a bound with any pivots


def toxic_docs(rnd, n):
    """Insults are toxic, and so is a harmless word beside a group's name; neither alone is."""
    words = [f"w{i}" for i in range(300)]
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in words]
    out = []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        kind = i % 6
        text += {0: ["idiot"], 1: ["vermin", "groupname"], 2: ["vermin"], 3: ["groupname"]}.get(kind, [])
        rnd.shuffle(text)
        out.append((i, " ".join(text), int(kind < 2)))
    return out


def test_toxicity(spark, odd_docs, no_docs):
    data = toxic_docs(random.Random(3), 3000)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in data] + [(None, 1), (7, None), (9999, 1)], "doc_id long, toxic int")
    machine = toxicity.learn(docs, labels)
    got = toxicity.scores(docs, machine).toPandas().merge(pd.DataFrame(data, columns=["doc_id", "text", "toxic"]))
    held = got[got.held_out]
    assert 500 < len(held) < 1000 and (held.predicted == held.toxic).mean() > 0.97
    linear = toxicity.Machine(machine.kept, machine.bias, machine.weight, machine.factor * 0)
    plain = toxicity.scores(docs, linear).toPandas().merge(pd.DataFrame(data, columns=["doc_id", "text", "toxic"]))
    assert (plain.predicted == plain.toxic).mean() < (got.predicted == got.toxic).mean()  # the pairs matter
    again = toxicity.scores(docs.repartition(5), toxicity.learn(docs.repartition(3), labels)).toPandas()
    assert np.allclose(again.sort_values("doc_id").score, got.sort_values("doc_id").score)
    odd = toxicity.scores(odd_docs, machine).toPandas()
    assert len(odd) == 13 and odd.score.between(0, 1).all()
    assert toxicity.scores(no_docs, machine).count() == 0
    kept = toxicity.keep_clean(odd_docs, machine)
    assert kept.columns == odd_docs.columns and kept.count() == 13
    none = toxicity.learn(docs, labels.limit(0))
    assert toxicity.scores(odd_docs, none).agg(F.max("score")).first()[0] < 0.01
    sure = toxicity.scores(docs.limit(10), toxicity.learn(docs, labels.where("doc_id = 4")))  # one label, one class
    assert sure.count() == 10


def test_the_driver_gets_the_machine_alone(spark, monkeypatch):
    """Neither the sample nor the fit's arrays are held by the driver."""
    docs = spark.createDataFrame([(i, "rude words" if i % 3 == 0 else "kind words") for i in range(120)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))

    def in_a_task(f):
        def run(*args):
            from pyspark import TaskContext

            assert TaskContext.get() is not None
            return f(*args)

        return run

    for name in ("_table", "choose", "fit"):
        monkeypatch.setattr(toxicity, name, in_a_task(getattr(toxicity, name)))
    assert len(toxicity.learn(docs, labels).kept)


def test_pairs_of_neutral_words_are_learnt():
    """Each of four words is as frequent among toxic texts as among others; which two stand together decides."""
    rng = np.random.default_rng(6)
    y = (np.arange(1500) % 3 == 0).astype(float)
    pairs = {1: [(0, 1), (2, 3)], 0: [(0, 2), (0, 3), (1, 2), (1, 3)]}
    rows = [np.unique([*pairs[int(t)][rng.integers(len(pairs[int(t)]))], *rng.integers(4, 900, 30)]) for t in y]
    x = toxicity.Table(np.concatenate(rows), np.array([len(r) for r in rows]), 900, part=5000)
    assert np.allclose(x.times(np.arange(900.0)), [r.sum() for r in rows])
    assert np.allclose(x.back(y), np.bincount(np.concatenate(rows), np.repeat(y, [len(r) for r in rows]), 900))
    stay = toxicity.choose(x, y)
    assert {0, 1, 2, 3} <= set(stay.tolist()) and len(stay) < 60
    inside = [np.searchsorted(stay, np.intersect1d(r, stay)).tolist() for r in rows]
    assert x.rows(stay) == inside
    machine = toxicity.fit(stay, inside, y)
    assert ((machine.scores(inside) >= toxicity.THRESHOLD) == (y == 1)).mean() > 0.97
    # Nothing stands out in noise.
    assert len(toxicity.choose(x, rng.permutation(y))) < 30


def test_pairs_of_rare_words_are_found(monkeypatch):
    """Both members of a telling pair lie outside the numbers that are paired as dense blocks; sparse and dense sums find the same."""
    rng = np.random.default_rng(1)
    docs, y = [], np.zeros(6000)
    for i in range(len(y)):
        a, b = rng.random(2) < 0.12
        docs.append(np.unique([*rng.choice(40, 12, replace=False), *rng.integers(40, 440, 6), *([500] * bool(a)), *([501] * bool(b))]))
        y[i] = (a and b) or rng.random() < 0.1
    x = toxicity.Table(np.concatenate(docs).astype(np.int32), np.array([len(d) for d in docs]), 600)
    left = y - y.mean()
    whole = toxicity.telling_pairs(x, left, y.mean())
    assert whole.tolist() == [500, 501]
    for paired in (32, 1):
        monkeypatch.setattr(toxicity, "PAIRED", paired)
        assert toxicity.telling_pairs(x, left, y.mean()).tolist() == [500, 501]


def test_scores_are_those_of_all_pairs():
    rng = np.random.default_rng(7)
    m = toxicity.Machine(np.arange(50), 0.3, rng.normal(size=50), rng.normal(size=(50, toxicity.FACTORS)))
    rows = [[], [4], *(rng.choice(50, n, replace=False).tolist() for n in (2, 9, 50))]
    want = [0.3 + sum(m.weight[i] for i in r) + sum(float(m.factor[i] @ m.factor[j]) for i in r for j in r if i < j) for r in rows]
    assert np.allclose(m.scores(rows), 1 / (1 + np.exp(-np.clip(want, -30, 30))))


def test_the_sample_is_bounded(spark):
    data = toxic_docs(random.Random(8), 400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + [(0, "idiot " + data[0][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in data], "doc_id long, toxic int")
    few = toxicity.learn(docs, labels, terms=9000)
    assert len(few.kept) and few.kept.tolist() == toxicity.learn(docs.repartition(4), labels, terms=9000).kept.tolist()
    assert toxicity.learn(docs, labels, sample=0).bias == -30


def test_labels_of_held_out_rows_change_nothing(spark):
    data = toxic_docs(random.Random(4), 600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in data], "doc_id long, toxic int")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.scores(docs, toxicity.learn(docs, x)).orderBy("doc_id").toPandas() for x in (labels, flipped))
    assert a.score.tolist() == b.score.tolist()


def test_pipeline(spark, odd_docs, no_docs, tmp_path):
    toxic = toxic_docs(random.Random(5), 900)
    docs = spark.createDataFrame([(3000 + i, t, "en", f"s{i % 3}", len(t)) for i, t, _ in toxic], "doc_id long, text string, lang string, source string, n_chars long")
    extra = spark.createDataFrame([(2000, toxic[5][1], "en", "s1", 5), (2001, 'token = "abcdefgh12345678"', "en", "s2", 5)], docs.schema)
    docs.unionByName(extra).unionByName(odd_docs.select(*docs.columns)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3000 + i, x) for i, _, x in toxic], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    cur, sizes = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    names = cur.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, cur, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        out = spark.read.parquet(f"{tmp_path}/out{k}")
        assert name == corpus_pipeline.STAGES[-1][0] or out.columns == names
        if k == 0:
            machine = toxicity.learn(cur, spark.read.parquet(f"{tmp_path}/labels.parquet"))
            bad = {r.doc_id for r in toxicity.scores(cur, machine).where("predicted = 1").collect()}
            assert bad and {r.doc_id for r in cur.collect()} - {r.doc_id for r in out.collect()} == bad
        if k == 1:
            classes = simhash.near_duplicates(cur).select("component_id", "fingerprint").toPandas()
            assert out.count() <= cur.count() - 2 and {r.doc_id for r in out.where("doc_id in (3005, 2000)").collect()} == {2000}
            assert out.count() >= classes.component_id.nunique()
        if k == 2:
            assert out.count() == cur.count() and out.where("text like '%[SECRET]%'").count() == 2
            assert secrets.scan(out).agg(F.sum("n_assign")).first()[0] == 0
        if k == 3:
            want = mixing.taken(cur).agg(F.sum("taken")).first()[0]
            got = out.select(mixing.words(F.col("text")).alias("n")).agg(F.sum("n")).first()[0]
            assert got == want
        if k == 4:
            assert out.select("doc_id").distinct().count() == cur.select("doc_id").distinct().count()
        sizes.append(out.count())
        cur = out
    again = corpus_pipeline.run(spark, str(tmp_path))
    assert again.agg(F.sum("length")).first()[0] == cur.agg(F.sum("length")).first()[0]
    empty = no_docs.select(*names)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
    assert packing.END_ID == 1 and sizes[0] < 913
