import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import secrets as S

KEY = "".join(f"[{c}{c.upper()}]" for c in "password"), "".join(f"[{c}{c.upper()}]" for c in "passwd"), "".join(f"[{c}{c.upper()}]" for c in "secret"), "".join(f"[{c}{c.upper()}]" for c in "token"), "[aA][pP][iI]_?[kK][eE][yY]"
ASSIGN = re.compile(rf"""({"|".join(KEY)})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in sorted(out))


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


PIECE = st.sampled_from(["token", "SECRET", "api_key", "apikey", "passwd", "=", ":", " ", "'", '"', "abc", "abcdef12", "AKIA", "ABCDEFGH12345678", "0123456789abcdef0123456789", "é", "😀", "\n", "-", "x.y"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(PIECE, max_size=14).map("".join), min_size=20, max_size=60))
def test_base_spans(spark, texts):
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for r in S.scan(df).collect():
        assert r.base_sha256 == sha(base(texts[r.doc_id])), texts[r.doc_id]


def test_ownership(spark):
    live, shown = "Zx9" + "aB3" * 11, "Qw8" + "cD4" * 11
    rows = [(1, f"k {live}", "a"), (2, f"k {live}", "b")] + [(10 + i, f"k {shown} end", f"s{i}") for i in range(5)] + [(99, 'password: "hunter22"', "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in S.scan(df).collect()}
    assert got[1].spans == f"opaque:2:{2 + len(live)}" and (got[1].live, got[1].examples) == (1, 0)
    assert got[10].spans == "" and (got[10].live, got[10].examples) == (0, 1)
    assert got[99].n_assign == 1
    clean = {r.doc_id: r for r in S.redact(df.withColumn("n_chars", df.doc_id)).collect()}
    assert clean[1].text == "k [SECRET]" and clean[10].text == f"k {shown} end" and clean[99].text == '[SECRET]"' and clean[1].n_chars == 10


def test_odd_rows(spark, odd_docs, no_docs):
    got = S.scan(odd_docs).collect()
    assert len(got) == 13 and sum(r.n_assign for r in got) == 1
    assert S.scan(no_docs).count() == 0
    out = S.redact(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == 13 and out.where("text like '%[SECRET]%'").count() == 1
    assert S.redact(no_docs).count() == 0


def test_many_spans_in_one_text(spark):
    t = "token=abcdefg " * 3000
    r = S.scan(spark.createDataFrame([(1, t, "s")], "doc_id long, text string, source string")).first()
    assert r.n_assign == 3000 and r.base_sha256 == sha(base(t))
