"""The registered functions against the Column functions, on pieces put together at random."""

import random

from pyspark.sql import functions as F

from tessera.functions import sql
from tessera.functions import text as T
from tessera.operators import evals

PIECES = ["①", "②", "③", "④", "(1)", "(2)", "2번 슬롯", "슬롯 3", "(4)", " 충족", "미충족", "부분", "분모에서 제외", "채웠다", "빠졌다", "→", "->", "(a) 담김", "(b) 이름만", "(a) 없음", "(c)  담김", "x" * 199, "abc ", "\n", "é", "12번 슬롯", " "]


def test_rationales(spark):
    rnd = random.Random(4)
    rows = [(i, "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(14))), [rnd.randrange(0, 4) for _ in range(4)]) for i in range(400)] + [(900, None, [1, 1, 1, 1]), (901, " \n", [0, 0, 0, 0])]
    df = spark.createDataFrame(rows, "id int, r string, n array<int>")
    sql.register(spark)
    df.createOrReplaceTempView("rationales")
    named = {r.id: r for r in spark.sql("SELECT id, slot_verdicts(r) AS v, slot_states(r) AS s, element_verdicts(r) AS e, parsed_elements(r, n) AS p FROM rationales").collect()}
    for r in df.select("id", "r", evals.slot_verdicts("r").alias("v"), evals.slot_states("r").alias("s"), evals.element_verdicts("r").alias("e"), evals.parsed_elements("r", "n").alias("p")).collect():
        assert (r.v, r.s, r.e, r.p) == (named[r.id].v, named[r.id].s, named[r.id].e, named[r.id].p), r.r


def test_texts(spark):
    rows = [(0, "<p>A &amp; B</p>\n\n\n\n  c "), (1, "Éin Titel — über viele Wörter, 한국어 제목 und noch mehr davon"), (2, ""), (3, None), (4, "---"), (5, "a" * 60), (6, "x-" * 40), (7, "&#x41;&copy;  b　")]
    df = spark.createDataFrame(rows, "id int, t string")
    sql.register(spark)
    df.createOrReplaceTempView("texts")
    got = {r.id: r for r in spark.sql("SELECT id, strip_html(t) AS h, slug(t, 40) AS s, slug(t, cast(null as int)) AS w, note_body(t, array('[[a|b]]'), array('', 'c#d'), 'src', 'u') AS b FROM texts").collect()}
    body = T.render_body(F.col("t"), F.array(F.lit("[[a|b]]")), F.array(F.lit(""), F.lit("c#d")), F.lit("src"), F.lit("u"))
    for r in df.select("id", T.strip_html(F.col("t")).alias("h"), T.slugify(F.col("t"), 40).alias("s"), T.slugify(F.col("t")).alias("w"), body.alias("b")).collect():
        assert (r.h, r.s, r.w, r.b) == (got[r.id].h, got[r.id].s, got[r.id].w, got[r.id].b), r.id


def test_a_worker_makes_values_of_few_rows_at_a_time(spark):
    """A batch of whole texts is not turned into Python values at once."""
    import pyarrow as pa

    held = []

    class Watched:
        def __init__(self, values):
            self.values = values

        def __len__(self):
            return len(self.values)

        def slice(self, at, n):
            held.append(n)
            return pa.array(self.values[at : at + n])

    got = sql._each(lambda t: t, "string")(Watched([str(i) for i in range(1000)]))
    assert got.to_pylist() == [str(i) for i in range(1000)] and max(held) <= 64 and len(held) > 10
    assert sql._each(sql.strip_html, "string")(pa.array([], pa.string())).type == pa.string()
