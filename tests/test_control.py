"""Literal cases of the control plane."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import control as C


def test_prompt_sections():
    assert C.load_prompt("<!-- x -->\n# System\n s \n# User\nu {{a}}\n") == ("s", "u {{a}}")
    for bad in ("# System\n", "# User\n# System\n"):
        with pytest.raises(ValueError):
            C.load_prompt(bad)
    assert C.vocabulary_block(("a", "b")) == "- `a`\n- `b`"


def test_dates(spark):
    df = spark.createDataFrame([("20260829-x",)], "i string")
    assert df.select(C.published_of(F.col("i"))).first()[0] == dt.date(2026, 8, 29)
    with pytest.raises(Exception, match="no date in"):
        spark.createDataFrame([("20261399-x",)], "i string").select(C.published_of(F.col("i"))).collect()
    now = F.lit("2024-01-01").cast("timestamp")
    got = spark.range(1).select(C.lenient_moment(F.lit("2024-05-06 01:02:03"), now).alias("a"), C.lenient_moment(F.lit("bad"), now).alias("b")).first()
    assert (got.a.month, got.b.month) == (5, 1)


def test_source_lookup(spark):
    sources = spark.createDataFrame([("a", "https://feeds.h.com/x"), ("b", "https://k.org/1"), ("c", "https://k.org/2")], "name string, url string")
    item = lambda u: spark.createDataFrame([("i", u)], "item_id string, url string")
    assert C.source_names(item("https://www.h.com/p"), sources).first().source_name == "a"
    for u in ("https://k.org/p", "https://other.net/p"):
        with pytest.raises(Exception, match="no single source"):
            C.source_names(item(u), sources).collect()


def test_predictions(spark, tmp_path):
    (tmp_path / "p").write_text('{"item_id": "a", "x": 1}\n\n{"item_id": "b", "x": 2}\n{"item_id": "a", "x": 3}\n')
    got = {r.item_id: r.x for r in C.read_predictions(spark, str(tmp_path / "p"), "item_id string, x int").collect()}
    assert got == {"a": 3, "b": 2}
    (tmp_path / "q").write_text('{"item_id": "a", "x": 1}\nbad\n')
    with pytest.raises(Exception, match="bad line 2"):
        C.read_predictions(spark, str(tmp_path / "q"), "item_id string, x int").collect()


def test_status(spark):
    run = spark.createDataFrame([("t", 3, "partial", 36, None)], "last_run_at string, exit_code int, outcome string, absent_after_hours int, approval_expires string")
    alerts = spark.createDataFrame([(0, "critical", "breaker", None, "d", 2)], "ord int, severity string, kind string, source string, detail string, consecutive int")
    lines = [r.line for r in C.status_lines(run, alerts).collect()]
    assert lines[1] == "exit_code=3" and lines[-2:] == ["---", "[critical] breaker — d (2)"]
