"""Every registered query outside the optional subpackage runs, and equals its DuckDB twin."""

import os

import duckdb
import pandas as pd
import pytest

from tessera.plans.catalogue import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.sql(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
    return c


def rows(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)].astype(object)
    clean = lambda x: None if x is None or (isinstance(x, float) and x != x) or x is pd.NaT else round(float(x), 9) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    return sorted(repr(tuple(map(clean, r))) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        want = con.sql(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)


@pytest.mark.parametrize("source, n", [("'s' || k % 1100", 1100), ("CASE WHEN k % 7 <> 3 THEN nullif('s' || k % 5, 's4') ELSE '' END", 6)], ids=["over a thousand", "null and empty"])
def test_the_run_report_has_a_row_for_every_source(spark, tmp_path, source, n):
    db = duckdb.connect()
    db.sql(f"CREATE TABLE documents AS SELECT k AS doc_id, repeat('x', CAST(k * 13 % 97 AS INTEGER)) AS text, {source} AS source FROM range(2200) AS r(k)")
    db.sql(f"COPY documents TO '{tmp_path}/documents.parquet'")
    got, want = QUERIES["run_report"](spark, str(tmp_path)).toPandas(), db.sql(ORACLES["run_report"]).df()
    assert len(got) == n and got["collected"].sum() == 2200
    assert rows(got) == rows(want)
