"""Registration of queries with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, text: str = ""):
    """Register a query under its function's name. text: columns that both sides return as strings (dates, nullable numbers)."""
    names = text.split()

    def put(f):
        def run(spark, sf):
            return f(spark, sf).withColumns({n: F.col(n).cast("string") for n in names})

        QUERIES[f.__name__] = run if names else f
        if sql:
            casts = ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)
            ORACLES[f.__name__] = f"SELECT * REPLACE ({casts}) FROM ({sql}) AS q" if names else sql
        return f

    return put
