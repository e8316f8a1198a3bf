"""Connected components of an edge table, in Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.llm.common import counted, materialise


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, label) of every node in edges(a long, b long): label is the smallest node that it reaches.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each
    moves every edge to the smallest neighbour, in O(log^2 n) rounds. A round's edges
    are written to the shared folder. Nodes are partly grouped before each
    shuffle, so a hub costs no task more than its distinct neighbours' minimum.
    Repeated edges and loops count for nothing; no edges give no nodes.
    """
    cur, n = counted(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(small, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        seen = Observation()  # counted as the round is written, without a job of its own
        cur = materialise(star.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("x"), F.sum(F.xxhash64("a", "b") % 1000003).alias("y")), "edges", rows=n)
        if seen.get == before:
            break
        before, n = seen.get, seen.get["n"]
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
