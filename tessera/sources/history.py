"""Run reports and what the next run reads from them: newest-first lookups and high-water marks in two phases
(S-17, S-30, L-08, W-09, W-11, J-19, T-02, T-03).

A report is one JSON row in the folder run=<id> below the history's path; ids sort by time. It counts once
Spark's committer has marked it complete.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import KeyedTable, _fs
from tessera.vocab import MAX_LOOKBACK_DAYS

REPORT = (
    "run_id string, started_at string, finished_at string, sources map<string,map<string,bigint>>, "
    "fetch map<string,struct<status:string,detail:string,feed_kind:string,depth_hours:double,silent:struct<newest:string,age_days:bigint,max_silence_days:bigint>>>, "
    "window map<string,struct<today:string,cutoff:string,span_days:int,anchor:string,capped:boolean,carry_cutoff:string,window_drained:boolean,drained:boolean>>, "
    "backlog map<string,struct<head:array<string>,gate:array<string>,extraction:array<string>>>, load map<string,bigint>, stale array<string>, breaker_tripped array<string>, "
    "extracted_ids map<string,array<string>>, quality map<string,double>, error string, failures bigint, produced bigint, healthy bigint, exit_code int"
)
MARKS = "source string, drained_on date, carry date, run_id string"


def write_reports(reports: DataFrame, path: str) -> None:
    """Reports, a row each, into their folders, which are marked complete once all are written."""
    spark = reports.sparkSession
    reports.withColumn("run", F.col("run_id")).repartition("run").write.mode("append").partitionBy("run").json(path)
    _, fs = _fs(spark, path)
    for r in reports.select("run_id").distinct().collect():  # a name a run
        fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/run={r.run_id}/_SUCCESS"), True).close()


def write_report(report: DataFrame, path: str, run_id: str) -> None:
    """One report; a second write of the same run replaces it."""
    report.coalesce(1).write.mode("overwrite").json(f"{path}/run={run_id}")


def run_ids(spark: SparkSession, path: str) -> list[str]:
    """Complete reports, newest first. Only names are listed."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    jvm = spark.sparkContext._jvm
    found = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("run=")]
    return sorted((x.getName()[4:] for x in found if fs.exists(jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS"))), reverse=True)


def read_runs(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    """These reports; a broken one is left out."""
    if not ids:
        return spark.createDataFrame([], REPORT)
    return spark.read.schema(REPORT).option("mode", "PERMISSIVE").json([f"{path}/run={i}" for i in ids]).where("run_id is not null")


def newest_first(spark: SparkSession, path: str, step: int = 8, most: int | None = None) -> Iterator[tuple[int, DataFrame]]:
    """Slices of step reports (their number, their rows), going back in time, at most most reports."""
    ids = run_ids(spark, path)[:most]
    for at in range(0, len(ids), step):
        part = ids[at : at + step]
        yield len(part), read_runs(spark, path, part)


def entries(reports: DataFrame, field: str) -> DataFrame:
    """(run_id, source, value) of a map by source, without null values."""
    return reports.select("run_id", F.explode(field).alias("source", "value")).where("value is not null")


@dataclass(frozen=True)
class Found:
    rows: DataFrame
    reports_read: int


def latest(spark: SparkSession, path: str, field: str, sources: list[str], step: int = 8, most: int | None = None, value: Callable[[Column], Column] | None = None) -> Found:
    """(source, run_id, value): each source's newest value that is not null.

    Goes back slice by slice and stops once every source (configuration, so a bounded list) has one, or after
    most reports. The driver holds the name of a run for each source; values stay in the table. value: an
    expression on the entry, to look for a part of it.
    """
    open_, where, read = set(sources), {}, 0
    shaped = lambda df: entries(df, field).withColumn("value", value(F.col("value")) if value else F.col("value")).where("value is not null")
    for n, reports in newest_first(spark, path, step, most):
        if not open_:
            break
        read += n
        hits = shaped(reports).where(F.col("source").isin(*open_)).groupBy("source").agg(F.max("run_id").alias("run_id")).collect()
        where |= {r.source: r.run_id for r in hits}
        open_ -= set(where)
    pairs = spark.createDataFrame(list(where.items()), "source string, run_id string")
    return Found(shaped(read_runs(spark, path, sorted(set(where.values())))).join(F.broadcast(pairs), ["source", "run_id"]), read)  # a row a configured source


def windows(spark: SparkSession, path: str, sources: list[str], today: Column, step: int = 8, cap: int = MAX_LOOKBACK_DAYS) -> Found:
    """(source, drained_on, carry, seen) of each source with a report, going back only until its last drained run, or a cutoff past the cap, is met."""
    from tessera.operators import flow

    floor = F.date_sub(today, cap)
    open_, rows, read = set(sources), None, 0
    for n, reports in newest_first(spark, path, step):
        if not open_:
            break
        read += n
        got = entries(reports, "window").where(F.col("source").isin(*sources)).select(
            "source", "run_id", F.to_date("value.today").alias("day"), F.to_date("value.cutoff").alias("cutoff"), F.coalesce("value.window_drained", "value.drained", F.lit(False)).alias("drained"))
        rows = got if rows is None else rows.unionByName(got)
        settled = got.where(F.col("drained") | (F.col("cutoff") < floor)).select("source").distinct().collect()
        open_ -= {r.source for r in settled}
    if rows is None:
        return Found(spark.createDataFrame([], "source string, drained_on date, carry date, seen boolean"), 0)
    found = flow.window_history(rows.withColumn("day", F.struct("day", "run_id")), today, ["source"], cap=cap)
    return Found(found.select("source", F.col("drained_on.day").alias("drained_on"), "carry", F.lit(True).alias("seen")), read)


def drained(tally: Column) -> Column:
    """struct(window_drained, drained) from a source's tallies (a map): nothing waits for the gate, nor for extraction."""
    n = lambda k: F.coalesce(F.try_element_at(tally, F.lit(k)), F.lit(0))
    gate = (n("deferred_gate") == 0) & (n("undated_deferred") == 0)
    return F.struct(gate.alias("window_drained"), (gate & (n("deferred_extraction") == 0)).alias("drained"))


class Marks:
    """High-water marks of the sources, committed in two phases.

    Phase 1: the run's report, with its tallies and windows, is complete in the history. Phase 2: settle() moves the marks of
    sources that the report shows as drained, and only those; the others keep their mark and remember the earliest
    cutoff that is still open. A driver lost between the phases leaves the report: the next settle() applies it. Each
    report is applied once, in order, as the table remembers the last one.
    """

    def __init__(self, spark: SparkSession, history: str, path: str) -> None:
        self.spark, self.history = spark, history
        self.table = KeyedTable(spark, path, "source", MARKS)

    def applied(self) -> str:
        return self.table.read().agg(F.max("run_id")).first()[0] or ""

    def settle(self) -> int:
        """Apply the reports since the last one applied; how many there were."""
        last = self.applied()
        new = sorted(i for i in run_ids(self.spark, self.history) if i > last)
        if not new:
            return 0
        rows = entries(read_runs(self.spark, self.history, new), "window").select(
            "source", "run_id", F.to_date("value.today").alias("day"), F.to_date("value.cutoff").alias("cutoff"), F.coalesce("value.window_drained", "value.drained", F.lit(False)).alias("ok"))
        top = rows.groupBy("source").agg(F.max(F.when(F.col("ok"), F.struct("run_id", "day"))).alias("d"))
        after = rows.join(top, "source").where(~F.col("ok") & (F.col("d").isNull() | (F.col("run_id") > F.col("d.run_id")))).groupBy("source").agg(F.min("cutoff").alias("c"))
        old = self.table.read().select("source", F.col("drained_on").alias("_d"), F.col("carry").alias("_c"))
        now = top.join(after, "source", "left").join(old, "source", "full")
        moved = F.col("d").isNotNull()
        self.table.overwrite(now.select("source", F.when(moved, F.col("d.day")).otherwise(F.col("_d")).alias("drained_on"), F.when(moved, F.col("c")).otherwise(F.least("c", "_c")).alias("carry"), F.lit(new[-1]).alias("run_id")))
        return len(new)
