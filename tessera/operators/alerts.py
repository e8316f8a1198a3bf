"""Alerts across runs (P-22, W-07, W-14, J-20, J-21, A-26, F-43, L-04, O-09, T-08, T-09, B3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.sources.tables import KeyedTable
from tessera.vocab import CLOSED_KEEP, RUN_INTERVAL_HOURS, SEVERITIES

DEPTH_KINDS = ("source_error", "env_not_ready", "breaker")


def severity(kind: Column, consecutive: Column, slack: Column) -> Column:
    """Level of an alert; slack: hours left before items are lost, null if unknown. The first rule that applies."""
    repeated = F.when((consecutive >= 2) | (kind == "breaker"), "warning").otherwise("info")
    return (F.when(kind.isin("preflight_mismatch", "window_capped", "run_error"), "critical")
            .when(kind.isin(*DEPTH_KINDS) & slack.isNotNull(), F.when(slack <= 0, "critical").otherwise(repeated))
            .when(kind == "env_not_ready", F.when(consecutive >= 2, "critical").otherwise("warning"))
            .when(kind.isin("source_error", "breaker"), F.when(consecutive >= 3, "critical").otherwise(repeated))
            .when(kind == "not_drained", F.when(consecutive >= 2, "warning").otherwise("info"))
            .when(kind.isin("stale_feed", "quarantined", "evicted", "feed_rollover"), "warning").otherwise("info"))


def rank(level: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), level)


def key_of(kind: Column, source: Column) -> Column:
    return F.concat(kind, F.lit("|"), F.coalesce(F.nullif(source, F.lit("")), F.lit("-")))


def streaks(events: DataFrame, evaluated: DataFrame, run: str = "run") -> DataFrame:
    """events(run, kind, source, slack) and evaluated(run, kind) to the alert's state after each event.

    Of a kind, only evaluated runs count: an evaluated run without the event closes the alert, any other run neither closes
    nor extends it. So an event starts a new streak if the kind was evaluated between it and the key's event before.
    """
    once = events.groupBy(run, "kind", "source").agg(F.min("slack").alias("slack")).withColumn("key", key_of(F.col("kind"), F.col("source")))
    # A calendar of runs and kinds, a row a run and kind: evaluated runs up to each.
    calendar = evaluated.select("kind", run, F.lit(1).alias("_e")).unionByName(once.select("kind", run, F.lit(0).alias("_e"))).groupBy("kind", run).agg(F.max("_e").alias("_e"))
    calendar = calendar.withColumn("_upto", F.sum("_e").over(W.partitionBy("kind").orderBy(run)))
    marked = once.join(calendar, ["kind", run])
    by = W.partitionBy("key").orderBy(run)
    between = F.col("_upto") - F.col("_e") - F.lag("_upto").over(by)
    marked = marked.withColumn("_new", (F.coalesce(between, F.lit(1)) > 0).cast("int"))
    marked = marked.withColumn("_gap", F.sum("_new").over(by.rowsBetween(W.unboundedPreceding, 0)))
    island = W.partitionBy("key", "_gap").orderBy(run)
    out = marked.withColumn("consecutive", F.row_number().over(island)).withColumn("first_seen", F.min(run).over(island))
    out = out.withColumn("severity", severity(F.col("kind"), F.col("consecutive"), F.col("slack")))
    was = F.lag("severity").over(island)
    return out.withColumn("raised", was.isNull() | (rank(F.col("severity")) > rank(was))).drop("_e", "_upto", "_new", "_gap")


def open_after(streak: DataFrame, evaluated: DataFrame, run: str = "run") -> DataFrame:
    """Alerts still open after the last run: the last event of a key, if no later evaluated run of its kind lacks it; worst first, then oldest."""
    last = streak.groupBy("key").agg(F.max_by(F.struct("kind", "source", "consecutive", "first_seen", "severity"), run).alias("a"), F.max(run).alias("last_seen")).select("key", "a.*", "last_seen")
    later = evaluated.groupBy("kind").agg(F.max(run).alias("_checked"))
    out = last.join(later, "kind", "left").where(F.col("_checked").isNull() | (F.col("_checked") <= F.col("last_seen"))).drop("_checked")
    return out.orderBy(rank(F.col("severity")).desc(), "first_seen", "key")


def closed(streak: DataFrame, evaluated: DataFrame, run: str = "run", keep: int = CLOSED_KEEP) -> DataFrame:
    """The last keep closed alerts: the first evaluated run after an island's end that lacks the event."""
    ends = streak.groupBy("key", "kind", "first_seen").agg(F.max(run).alias("last_seen"))
    after = ends.join(evaluated.select("kind", F.col(run).alias("_r")).distinct(), "kind").where(F.col("_r") > F.col("last_seen"))
    return after.groupBy("key", "kind", "first_seen", "last_seen").agg(F.min("_r").alias("closed_by")).orderBy(F.desc("closed_by"), "key").limit(keep)


def last_depths(runs: DataFrame, key: str, run: str = "run") -> DataFrame:
    """Of each source: depth of the newest fetched run that has one, and the newest such run without a breaker. Both must exist."""
    ok = runs.where("fetched and depth_hours is not null")
    out = ok.groupBy(key).agg(F.max_by("depth_hours", run).alias("depth_hours"), F.max(F.when(~F.col("tripped"), F.col(run))).alias("processed"))
    return out.where("processed is not null")


def loss_clock(depth: Column, processed: Column, now: Column) -> Column:
    """struct(hours_since_success, slack_hours): depth less the hours since the last good run and the time to the next."""
    since = F.round((F.unix_timestamp(now) - F.unix_timestamp(processed)) / 3600, 1)
    return F.struct(since.alias("hours_since_success"), F.round(depth - since - RUN_INTERVAL_HOURS, 1).alias("slack_hours"))


def tightest(clocks: DataFrame) -> DataFrame:
    """The clock with the least slack, for events without a source."""
    return clocks.orderBy("slack_hours", "source").limit(1)


def depth_rows(reports: DataFrame) -> DataFrame:
    """(run_id, started_at, source, fetched, depth_hours, tripped): what last_depths() needs of each report; sample feeds are left out."""
    rows = reports.select("run_id", "started_at", (F.size(F.coalesce("breaker_tripped", F.array().cast("array<string>"))) > 0).alias("tripped"), F.explode("fetch").alias("source", "f"))
    return rows.where(~F.coalesce(F.col("f.feed_kind") == "sample", F.lit(False))).select("run_id", "started_at", "source", F.col("f.status").isin("ok", "empty").alias("fetched"), "f.depth_hours", "tripped")


def _of_map(reports: DataFrame, column: str) -> DataFrame:
    return reports.select("run_id", "fetch", "sources", F.explode(column).alias("source", "v"))


def events_of(reports: DataFrame) -> DataFrame:
    """Run reports to typed events (run_id, ord, kind, source, detail); what is no condition of a kind gives no event (O-09).

    One pass over each nested map of a report; ord is the order of the kinds within a report.
    """
    n = lambda m, k: F.coalesce(F.try_element_at(m, F.lit(k)), F.lit(0))
    own = lambda m: F.try_element_at(m, F.col("source"))
    text = lambda pattern, *c: F.format_string(pattern, *[F.coalesce(x.cast("string"), F.lit("")) for x in c])

    def take(rows: DataFrame, rules: list[tuple[int, str, Column, Column]]) -> DataFrame:
        found = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(o).alias("ord"), F.lit(kind).alias("kind"), detail.alias("detail"))) for o, kind, cond, detail in rules]))
        return rows.select("run_id", "source", F.explode(found).alias("e")).select("run_id", "e.ord", "e.kind", "source", "e.detail")

    v = F.col("v")
    fetch = take(_of_map(reports, "fetch"), [
        (0, "source_error", ~v.status.isin("ok", "empty"), F.trim(text("fetch failed [%s] %s", v.status, v.detail))),
        (1, "stale_feed", v.silent.isNotNull(), text("newest item %s (%s days ago, at most %s)", v.silent.newest, v.silent.age_days, v.silent.max_silence_days))])
    tally = own(F.col("sources"))
    window = take(_of_map(reports, "window"), [
        (2, "window_capped", F.coalesce(v.capped, F.lit(False)), text("the window is at its cap (from %s, %s days)", v.cutoff, v.span_days)),
        (3, "not_drained", F.coalesce(~v.drained, F.lit(False)), text("waiting: gate %s, undated %s, extraction %s; the window's anchor %s", n(tally, "deferred_gate"), n(tally, "undated_deferred"), n(tally, "deferred_extraction"), F.when(F.coalesce(v.window_drained, F.lit(True)), "moves").otherwise("stays")))])
    gate, extraction = n(v, "evicted_gate"), n(v, "evicted_extraction")
    sample = F.coalesce(own(F.col("fetch")).feed_kind == "sample", F.lit(False))
    sources = take(_of_map(reports, "sources"), [
        (4, "evicted", (gate > 0) | (extraction > 0), text("left the feed unprocessed: gate %s, extraction %s", gate, extraction)),
        (5, "feed_rollover", (n(v, "feed_rollover") > 0) & ~sample, F.lit("the whole head of the last feed is gone; items may be lost, their number is not known")),
        (7, "quarantined", n(v, "quarantined_now") > 0, text("%s quarantined in this run", n(v, "quarantined_now")))])
    stages = reports.select("run_id", F.lit(6).alias("ord"), F.lit("breaker").alias("kind"), F.lit(None).cast("string").alias("source"), F.explode("breaker_tripped").alias("_s"))
    stages = stages.select("run_id", "ord", "kind", "source", text("%s: transport failures in a row", F.col("_s")).alias("detail"))
    return fetch.unionByName(window).unionByName(sources).unionByName(stages)


def with_loss(events: DataFrame, clocks: DataFrame) -> DataFrame:
    """events with slack: that of its source's clock(source, depth_hours, hours_since_success, slack_hours), the tightest clock where an event has no source; only kinds of DEPTH_KINDS have one, and their detail says so (J-21)."""
    best = tightest(clocks).withColumn("source", F.lit(None).cast("string"))
    named = tightest(clocks).select(F.lit(None).cast("string").alias("_s"), F.col("source").alias("_name"))
    keyed = clocks.unionByName(best).join(named, F.col("source").eqNullSafe(F.col("_s")), "left")  # a row a configured source
    keyed = keyed.select(F.col("source").alias("_key"), F.coalesce("_name", "source").alias("_clock"), "depth_hours", "hours_since_success", F.col("slack_hours").alias("slack"))
    out = events.join(keyed, F.col("source").eqNullSafe(F.col("_key")) & F.col("kind").isin(*DEPTH_KINDS), "left")
    verdict = F.when(F.col("slack") <= 0, "items are lost unless it runs before the next scheduled run").otherwise(F.format_string("%s hours left", F.col("slack").cast("string")))
    said = F.format_string("%s; %s has a feed of %s hours, last processed %s hours ago: %s", F.col("detail"), F.col("_clock"), F.col("depth_hours").cast("string"), F.col("hours_since_success").cast("string"), verdict)
    return out.select(*events.drop("detail").columns, F.when(F.col("slack").isNull(), F.col("detail")).otherwise(said).alias("detail"), "slack")


ALERTS_SCHEMA = 1
STATE = "key string, kind string, source string, detail string, first_seen string, last_seen string, last_run string, consecutive int, severity string, slack double, raised boolean, closed_at string, closed_by string, schema int"


class AlertState:
    """Open and closed alerts across runs, one version a run (S-31, T-09).

    A state that was written under another schema version is not read: alerts then start anew, as with no state.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.table = spark, KeyedTable(spark, path, "key", STATE)

    def load(self) -> DataFrame:
        state = self.table.read()
        other = state.where(~F.coalesce(F.col("schema") == ALERTS_SCHEMA, F.lit(False)))
        return state.limit(0) if other.limit(1).count() else state

    def open(self) -> DataFrame:
        """Worst first, then oldest."""
        return self.load().where("closed_at is null").orderBy(rank(F.col("severity")).desc(), "first_seen", "key")

    def closed(self) -> DataFrame:
        return self.load().where("closed_at is not null")

    def update(self, events: DataFrame, run_id: str, now: str, evaluated: list[str], keep: int = CLOSED_KEEP) -> DataFrame:
        """Take in a run's events(ord, kind, source, detail, slack); the alerts that are new or rose in severity.

        Of several events on a key the first counts. Open alerts of an evaluated kind without an event are closed; those of other kinds stay as they are.
        """
        state = self.load()
        was = state.where("closed_at is null")
        first = events.withColumn("key", key_of(F.col("kind"), F.col("source"))).groupBy("key").agg(F.min_by(F.struct("kind", "source", "detail", "slack"), F.struct("ord", "detail")).alias("e")).select("key", "e.*")
        before = was.select("key", F.col("consecutive").alias("_n"), F.col("first_seen").alias("_from"), F.col("severity").alias("_was"))
        now_ = F.lit(now)
        hit = first.join(before, "key", "left").withColumn("consecutive", F.coalesce(F.col("_n") + 1, F.lit(1)))
        hit = hit.withColumn("severity", severity(F.col("kind"), F.col("consecutive"), F.col("slack")))
        none = F.lit(None).cast("string")
        on = hit.select("key", "kind", "source", "detail", F.coalesce("_from", now_).alias("first_seen"), now_.alias("last_seen"), F.lit(run_id).alias("last_run"), "consecutive", "severity", "slack",
                        (F.col("_was").isNull() | (rank(F.col("severity")) > rank(F.col("_was")))).alias("raised"), none.alias("closed_at"), none.alias("closed_by"), F.lit(ALERTS_SCHEMA).alias("schema"))
        quiet = was.join(first.select("key"), "key", "left_anti").withColumn("raised", F.lit(False))
        over = F.col("kind").isin(*evaluated)
        ended = quiet.where(over).withColumn("closed_at", now_).withColumn("closed_by", F.lit(run_id))
        done = state.where("closed_at is not null").unionByName(ended).orderBy(F.desc("closed_at"), "key").limit(keep)
        self.table.overwrite(on.unionByName(quiet.where(~over)).unionByName(done))
        return self.open().where("raised")
