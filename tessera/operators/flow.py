"""Batch flow: state of items, admission windows, quotas, breaker, quarantine, backlog, loading
(P-09..P-12, P-19, J-01..J-03, J-14, J-19, W-01..W-12, T-01..T-07, T-10, A-03, A-04, A-29, A-30, O-02, O-03, B1, B2, B4, B5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.vocab import BACKLOG_HEAD, BREAKER_AT, LOOKBACK_DAYS, MAX_LOOKBACK_DAYS, OVERLAP_DAYS, QUARANTINE_AT, UNDATED_MAX

NO_DRAINED_RUN = "none_drained"
#: Parts into which rows without a rank are dealt.
SPREAD = 64


def with_state(items: DataFrame, ledger: DataFrame, store: DataFrame, key: str = "doc_id") -> DataFrame:
    """items with the ledger's columns and flags in_ledger, stored: two equi joins on the key."""
    marked = ledger.withColumn("in_ledger", F.lit(True))
    flags = store.select(key).distinct().withColumn("stored", F.lit(True))
    out = items.join(marked, key, "left").join(flags, key, "left")
    return out.withColumn("in_ledger", F.coalesce("in_ledger", F.lit(False))).withColumn("stored", F.coalesce("stored", F.lit(False)))


def item_state(stored: Column, in_ledger: Column, quarantined: Column, verdict: Column) -> Column:
    """Stage at which an item stopped. verdict: the gate's, null if there is none for the current gate key."""
    return (F.when(stored & in_ledger, "stored").when(stored, "stored_outside_pipeline").when(~in_ledger, "needs_gate").when(F.coalesce(quarantined, F.lit(False)), "quarantined")
            .when(verdict.isNull(), "needs_gate").when(verdict, "needs_extraction").otherwise("gate_skipped"))


def valid_verdict(gate_key: Column, current: Column, is_relevant: Column) -> Column:
    """A verdict counts only if it was given under the current key (P-10)."""
    return F.when(gate_key == current, is_relevant)


def undated(published: Column, today: Column) -> Column:
    """No date, or one past tomorrow."""
    return published.isNull() | (published > F.date_add(today, 1))


def in_window(published: Column, today: Column, cutoff: Column) -> Column:
    return undated(published, today) | (published >= cutoff)


def _apart(ranked: Column, by: str | Column) -> Column:
    """-1 for rows that are ranked, for others one of SPREAD numbers: a window partitioned by it sorts no other rows together than it must."""
    return F.when(F.coalesce(ranked, F.lit(False)), F.lit(-1)).otherwise(F.pmod(F.xxhash64(by), F.lit(SPREAD)).cast("int"))


def admission(items: DataFrame, keys: list[str], published: str, order: str, today: Column, cutoff: Column, known: Column | None = None, most: int = UNDATED_MAX) -> DataFrame:
    """Adds admission. Undated items are admitted in feed order, most of each key; items with known true are past the window."""
    fresh = F.lit(True) if known is None else ~known
    open_ = undated(F.col(published), today)
    # The undated new items of a key are ranked together; all others are dealt out, so that no task gets a whole key.
    rank = F.row_number().over(W.partitionBy(*keys, _apart(open_ & fresh, order)).orderBy(order))
    verdict = (F.when(~fresh, "known").when(open_, F.when(rank <= most, "undated_admitted").otherwise("undated_deferred"))
               .when(F.col(published) >= cutoff, "in_window").otherwise("out_of_window"))
    return items.withColumn("admission", verdict)


def window_bounds(today: Column, anchor: Column, seen: Column, carry: Column, lookback: int = LOOKBACK_DAYS, overlap: int = OVERLAP_DAYS, cap: int = MAX_LOOKBACK_DAYS) -> Column:
    """struct(cutoff, span_days, capped). anchor: date of the last drained run; seen: any run at all; carry: least cutoff of undrained runs since (T-01..T-04)."""
    wanted = (F.when(anchor.isNotNull(), F.greatest(F.lit(lookback), F.datediff(today, anchor) + overlap))
              .when(~seen | carry.isNotNull(), F.lit(lookback)).otherwise(F.lit(cap + 1)))
    need = F.least(F.date_sub(today, wanted), F.coalesce(carry, F.date_sub(today, wanted)))
    floor = F.date_sub(today, cap)
    return F.struct(F.greatest(need, floor).alias("cutoff"), F.datediff(today, F.greatest(need, floor)).alias("span_days"), (need < floor).alias("capped"))


def window_history(runs: DataFrame, today: Column, keys: list[str], run: str = "day", drained: str = "drained", cutoff: str = "cutoff", cap: int = MAX_LOOKBACK_DAYS) -> DataFrame:
    """Of each key: drained_on (newest drained run) and carry (least cutoff of the undrained runs after it).

    If the carry falls below the cap's floor before the drained run is met, going back, the drained run is not looked
    for any more; so it counts only if no undrained run after it has such a cutoff.
    """
    floor = F.date_sub(today, cap)
    last = runs.groupBy(*keys).agg(F.max(F.when(F.col(drained), F.col(run))).alias("_last"), F.max(F.when(~F.col(drained) & (F.col(cutoff) < floor), F.col(run))).alias("_low"))
    after = runs.join(last, keys).where(~F.col(drained) & (F.col("_last").isNull() | (F.col(run) > F.col("_last"))) & (F.col("_low").isNull() | (F.col(run) >= F.col("_low"))))
    carry = after.groupBy(*keys).agg(F.min(cutoff).alias("carry"))
    return last.join(carry, keys, "left").select(*keys, F.when(F.col("_low").isNull() | (F.col("_last") > F.col("_low")), F.col("_last")).alias("drained_on"), "carry")


def anchor(drained_on: Column, today: Column, cap: int = MAX_LOOKBACK_DAYS, overlap: int = OVERLAP_DAYS) -> Column:
    return F.when(drained_on >= F.date_sub(today, cap + overlap), drained_on)


def quota(items: DataFrame, wants: Column, source: str, order: list, per_source: Column, ceiling: int) -> DataFrame:
    """Adds granted: the first per_source of each source that want a call, then of those the first ceiling of the whole run.

    The global count sees only rows within their source's limit. They are numbered by source counts
    and offsets, so no task orders the whole run; sources come in the order of order[0].
    """
    w = W.partitionBy(source, _apart(wants, order[0])).orderBy(*order)
    ranked = items.withColumn("_want", wants).withColumn("_rank", F.row_number().over(w)).withColumn("_in", F.col("_want") & (F.col("_rank") <= per_source))
    taken = ranked.where("_in").groupBy(F.col(source).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    before = taken.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # a row a source
    out = ranked.join(before, F.col(source) == F.col("_s"), "left")
    granted = F.col("_in") & (F.coalesce("_before", F.lit(0)) + F.col("_rank") <= ceiling)
    return out.withColumn("granted", granted).withColumn("deferred", F.col("_want") & ~granted).drop("_want", "_rank", "_in", "_s", "_n", "_before")


def breaker(calls: DataFrame, keys: list[str], order: list[str], outcome: str, at: int = BREAKER_AT) -> DataFrame:
    """Adds open: the breaker has tripped before this call. at transport failures in a row trip it; ok resets; schema failures neither count nor reset.

    Streaks are islands between oks: the running count of failures since the last ok. Only transport and ok rows take part.
    """
    by = W.partitionBy(*keys).orderBy(*order)
    upto = by.rowsBetween(W.unboundedPreceding, 0)
    df = calls.withColumn("_island", F.sum(F.when(F.col(outcome) == "ok", 1).otherwise(0)).over(upto))
    df = df.withColumn("streak", F.sum(F.when(F.col(outcome) == "transport", 1).otherwise(0)).over(W.partitionBy(*keys, "_island").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
    return df.withColumn("open", F.coalesce(F.max((F.col("streak") >= at).cast("int")).over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) == 1).drop("_island")


def quarantine(events: DataFrame, keys: list[str], order: list[str], kind: str, at: int = QUARANTINE_AT) -> DataFrame:
    """Adds failures (schema failures since the last release) and quarantined."""
    by = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    df = events.withColumn("_since", F.sum(F.when(F.col(kind) == "release", 1).otherwise(0)).over(by))
    df = df.withColumn("failures", F.sum(F.when(F.col(kind) == "schema", 1).otherwise(0)).over(W.partitionBy(*keys, "_since").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
    return df.withColumn("quarantined", F.col("failures") >= at).drop("_since")


def backlog_head(items: DataFrame, keys: list[str], order: str, value: str, n: int = BACKLOG_HEAD) -> DataFrame:
    """The first n ids of each key's feed, in feed order."""
    first = items.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(order))).where(F.col("_r") <= n)
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", F.col(value).alias("v")))), lambda x: x.v).alias("head"))


def evictions(pending: DataFrame, feed: DataFrame, key: list[str]) -> DataFrame:
    """Ids deferred last time that the feed no longer has; pending holds only those that still wait."""
    return pending.join(feed.select(*key).distinct(), key, "left_anti")


def rollover(head: Column, feed: Column) -> Column:
    """All of the last head left the feed; both must be non-empty."""
    return (F.size(head) > 0) & (F.size(feed) > 0) & ~F.arrays_overlap(head, feed)


def load_action(note: Column, policy: Column, status: Column, rewrite: Column, same_article: Column) -> Column:
    """What loading does with an item (B5). note: a note exists; same_article: the free name turns out to hold the same article."""
    fresh = (F.when(same_article & policy.isin("skip"), "exists").when(same_article & ~policy.isin("overwrite"), "failed").otherwise("written"))
    return (F.when(note & (policy == "skip"), "exists").when(~note & F.coalesce(status.isin("written", "deleted_by_user"), F.lit(False)) & ~rewrite, "deleted_by_user")
            .when(note & (policy == "overwrite"), "overwritten").when(note, "failed").otherwise(fresh))


def suffixed(names: DataFrame, base: str, order: str, most: int = 999) -> DataFrame:
    """Adds file: base.md, base-2.md, ... in that order; null past most (W-12)."""
    df = names.withColumn("_r", F.row_number().over(W.partitionBy(base).orderBy(order)))
    return df.withColumn("file", F.when(F.col("_r") == 1, F.concat(base, F.lit(".md"))).when(F.col("_r") <= most, F.concat(base, F.lit("-"), F.col("_r").cast("string"), F.lit(".md")))).drop("_r")


def exit_code(failures: Column, produced: Column, source_only: Column, healthy: Column) -> Column:
    return F.when(failures == 0, 0).when(produced > 0, 3).when(source_only & (healthy >= 1), 3).otherwise(1)


def call_plan(needs_gate: Column, needs_extraction: Column, gate_limit: Column, extract_limit: Column) -> Column:
    """Calls that a run can make at most (A-30)."""
    gate = F.least(needs_gate, gate_limit)
    return F.struct(gate.alias("gate_max"), F.least(needs_extraction + gate, extract_limit).alias("extract_max"))


def note_index(notes: DataFrame, key: Column, path: str = "path") -> DataFrame:
    """(key, path): of several notes on a key the first file name; invalid keys are left out (J-04)."""
    return notes.withColumn("key", key).where("key is not null").groupBy("key").agg(F.min(path).alias("path"))
