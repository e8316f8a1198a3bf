"""Feed entries and outcomes (P-01..P-04, S-06..S-08, A-02, A-24, A-25, A-27, L-01, T-08)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Outcomes of a fetch in order of precedence; the last two are no failures.
STATUSES = ("config_error", "http_error", "too_large", "decode_error", "timeout", "network_error", "parse_error", "no_usable_entries", "empty", "ok")


def usable(link: Column, title: Column) -> Column:
    """An entry counts if it has a link and a title that is not blank (P-01)."""
    return F.coalesce(link != "", F.lit(False)) & F.coalesce(F.trim(title) != "", F.lit(False))


def status(config_ok: Column, http: Column, size: Column, decoded: Column, fault: Column, parsed: Column, entries: Column, usable_entries: Column, cap: int = 8 << 20) -> Column:
    """Outcome of a fetch, the first that applies (P-03). fault: null, timeout or network."""
    return (F.when(~config_ok, STATUSES[0]).when(http >= 400, STATUSES[1]).when(size > cap, STATUSES[2]).when(~decoded, STATUSES[3]).when(fault == "timeout", STATUSES[4])
            .when(fault == "network", STATUSES[5]).when(~parsed, STATUSES[6]).when((entries > 0) & (usable_entries == 0), STATUSES[7]).when(entries == 0, STATUSES[8]).otherwise(STATUSES[9]))


def failed(outcome: Column) -> Column:
    return ~outcome.isin("ok", "empty")


def upper_median_by(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """The upper median of value for each key, by counts of distinct values and their running sum: no group is gathered."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    over = W.partitionBy(*keys)
    ranked = counts.withColumn("_end", F.sum("_n").over(over.orderBy(value).rowsBetween(W.unboundedPreceding, 0))).withColumn("_all", F.sum("_n").over(over))
    return ranked.where(F.col("_end") > F.floor(F.col("_all") / 2)).groupBy(*keys).agg(F.min(value).alias(out))


def body_stats(items: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """Items, upper median of the body length, and empty bodies of each key (A-02)."""
    sized = items.withColumn("_len", F.length(F.coalesce(F.col(body), F.lit(""))).cast("long"))
    base = sized.groupBy(*keys).agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("_len") == 0).alias("body_empty"))
    return base.join(upper_median_by(sized, keys, "_len", "body_chars_median"), keys)


def depth_hours(moment: Column) -> Column:
    """Span of a feed's moments in hours to 1 digit, null for fewer than two (A-24)."""
    return F.when(F.count(moment) >= 2, F.round((F.unix_timestamp(F.max(moment).cast("timestamp")) - F.unix_timestamp(F.min(moment).cast("timestamp"))) / 3600, 1))


def silence(items: DataFrame, keys: list[str], published: str, today: Column, most_days: Column) -> DataFrame:
    """Keys whose newest date, not counting dates past tomorrow, is over most_days old (A-25)."""
    dated = F.when(F.col(published) <= F.date_add(today, 1), F.col(published))
    newest = items.groupBy(*keys).agg(F.max(dated).alias("newest"))
    return newest.withColumn("age_days", F.datediff(today, "newest").cast("long")).where(F.col("age_days") > most_days)


def first_of_each(items: DataFrame, key: str, *order: str) -> DataFrame:
    """First wins: the first row of each key in that order; adds the number of rows dropped for it (W-01).

    Rows are reduced to one a key before they are shuffled, so a frequent key costs no task more.
    """
    group = items.groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(*items.columns), F.struct(*order)).alias("_f"), (F.count(F.lit(1)) - 1).alias("duplicates"))
    return group.select("_f.*", "duplicates")
