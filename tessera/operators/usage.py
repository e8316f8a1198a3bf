"""Tokens, cost, run summaries and quality (A-05..A-08, A-18..A-20, J-17, J-18, P-21, L-05)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.feeds import upper_median_by


def price_table(spark: SparkSession, prices: list[tuple[str, float, float]]) -> DataFrame:
    """(ord, prefix, input, output) per million tokens, in order of precedence."""
    return spark.createDataFrame([(i, *p) for i, p in enumerate(prices)], "ord int, prefix string, input double, output double")


def with_price(models: DataFrame, prices: DataFrame, model: str = "model") -> DataFrame:
    """models(model, distinct) with the price of the first listed prefix; null where none fits. Both sides are dimension tables: distinct models, configured prices."""
    hit = models.join(F.broadcast(prices), F.coalesce(F.col(model), F.lit("")).startswith(F.col("prefix")), "left")
    return hit.groupBy(model).agg(F.min_by(F.struct("input", "output"), "ord").alias("price"))


def usage_by_source(records: DataFrame, prices: DataFrame) -> DataFrame:
    """records(source_name, model, input_tokens, output_tokens, thinking_tokens, text): sums, upper-median body and cost of each source.

    Tokens are summed by source and model before they meet a price. A source with a model of unknown price has a null cost: a price of 0 is known.
    """
    by_model = records.groupBy("source_name", "model").agg(F.count(F.lit(1)).alias("records"), F.sum("input_tokens").alias("i"), F.sum("output_tokens").alias("o"), F.coalesce(F.sum("thinking_tokens"), F.lit(0)).alias("t"))
    priced = by_model.join(with_price(by_model.select("model").distinct(), prices).withColumnRenamed("model", "_m"), F.col("model").eqNullSafe(F.col("_m")), "left")
    cost = (F.col("i") * F.col("price.input") + F.col("o") * F.col("price.output")) / 1e6
    out = priced.groupBy("source_name").agg(
        F.sum("records").alias("records"), F.sum("i").alias("input_tokens"), F.sum("o").alias("output_tokens"), F.sum("t").alias("thinking_tokens"),
        F.when(F.count(F.lit(1)) == F.count("price.input"), F.round(F.sum(cost), 6)).alias("cost"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("price.input").isNull(), F.col("model")))), ",").alias("unpriced"))
    out = out.withColumn("cost_per_record", F.round(F.col("cost") / F.col("records"), 6))
    sized = records.withColumn("_len", F.length("text").cast("long"))
    return out.join(upper_median_by(sized, ["source_name"], "_len", "body_median"), "source_name")


def usage_report(usage: DataFrame) -> DataFrame:
    """Sources by cost, known costs first (L-05)."""
    return usage.orderBy(F.col("cost").isNull(), F.desc("cost"), "source_name")


def usage_totals(usage: DataFrame) -> DataFrame:
    """All records, but cost and mean over priced sources only, and the models left out (A-08)."""
    return usage.agg(F.sum("records").alias("records"), F.round(F.sum("cost"), 4).alias("cost"), F.round(F.sum("cost") / F.sum(F.when(F.col("cost").isNotNull(), F.col("records"))), 6).alias("mean"),
                     F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.filter(F.split("unpriced", ","), lambda m: m != ""))))), ",").alias("excluded"))


def rate(n: Column, d: Column, digits: int = 3) -> Column:
    """n / d, null on a zero denominator: what could not be measured is not 0."""
    return F.round(n / F.nullif(d, F.lit(0)), digits)


def failure_kind(ok: Column, error: Column) -> Column:
    return F.when(ok, F.lit(None)).when(error == "schema", "schema").otherwise("transport")


def replayed(baseline: DataFrame, outputs: DataFrame, fields: list[str], key: str = "doc_id") -> DataFrame:
    """baseline(key, fields) and a new model's outputs(key, fields, failure, attempts) to one row a baseline item: failure, attempts, changed (names of differing fields; null where there is no output to compare) (M-08, M-09).

    An item without an output is not yet run; outputs without a baseline are left out. Of several outputs on an item the last attempt counts.
    """
    last = outputs.groupBy(key).agg(F.max_by(F.struct("failure", "attempts", *fields), F.struct("attempts", F.col("failure").isNull())).alias("o"))
    got = baseline.select(key, *fields).join(last, key, "left")
    changed = F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"o.{f}")), F.lit(f)) for f in fields]))
    state = F.when(F.col("o").isNull(), "pending").when(F.col("o.failure").isNotNull(), "failed").when(F.size(changed) > 0, "changed").otherwise("same")
    return got.select(key, state.alias("state"), "o.failure", "o.attempts", F.when(state.isin("changed", "same"), changed).alias("changed"))


def replay_summary(rows: DataFrame, *keys: str) -> DataFrame:
    """rows(failure, attempts): transport failures leave the denominator; retried counts rows (A-18)."""
    schema, transport, n = F.count_if(F.col("failure") == "schema"), F.count_if(F.col("failure") == "transport"), F.count(F.lit(1))
    return rows.groupBy(*keys).agg(n.alias("n"), schema.alias("schema_failed"), transport.alias("transport_failed"), (n - transport).alias("measured"), rate(schema, n - transport, 4).alias("schema_failure_rate"), F.count_if(F.col("attempts") > 1).alias("retried"))


def predict_summary(rows: DataFrame, *keys: str) -> DataFrame:
    """The same with an unrounded rate, and retried counts extra attempts (A-19)."""
    schema, transport, n = F.count_if(F.col("failure") == "schema"), F.count_if(F.col("failure") == "transport"), F.count(F.lit(1))
    return rows.groupBy(*keys).agg(n.alias("n"), (n - transport).alias("measured"), (schema / F.nullif(n - transport, F.lit(0))).alias("schema_failure_rate"), F.sum(F.greatest(F.col("attempts") - 1, F.lit(0))).cast("long").alias("retried"))


def length_stops(rows: DataFrame, *keys: str) -> DataFrame:
    """rows(stop_kinds, finish_reasons): each row in one class at most; degenerate wins, rows from before the classes are unclassified (A-20)."""
    kinds, reasons = F.col("stop_kinds"), F.col("finish_reasons")
    kind = F.when(kinds.isNull(), F.when(F.array_contains(F.coalesce(reasons, F.array().cast("array<string>")), "length"), "unclassified")).when(F.array_contains(kinds, "degenerate"), "degenerate").when(F.array_contains(kinds, "truncated"), "truncated")
    n = lambda k: F.count_if(F.coalesce(kind == k, F.lit(False))).alias(k)
    return rows.groupBy(*keys).agg(n("truncated"), n("degenerate"), n("unclassified"))


def quality(records: DataFrame, tallies: DataFrame, key: str = "source_name") -> DataFrame:
    """records(key, attempts, companies, prior_art, release_type, impact) and tallies(key, gate_passed, gate_skipped, extract_calls, schema_failed): rates to 3 digits and distributions as JSON (A-05)."""
    base = records.groupBy(key).agg(
        F.count(F.lit(1)).alias("extracted"), F.count_if(F.col("attempts") > 1).alias("_retried"), F.count_if(F.size("prior_art") == 0).alias("_empty"), F.sum(F.size("companies")).alias("_companies"), F.sum(F.size(F.filter("companies", lambda c: ~c.resolved))).alias("_unresolved"))
    counts = lambda col, out: records.groupBy(key, col).agg(F.count(F.lit(1)).alias("n")).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(col).cast("string").alias("k"), "n"))), lambda x: F.concat_ws("=", x.k, x.n.cast("string"))), ";").alias(out))
    out = base.join(tallies, key, "left").join(counts("release_type", "release_types"), key).join(counts("impact", "impacts"), key)
    return out.select(
        key, "extracted", rate(F.col("gate_passed"), F.col("gate_passed") + F.col("gate_skipped")).alias("gate_pass_rate"), rate(F.col("_retried") + F.col("schema_failed"), F.col("extract_calls")).alias("schema_retry_rate"),
        rate(F.col("_unresolved"), F.col("_companies")).alias("unresolved_company_rate"), rate(F.col("_empty"), F.col("extracted")).alias("prior_art_empty_rate"), "release_types", "impacts")
