"""Model calls that are recorded before they are used, stop themselves, correct themselves once, and resume
(O-02, M-01, M-02, M-04, M-06, M-07, S-28, S-29, W-05).

A client is a function of an item (a dict of its columns) that returns the raw response as text. It raises
SchemaMismatch if the response is unfit, EgressBlocked if the call must not be made at all (that ends the
run), and anything else for a failed transport. Every step writes what it got as Parquet and the next one reads that, so nothing is
called again by a later action, and an interrupted run goes on where its last complete part ends. Within a part, a lost executor's
calls are made again: parts are small, and speculative execution should be off.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

from tessera.sources.tables import exists
from tessera.vocab import BREAKER_AT

Client = Callable[[dict], str]
OUTCOMES = ("ok", "schema", "transport")
ERROR_CHARS = 500


class SchemaMismatch(Exception):
    """The response does not fit its schema, corrections included. It neither counts for the breaker nor resets it."""


class EgressBlocked(Exception):
    """The call would leave the allowed endpoints."""


def ask(client: Client, item: dict) -> tuple[str, str | None, str | None]:
    """(outcome, response, error) of one call."""
    try:
        return "ok", client(item), None
    except EgressBlocked:
        raise
    except Exception as e:
        return "schema" if isinstance(e, SchemaMismatch) else "transport", None, f"{type(e).__name__}: {e}"[:ERROR_CHARS]


def _columns(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in names)


def settle(client: Client, item: dict, fits: Callable[[str], bool] | None = None, corrections: int = 0) -> tuple[str, str | None, str | None, int]:
    """(outcome, response, error, attempts) of one logical call: a response that does not fit is asked for again, with the reason in item["error"]."""
    attempts, reason = 0, None
    while True:
        attempts += 1
        outcome, response, error = ask(client, {**item, "error": reason} if corrections else item)
        if outcome == "ok" and fits and not fits(response):
            outcome, error = "schema", "the response does not fit its schema"
        if outcome != "schema" or attempts > corrections:
            return outcome, response, error, attempts
        reason = error


def _rows(batches, most: int = 256):
    """Lists of at most most rows, as dicts."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most).to_pylist()


def _complete(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/_SUCCESS")


def guarded(items: DataFrame, client: Client, keys: list[str], order: list[str], key: str, path: str, at: int = BREAKER_AT, step: int = 50, fits: Callable[[str], bool] | None = None, corrections: int = 0) -> DataFrame:
    """Call the client on the items of each group of keys in their order, until at transport failures in a row.

    Groups run beside each other, the items of one after another, step of each group at a time: a slice is
    called, written, and only then does the next one start, from the streak that each group's last recorded call left. A group
    that has tripped makes no further calls. Slices that are complete under path are not called again.
    Returns a row an item: keys, key, no (position in its group), outcome (left: not called), response, error and
    streak. order must be total within a group; null keys are a group of their own.
    """
    spark = items.sparkSession
    if not _complete(spark, f"{path}/items"):
        no = F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
        items.withColumn("no", no).write.mode("overwrite").parquet(f"{path}/items")
    plan = spark.read.schema(StructType([*items.schema.fields, StructField("no", IntegerType())])).parquet(f"{path}/items")
    most = plan.agg(F.max("no")).first()[0]
    names = list(plan.columns)
    kept = [*keys, key, "no"]
    schema = f"{_columns(plan, kept)}, outcome string, response string, error string, streak int, attempts int"
    out_names = StructType.fromDDL(schema).names

    def run(batches):
        at_group, streak = None, 0
        for rows in _rows(batches):
            found = []
            for row in rows:
                group = tuple(row[k] for k in keys)
                if group != at_group:
                    at_group, streak = group, row["_streak"]
                if streak >= at:
                    continue
                outcome, response, error, attempts = settle(client, {n: row[n] for n in names if n != "no"}, fits, corrections)
                streak = 0 if outcome == "ok" else streak + (outcome == "transport")
                found.append({**{n: row[n] for n in kept}, "outcome": outcome, "response": response, "error": error, "streak": streak, "attempts": attempts})
            yield pa.RecordBatch.from_pylist(found, schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    done = spark.createDataFrame([], StructType.fromDDL(schema))
    for s in range(0 if most is None else most // step + 1):
        at_slice = f"{path}/calls/slice={s}"
        if not _complete(spark, at_slice):
            state = done.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by("streak", "no").alias("_streak"))
            same = F.lit(True)
            for i, k in enumerate(keys):
                same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
            todo = plan.where((F.col("no") >= s * step) & (F.col("no") < (s + 1) * step)).join(state, same, "left").withColumn("_streak", F.coalesce("_streak", F.lit(0)))
            todo = todo.where(F.col("_streak") < at).select(*names, "_streak")
            todo.repartition(*keys).sortWithinPartitions(*keys, "no").mapInArrow(run, schema).write.mode("overwrite").parquet(at_slice)
        part = spark.read.schema(schema).parquet(at_slice)
        done = done.unionByName(part)
    made = done.select(*[F.col(c).alias(f"_{c}") for c in out_names])
    same = (F.col("no") == F.col("_no")) & F.col(key).eqNullSafe(F.col(f"_{key}"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return plan.select(*kept).join(made, same, "left").select(*kept, F.coalesce("_outcome", F.lit("left")).alias("outcome"), F.col("_response").alias("response"), F.col("_error").alias("error"), F.col("_streak").alias("streak"), F.col("_attempts").alias("attempts"))


def tripped(calls: DataFrame, keys: list[str], at: int = BREAKER_AT) -> DataFrame:
    """What guarded() left behind of each group: calls made, items left, and whether it tripped."""
    return calls.groupBy(*keys).agg(F.count_if(F.col("outcome") != "left").alias("calls"), F.count_if(F.col("outcome") == "left").alias("left"), F.coalesce(F.max("streak") >= at, F.lit(False)).alias("tripped"))


def record(items: DataFrame, client: Client, path: str, mode: str = "overwrite") -> None:
    """Call the client on each item and write the items' columns, outcome, response and error under path.

    Spark's committer makes the write whole or leaves nothing of it.
    """
    schema = StructType([*items.schema.fields, *StructType.fromDDL("outcome string, response string, error string").fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for rows in _rows(batches):
            yield pa.RecordBatch.from_pylist([{**row, **dict(zip(("outcome", "response", "error"), ask(client, row), strict=True))} for row in rows], schema=arrow)

    items.mapInArrow(run, schema).write.mode(mode).parquet(path)


def corrected(items: DataFrame, client: Client, schema: str, path: str, fits: Callable[[Column], Column] | None = None) -> DataFrame:
    """Raw responses, parsed; those that do not parse are asked for once more, with the error in the item.

    The raw rows of each attempt are a table under path before anything is parsed. The second pass holds just
    the rows whose first response is no JSON of the schema (or that fits() refuses); client sees the reason as item["error"]. Returns the
    items with value (the parsed struct), response (the last), attempts and error (schema, transport or null). A
    transport failure is not asked again here. Complete attempts are not called again.
    """
    spark = items.sparkSession
    names = list(items.columns)
    kind = StructType([*StructType.fromDDL(schema).fields, *StructType.fromDDL("_bad string").fields])

    def parsed(df: DataFrame) -> DataFrame:
        value = F.from_json("response", kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
        df = df.withColumn("_v", value)
        sound = F.col("_v").isNotNull() & F.col("_v._bad").isNull()
        sound = sound & F.coalesce(fits(F.col("_v")), F.lit(False)) if fits else sound
        return df.withColumn("_error", F.when(F.col("outcome") == "transport", "transport").when(~F.coalesce(sound, F.lit(False)) | (F.col("outcome") == "schema"), "schema"))

    first = f"{path}/attempt=1"
    if not _complete(spark, first):
        record(items.withColumn("_reason", F.lit(None).cast("string")), lambda r: client({**{n: r[n] for n in names}, "error": None}), first)
    stored = StructType([*items.schema.fields, *StructType.fromDDL("_reason string, outcome string, response string, error string").fields])
    one = parsed(spark.read.schema(stored).parquet(first))
    second = f"{path}/attempt=2"
    if not _complete(spark, second):
        reason = F.coalesce("error", F.lit("the response is not JSON of the schema"))
        record(one.where("_error = 'schema'").select(*names, reason.alias("_reason")), lambda r: client({**{n: r[n] for n in names}, "error": r["_reason"]}), second)
    two = parsed(spark.read.schema(stored).parquet(second))
    fields = [F.col(f"_v.`{f.name}`").alias(f.name) for f in StructType.fromDDL(schema).fields]
    shaped = lambda df, n: df.select(*names, F.when(F.col("_error").isNull(), F.struct(*fields)).alias("value"), "response", F.lit(n).alias("attempts"), F.col("_error").alias("error"))
    return shaped(one.where("_error is null or _error <> 'schema'"), 1).unionByName(shaped(two, 2))


def judge(items: DataFrame, client: Client, key: str, repeats: int, path: str, parts: int = 8) -> DataFrame:
    """repeats judgements of each item, repeat 0 first; what an earlier, interrupted run recorded is not asked again.

    Judgements are appended part by part (parts of the missing (item, repeat) pairs by hash), each of which counts once it is
    whole. Returns all recorded rows: the items' columns, repeat, outcome, response, error.
    """
    spark = items.sparkSession
    stored = StructType([*items.schema.fields, *StructType.fromDDL("repeat int, outcome string, response string, error string").fields])
    at = f"{path}/calls"
    wanted = items.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))) if repeats > 0 else items.withColumn("repeat", F.lit(0)).limit(0)
    have = spark.read.schema(stored).parquet(at).select(key, "repeat") if exists(spark, at) else None
    missing = wanted if have is None else wanted.join(have, [key, "repeat"], "left_anti")
    left = {r.p for r in missing.select(F.pmod(F.xxhash64(key, "repeat"), F.lit(parts)).cast("int").alias("p")).distinct().collect()}  # at most parts numbers
    for p in sorted(left):
        todo = wanted.where(F.pmod(F.xxhash64(key, "repeat"), F.lit(parts)) == p)
        if exists(spark, at):
            todo = todo.join(spark.read.schema(stored).parquet(at).select(key, "repeat"), [key, "repeat"], "left_anti")
        record(todo.select(*items.columns, "repeat"), client, at, mode="append")
    return spark.read.schema(stored).parquet(at) if exists(spark, at) else spark.createDataFrame([], stored)


def finish(summary: DataFrame, path: str) -> None:
    """Write a run's summary, over the one before and nothing else; a run without it was cut off (S-28)."""
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def finished(spark: SparkSession, path: str) -> bool:
    return _complete(spark, f"{path}/summary")
