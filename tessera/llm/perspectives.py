"""Operator 8: multi-party perspective rotation of dialogues. DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that
speaker as assistant, all others as named users and system turns as they are.
The mask holds the stretches of the text that the speaker says, end marker
included: those are trained on. A long conversation is rendered in parts of PART turns, so
that no row or task holds an unbounded dialogue.

A turn is a header, the text and an end marker. Where a text holds the marker's first
characters, a space is set between them, so no text can pass for a header.

Nulls and empties: a null conversation is one of its own, a null role a participant of empty name,
a null text empty; null turns come last. Ties are ordered by role, then text. Rows that repeat (same conversation, turn,
role and text) count once. A conversation of system turns alone has no participant and no row. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, prefix_sums

PART = 128
SPAN = 256  # turn numbers of a bucket in which turns are ranked
SYSTEM = "system"
END = "<|end|>\n"


def rotate(turns: DataFrame) -> DataFrame:
    """One row per conversation, speaker and part: text, mask as start:end pairs (code points), n_turns, n_own, n_chars."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    rows = materialise(rows, "turns")
    bucket = F.coalesce(F.floor(F.col("turn") / SPAN), F.lit((1 << 62))).cast("long")
    order = [F.asc_nulls_last("turn"), "role", "text"]
    ranked = prefix_sums(rows.withColumn("_bucket", bucket), ["conv_id"], "_bucket", order, F.lit(0), "_none", rank="at")
    said = F.struct("at", "role", F.replace("text", F.lit("<|"), F.lit("< |")).alias("text"))
    parts = ranked.withColumn("part", F.floor(F.col("at") / PART).cast("long")).groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(said)).alias("said"))
    people = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    both = parts.join(people, F.col("conv_id").eqNullSafe(F.col("_conv")))

    own = lambda x: x.role == F.col("speaker")
    head = lambda x: F.when(own(x), F.lit("<|assistant|>\n")).when(x.role == SYSTEM, F.lit("<|system|>\n")).otherwise(F.concat(F.lit("<|user name="), F.replace(x.role, F.lit("|"), F.lit("_")), F.lit("|>\n")))
    pieces = F.transform("said", lambda x: F.struct(own(x).alias("own"), head(x).alias("head"), F.concat(x.text, F.lit(END)).alias("body")))

    def step(acc, x):
        start = acc.at + F.length(x.head)
        end = start + F.length(x.body)
        pair = F.concat_ws(":", start.cast("string"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(x.own, F.concat(acc.out, F.array(pair))).otherwise(acc.out).alias("out"))

    done = both.select("conv_id", "speaker", "part", pieces.alias("pieces"))
    mask = F.aggregate("pieces", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step, lambda acc: F.array_join(acc.out, ","))
    text = F.array_join(F.transform("pieces", lambda x: F.concat(x.head, x.body)), "")
    out = done.select("conv_id", "speaker", "part", text.alias("text"), mask.alias("mask"), F.size("pieces").cast("long").alias("n_turns"), F.size(F.filter("pieces", lambda x: x.own)).cast("long").alias("n_own"))
    return out.select("conv_id", "speaker", "part", "text", "mask", "n_turns", "n_own", F.length("text").cast("long").alias("n_chars"))


SQL = f"""
WITH turns AS (
  SELECT DISTINCT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1 AS spot FROM turns),
people AS (SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> '{SYSTEM}'),
pieces AS (
  SELECT r.conv_id, p.speaker, CAST(r.spot // {PART} AS BIGINT) AS part, r.spot, r.role = p.speaker AS own,
         CASE WHEN r.role = p.speaker THEN '<|assistant|>' WHEN r.role = '{SYSTEM}' THEN '<|system|>' ELSE '<|user name=' || replace(r.role, '|', '_') || '|>' END || chr(10) AS head,
         replace(r.text, '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM ranked r JOIN people p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, part ORDER BY spot) AS stop FROM pieces)
SELECT conv_id, speaker, part, string_agg(head || body, '' ORDER BY spot) AS text,
       coalesce(string_agg(CAST(stop - length(body) AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY spot) FILTER (WHERE own), '') AS mask,
       count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own, CAST(sum(length(head) + length(body)) AS BIGINT) AS n_chars
FROM placed GROUP BY conv_id, speaker, part
"""
