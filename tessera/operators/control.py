"""Control plane as data: prompts, hashes, keys, source lookup, samples, approvals, status texts
(F-19, F-32, F-33, F-35, F-38, F-40..F-42, F-44, P-19, P-25, P-27, J-12, L-02, L-03, L-07, A-14, S-13, S-32, S-33, O-05)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import urls as U
from tessera.sources import lines
from tessera.vocab import SLOTS


def load_prompt(text: str, name: str = "prompt") -> tuple[str, str]:
    """(system, user) of a prompt file: comments go, both sections are needed, System comes first (S-33)."""
    text = re.sub(r"(?s)<!--.*?-->", "", text)
    found = {k: re.search(rf"(?m)^#\s*{k}\s*$", text) for k in ("System", "User")}
    if not all(found.values()) or found["User"].start() < found["System"].start():
        raise ValueError(f"{name}: needs '# System' and then '# User'")
    return text[found["System"].end() : found["User"].start()].strip(), text[found["User"].end() :].strip()


def vocabulary_block(words: tuple[str, ...]) -> str:
    return "\n".join(f"- `{w}`" for w in words)


def render_slots(slots: Column) -> Column:
    """The labelled elements of the four slots, as the judge sees them, with their number first (F-19). slots: array of four arrays; null without labels."""
    marks = F.array(*[F.lit(m) for m in "abcdefgh"])
    each = lambda name, k: F.concat(F.lit(f"- {name}: "), F.when(F.size(slots[k]) == 0, F.lit("분모 제외 (원문이 이 정보를 주지 않았다)")).otherwise(F.array_join(F.transform(slots[k], lambda e, i: F.concat(F.lit("("), F.get(marks, i), F.lit(") "), e)), " / ")))
    counted = F.size(F.filter(slots, lambda s: F.size(s) > 0))
    return F.concat_ws("\n", F.concat(F.lit("분모: "), counted.cast("string")), *[each(name, k) for k, name in enumerate(SLOTS)])


def judge_variables(title: Column, body: Column, summary: Column, slots: Column) -> Column:
    """Map of the judge prompt's variables (F-19): the source is title and stripped body, the slots are there only where they are labelled."""
    clean = T.strip(F.coalesce(body, F.lit("")))
    source = F.when(clean == "", title).otherwise(F.concat(title, F.lit("\n\n"), clean))
    base = F.create_map(F.lit("source_text"), source, F.lit("summary"), summary)
    return F.when(slots.isNull(), base).otherwise(F.map_concat(base, F.create_map(F.lit("completeness_slots"), render_slots(slots))))


def toast(alerts: DataFrame) -> DataFrame:
    """(title, body) of a notice for the open critical alerts, worst and oldest first; no row without any (F-44)."""
    critical = alerts.where("severity = 'critical'").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("first_seen", "key", "kind", "source", "detail")).alias("a")).where("n > 0")
    where = F.when(F.col("a.source").isNotNull(), F.concat(F.lit(" · "), F.col("a.source"))).otherwise(F.lit(""))
    more = F.when(F.col("n") > 1, F.concat(F.lit(" and "), (F.col("n") - 1).cast("string"), F.lit(" more; see the status note"))).otherwise(F.lit(""))
    return critical.select(F.concat(F.lit("pipeline: "), F.col("n").cast("string"), F.lit(" critical")).alias("title"), F.concat(F.col("a.kind"), where, F.lit(" — "), F.col("a.detail"), more).alias("body"))


def short_hash(content: Column) -> Column:
    """First 16 hex digits over the text with line ends as LF, for scores (F-32)."""
    return F.left(F.sha2(F.replace(content, F.lit("\r\n"), F.lit("\n")), 256), F.lit(16))


def full_hash(content: Column) -> Column:
    """All hex digits over the bytes as they are, for export provenance (F-32)."""
    return F.sha2(content, 256)


def gate_key(prompt: Column, model: Column) -> Column:
    return F.concat_ws("|", prompt, model)


def run_id(prefix: str, at: Column) -> Column:
    """An id that sorts by time (F-40)."""
    return F.concat(F.lit(f"{prefix}-"), F.date_format(at, "yyyyMMdd'T'HHmmss"))


def lenient_moment(text: Column, now: Column) -> Column:
    """A moment, now where the text is none (F-41)."""
    return F.coalesce(F.try_to_timestamp(text), now)


def error_text(text: Column) -> Column:
    return F.left(text, F.lit(500))


def shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("—"))


def published_of(item_id: Column) -> Column:
    """The date that an item id starts with; an error otherwise (F-35)."""
    head = F.split_part(item_id, F.lit("-"), F.lit(1))
    day = F.to_date(F.try_to_timestamp(head, F.lit("yyyyMMdd")))
    return F.when(head.rlike(r"^\d{8}$") & day.isNotNull(), day).otherwise(F.raise_error(F.concat(F.lit("no date in "), item_id)).cast("date"))


def stale(stored: Column, current: Column) -> Column:
    """Whether a stored (prompt, model) struct is another than the current one, nulls included (P-19)."""
    return ~stored.eqNullSafe(current)


def by_prefix(values: DataFrame, table: DataFrame, column: str, out: str) -> DataFrame:
    """First row of table(ord, prefix, out) whose prefix the value starts with; null where none does. table is configuration and broadcast (F-42)."""
    hit = values.join(F.broadcast(table), F.coalesce(F.col(column), F.lit("")).startswith(F.col("prefix")), "left")
    return hit.groupBy(*values.columns).agg(F.min_by(out, "ord").alias(out))


def denied(url: Column, hosts: list[str], fragments: list[str] = ()) -> Column:
    """The first listed host that a URL's host equals or is below, or fragment that it contains; null if none (P-27)."""
    host = U.host_of(F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("//"), url)))
    out = F.lit(None).cast("string")
    for f in reversed(list(fragments)):
        out = F.when(F.contains(host, F.lit(f)), F.lit(f)).otherwise(out)
    for h in reversed(hosts):
        out = F.when((host == h) | host.endswith(f".{h}"), F.lit(h)).otherwise(out)
    return out


def source_names(items: DataFrame, sources: DataFrame) -> DataFrame:
    """items(item_id, url) with the one source, active or retired, of the URL's registrable host; none or several is an error (J-12)."""
    key = lambda c: U.registrable(U.host_of(F.col(c)))
    names = sources.select(key("url").alias("_host"), "name").distinct().groupBy("_host").agg(F.array_sort(F.collect_set("name")).alias("_names"))
    got = items.withColumn("_host", key("url")).join(names, "_host", "left")
    bad = F.concat(F.lit("no single source for "), F.col("url"), F.lit(": "), F.coalesce(F.array_join("_names", ", "), F.lit("none")))
    return got.withColumn("source_name", F.when(F.coalesce(F.size("_names"), F.lit(0)) == 1, F.col("_names")[0]).otherwise(F.raise_error(bad).cast("string"))).drop("_host", "_names")


def missing_labels(golden: DataFrame) -> DataFrame:
    """Items without completeness slots, which a rubric that asks for them cannot judge (P-25)."""
    return golden.where("completeness_slots is null").select("item_id")


def read_predictions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON lines file keyed by item_id: blank lines are skipped, a bad line aborts with its number, the last line of an item wins (S-13)."""
    got = lines.read_keyed(spark, path, schema)
    bad = F.concat(F.element_at(F.split("file", "/"), -1), F.lit(": bad line "), F.col("line").cast("string"), F.lit(" ("), "error", F.lit(")"))
    checked = got.withColumn("record", F.when(F.col("error").isNotNull(), F.raise_error(bad).cast(got.schema["record"].dataType)).otherwise(F.col("record")))
    return checked.groupBy("record.item_id").agg(F.max_by("record", F.struct("file", "line")).alias("r")).select("r.*")


def pool(items: DataFrame, wanted: DataFrame, source: str, order: str, factor: int = 3) -> DataFrame:
    """The first max(n + 5, n * factor) items of each source for its n of wanted(source, n) (L-02)."""
    ranked = items.join(wanted, source).withColumn("_r", F.row_number().over(W.partitionBy(source).orderBy(order)))
    return ranked.where(F.col("_r") <= F.greatest(F.col("n") + 5, F.col("n") * factor)).drop("_r")


def take(items: DataFrame, source: str, order: list[str], usable: Column, budget: int) -> DataFrame:
    """Adds taken: injected items (n null) first, then the first n usable of each source in its order, within one budget (L-03).

    The budget is counted over sources' sums, so no task numbers all items.
    """
    ranked = items.withColumn("_ok", usable).withColumn("_r", F.row_number().over(W.partitionBy(source, "_ok").orderBy(*order)))
    ranked = ranked.withColumn("_in", F.col("_ok") & (F.col("n").isNull() | (F.col("_r") <= F.col("n"))))
    sums = ranked.groupBy(F.col(source).alias("_s"), F.col("n").isNotNull().alias("_later")).agg(F.count_if("_in").alias("_k"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_k").over(W.orderBy("_later", "_s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # a row a source
    out = ranked.join(before.drop("_k"), (F.col(source) == F.col("_s")) & (F.col("n").isNotNull() == F.col("_later")))
    return out.withColumn("taken", F.col("_in") & (F.col("_before") + F.col("_r") <= budget)).drop("_ok", "_r", "_in", "_s", "_later", "_before")


def review_sample(loaded: DataFrame, at: str, size: int = 3, seed: str = "") -> DataFrame:
    """size rows of the 5 * size most recently updated ones, by seeded hash order: the same seed picks the same rows (L-07)."""
    recent = loaded.orderBy(F.desc(at), "doc_id").limit(5 * size)
    return recent.orderBy(F.sha2(F.concat("doc_id", F.lit(seed)), 256)).limit(size)


def scheduled_exit(locked: Column, approved: Column, ready: Column, code: Column) -> Column:
    """Exit code of a scheduled run: lock 6, mismatch 4, not ready 5, else the run's own (O-05)."""
    return F.when(locked, 6).when(~approved, 4).when(~ready, 5).otherwise(code)


def element_consistency(states: Column, held: Column, sizes: Column) -> Column:
    """struct(checked, consistent) of four slots: states as read against those that follow from held of sizes elements (A-14)."""
    derived = F.zip_with(held, sizes, lambda h, n: F.when(n == 0, F.lit(None).cast("string")).when(h == n, "full").when(h > 0, "partial").otherwise("none"))
    pairs = F.filter(F.zip_with(states, derived, lambda s, d: F.struct(s.alias("s"), d.alias("d"))), lambda p: p.s.isNotNull() & (p.s != "excluded") & p.d.isNotNull())
    return F.struct(F.size(pairs).alias("checked"), F.size(F.filter(pairs, lambda p: p.s == p.d)).alias("consistent"))


def status_lines(run: DataFrame, alerts: DataFrame) -> DataFrame:
    """Lines (ord, line) of the status file: key=value head, ---, then open alerts in the order given by ord (S-32)."""
    keys = ("last_run_at", "exit_code", "outcome", "absent_after_hours", "approval_expires")
    head = run.select(F.posexplode(F.array(*[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys], F.lit("---"))).alias("ord", "line"))
    where = F.when(F.col("source").isNotNull(), F.concat(F.lit(" · "), "source")).otherwise(F.lit(""))
    body = alerts.select((F.col("ord") + 100).alias("ord"), F.concat(F.lit("["), "severity", F.lit("] "), "kind", where, F.lit(" — "), "detail", F.lit(" ("), F.col("consecutive").cast("string"), F.lit(")")).alias("line"))
    return head.unionByName(body).orderBy("ord")
