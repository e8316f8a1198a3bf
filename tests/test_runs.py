"""Recorded calls, run history and marks, numbered lines, silence timers and paper batches on small inputs."""

import datetime as dt
import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tessera.operators import calls as C
from tessera.operators import feeds as feed_ops
from tessera.operators import flow
from tessera.sources import history as H
from tessera.sources import lines, papers
from tessera.streaming import silence

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import test modules


def logged(path, answer):
    """A client that writes down each call before it answers."""
    def client(item):
        with open(path, "a") as f:
            f.write(f"{item['id']}\n")
        return answer(item)

    return client


def called(path):
    return [int(x) for x in open(path).read().split()] if os.path.exists(path) else []


def outcome_of(item):
    if item["kind"] == "t":
        raise ConnectionError("down" * 300)
    if item["kind"] == "s":
        raise C.SchemaMismatch("odd")
    if item["kind"] == "x":
        raise C.EgressBlocked("elsewhere")
    return "{}"


def calls_of(spark, **groups):
    rows = [(g, i * 100 + n, k) for i, g in enumerate(groups) for n, k in enumerate(groups[g])]
    return spark.createDataFrame(rows, "source string, id long, kind string")


@pytest.mark.parametrize("step", [1, 3, 50])
def test_breaker_stops_the_calls_themselves(spark, tmp_path, step):
    df = calls_of(spark, a="oottsto", b="ttottt" + "o" * 9, c="tststo", d="ooo")
    log = str(tmp_path / "log")
    got = C.guarded(df, logged(log, outcome_of), ["source"], ["id"], "id", str(tmp_path / "w"), step=step)
    left = {r.source: (r.calls, r.left, r.tripped) for r in C.tripped(got, ["source"]).collect()}
    assert left == {"a": (6, 1, True), "b": (6, 9, True), "c": (5, 1, True), "d": (3, 0, False)}
    assert len(called(log)) == 20 and len(set(called(log))) == 20
    assert max(len(r.error or "") for r in got.collect()) == 500
    again = C.guarded(df, logged(log, outcome_of), ["source"], ["id"], "id", str(tmp_path / "w"), step=step)
    assert len(called(log)) == 20 and sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_a_lost_driver_goes_on_at_the_next_slice(spark, tmp_path):
    df, log, at = calls_of(spark, a="ttoottto", b="oooooooo"), str(tmp_path / "log"), str(tmp_path / "w")

    def lost(item):
        if item["id"] % 100 == 5:
            raise C.EgressBlocked("the run ends here")
        return outcome_of(item)

    with pytest.raises(Exception, match="the run ends here"):
        C.guarded(df, logged(log, lost), ["source"], ["id"], "id", at, step=2)
    before = called(log)
    got = C.guarded(df, logged(log, outcome_of), ["source"], ["id"], "id", at, step=2)
    after = called(log)[len(before) :]
    assert {i for i in before if i % 100 < 4}.isdisjoint(after) and {r.source: r.calls for r in C.tripped(got, ["source"]).collect()} == {"a": 7, "b": 8}


def test_blocked_egress_ends_the_run(spark, tmp_path):
    with pytest.raises(Exception, match="EgressBlocked"):
        C.guarded(calls_of(spark, a="ox"), outcome_of, ["source"], ["id"], "id", str(tmp_path / "w"))


def test_no_items_and_null_groups(spark, tmp_path):
    none = calls_of(spark, a="o").limit(0)
    assert C.guarded(none, outcome_of, ["source"], ["id"], "id", str(tmp_path / "n")).count() == 0
    odd = spark.createDataFrame([(None, 1, "t"), (None, 2, "t"), (None, 3, "t"), (None, 4, "o"), ("a", 5, "o")], "source string, id long, kind string")
    got = {r.source: (r.calls, r.left) for r in C.tripped(C.guarded(odd, outcome_of, ["source"], ["id"], "id", str(tmp_path / "o"), step=2), ["source"]).collect()}
    assert got == {None: (3, 1), "a": (1, 0)}


def test_one_correction(spark, tmp_path):
    log, at = str(tmp_path / "log"), str(tmp_path / "w")

    def client(item):
        if item["kind"] == "t":
            raise TimeoutError
        fine = item["kind"] == "good" or (item["kind"] == "late" and item["error"])
        return json.dumps({"impact": 3}) if fine else json.dumps({"impact": 9}) if item["kind"] == "range" else "not json"

    df = spark.createDataFrame([(i, k) for i, k in enumerate(("good", "late", "never", "t", "range"))], "id long, kind string")
    run = lambda: {r.kind: (r.attempts, r.error, r.value and r.value.impact) for r in C.corrected(df, logged(log, client), "impact int", at, fits=lambda v: v.impact.between(1, 5)).collect()}
    want = {"good": (1, None, 3), "late": (2, None, 3), "never": (2, "schema", None), "t": (1, "transport", None), "range": (2, "schema", None)}
    assert run() == want and sorted(called(log)) == [0, 1, 1, 2, 2, 3, 4, 4]
    raw = spark.read.parquet(f"{at}/attempt=1")
    assert {r.response for r in raw.where("kind = 'never'").collect()} == {"not json"}  # what failed to parse is kept
    assert run() == want and len(called(log)) == 8  # nothing is called again


def test_judgements_resume(spark, tmp_path):
    log, at = str(tmp_path / "log"), str(tmp_path / "w")
    df = spark.range(30).select("id", F.lit("x").alias("kind"))
    cut = {"after": 40}

    def broken(item):
        if len(called(log)) > cut["after"]:
            raise C.EgressBlocked("cut off")
        return "4"

    with pytest.raises(Exception, match="cut off"):
        C.judge(df, logged(log, broken), "id", 2, at, parts=6)
    kept = spark.read.parquet(f"{at}/calls").select("id", "repeat").collect()
    assert 0 < len(kept) < 60 and not C.finished(spark, at)
    before = len(called(log))
    got = C.judge(df, logged(log, lambda item: "5"), "id", 2, at, parts=6)
    assert got.count() == 60 == got.select("id", "repeat").distinct().count() and len(called(log)) - before == 60 - len(kept)
    C.finish(got.agg(F.count(F.lit(1)).alias("n")), at)
    C.finish(got.agg((F.count(F.lit(1)) * 2).alias("n")), at)  # replaces itself alone
    assert C.finished(spark, at) and [r.n for r in spark.read.json(f"{at}/summary").collect()] == [120] and C.judge(df, outcome_of, "id", 2, at).count() == 60


def report(run, **more):
    return {"run_id": run, **more}


def put(spark, path, *reports):
    for r in reports:
        H.write_report(spark.read.schema(H.REPORT).json(spark.sparkContext.parallelize([json.dumps(r)])), path, r["run_id"])


def day(n, cutoff, ok, **more):
    return report(f"pipeline-202401{n:02}-000000", window={"s": {"today": f"2024-01-{n:02}", "cutoff": f"2024-01-{cutoff:02}", "window_drained": ok}, **more})


def test_marks_move_only_when_drained(spark, tmp_path):
    path, marks = str(tmp_path / "h"), H.Marks(spark, str(tmp_path / "h"), str(tmp_path / "m"))
    now = lambda: {r.source: (str(r.drained_on), str(r.carry)) for r in marks.table.read().collect()}
    assert marks.settle() == 0
    put(spark, path, day(10, 3, True), day(11, 4, False))
    assert marks.settle() == 2 and now() == {"s": ("2024-01-10", "2024-01-04")}
    put(spark, path, day(12, 2, False))
    # The driver is lost after the report and before the marks: the mark stands, and the next run applies the report.
    assert now() == {"s": ("2024-01-10", "2024-01-04")}
    later = H.Marks(spark, path, str(tmp_path / "m"))
    assert later.settle() == 1 and later.settle() == 0 and now() == {"s": ("2024-01-10", "2024-01-02")}
    (tmp_path / "h" / "run=pipeline-20240113-000000").mkdir()  # a report that was never completed
    put(spark, path, day(14, 9, True, t={"today": "2024-01-14", "cutoff": "2024-01-08", "drained": False}))
    assert later.settle() == 1 and now() == {"s": ("2024-01-14", "None"), "t": ("None", "2024-01-08")}
    back = {r.source: (str(r.drained_on), str(r.carry)) for r in H.windows(spark, path, ["s", "t"], F.lit("2024-01-15").cast("date")).rows.collect()}
    assert back == now()


def test_flags_follow_from_tallies(spark):
    rows = [({},), ({"deferred_gate": 0, "gate_calls": 3},), ({"deferred_gate": 1},), ({"undated_deferred": 2},), ({"deferred_extraction": 1},)]
    got = spark.createDataFrame(rows, "t map<string,bigint>").select(H.drained(F.col("t")).alias("d")).select("d.*").collect()
    assert [tuple(r) for r in got] == [(True, True), (True, True), (False, False), (False, False), (True, False)]


def test_lookup_reads_the_newest_first_and_stops(spark, tmp_path):
    path = str(tmp_path / "h")
    for n in range(1, 21):
        backlog = {"a": {"head": [f"a{n}"]}} if n > 18 else {"b": {"head": [f"b{n}"], "gate": ["g"]}} if n in (9, 12) else {"c": None, "d": {"head": ["d1"]}} if n == 1 else {}
        put(spark, path, report(f"pipeline-202401{n:02}-000000", backlog=backlog))
    (tmp_path / "h" / "run=pipeline-20240110-000000" / "part-x.json").write_text('{"run_id": ')
    find = lambda names, **more: H.latest(spark, path, "backlog", names, step=3, **more)
    heads = lambda found: {r.source: (r.run_id[-9:-7], r.value.head[0]) for r in found.rows.collect()}
    got = find(["a", "b"])
    assert heads(got) == {"a": ("20", "a20"), "b": ("12", "b12")} and got.reports_read == 9
    assert find(["a"]).reports_read == 3 and find(["d"]).reports_read == 20 and heads(find(["c"], most=5)) == {} and find(["c"], most=5).reports_read == 5
    all_ = H.entries(H.read_runs(spark, path, H.run_ids(spark, path)), "backlog").groupBy("source").agg(F.max_by("value", "run_id").alias("v"))
    assert {r.source: r.v.head[0] for r in all_.collect()} == {s: h for s, (_, h) in heads(find(["a", "b", "c", "d"])).items()}
    gated = find(["a", "b"], value=lambda v: F.when(F.size("value.gate") > 0, v.gate))
    assert [(r.source, r.value) for r in gated.rows.collect()] == [("b", ["g"])]
    assert H.latest(spark, str(tmp_path / "none"), "backlog", ["a"]).rows.count() == 0


def test_lines_have_their_numbers_in_byte_ranges(spark, tmp_path):
    text = "".join(f"line {i}{'x' * (i % 17)}\n" + ("\n" if i % 5 == 0 else "") for i in range(1, 1201))
    (tmp_path / "a.txt").write_text(text)
    (tmp_path / "b.txt").write_text("one\r\ntwo")
    (tmp_path / "empty.txt").write_text("")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = lines.numbered(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        got = {(r.file.rsplit("/", 1)[1], r.line): r.value for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    want = {("a.txt", i): v for i, v in enumerate(text.splitlines(), 1)} | {("b.txt", 1): "one", ("b.txt", 2): "two"}
    assert got == want


def test_silence_fires_like_the_batch_form(spark, tmp_path):
    D, T = lambda n: dt.date(2024, 1, n), lambda n: dt.datetime(2024, 1, n, 9)
    schema = "source string, fetched timestamp, published date, most_days int"
    days = [[("a", T(1), D(1), 2), ("b", T(1), D(1), 5), ("c", T(1), None, 1)], [("b", T(4), D(4), 5), ("b", T(4), D(30), 5)], [("a", T(5), D(5), 2), ("b", T(7), D(7), 5)], [("b", T(9), D(8), 5), ("c", T(9), D(9), 1)], [("b", T(15), D(15), 5)]]
    seen = []
    for rows in days:
        seen += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        silence.run(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        fired = spark.read.schema(silence.OUT).parquet(str(tmp_path / "out"))
        dated = [r for r in seen if r[2] and r[2] <= r[1].date() + dt.timedelta(1)]
        newest = spark.createDataFrame([(s, max(r[2] for r in dated if r[0] == s)) for s in {r[0] for r in dated}], "source string, newest date")
        today = max(r[1] for r in seen).date()
        batch = feed_ops.silence(spark.createDataFrame(dated, schema), ["source", "most_days"], "published", F.lit(today), F.col("most_days"))
        assert {tuple(r) for r in silence.still_silent(fired, newest).collect()} == {(r.source, r.newest) for r in batch.collect()}
    # b, silent from 14 January on, has a new item in the run that would have found it so.
    assert sorted((r.source, str(r.newest)) for r in fired.collect()) == [("a", "2024-01-01"), ("a", "2024-01-05"), ("c", "2024-01-09")]


def entry(i):
    return f"<entry><title>Paper {i}</title><link href='http://arxiv.org/abs/{i}'/><summary>s{i}</summary><published>2024-01-02T00:00:00Z</published></entry>"


def served(log, fails, known):
    def transport(url, timeout):
        ids = url.split("id_list=")[1].split("&")[0].split(",")
        with open(log, "a") as f:
            f.write(f"{len(ids)}\n")
        n = len(called(log))
        if n <= fails:
            return (429, b"", None) if n % 2 else (200, b"<feed xmlns='http://www.w3.org/2005/Atom'></feed>", None)
        return 200, ("<feed xmlns='http://www.w3.org/2005/Atom'>" + "".join(entry(i) for i in reversed(ids) if i in known) + "</feed>").encode(), None

    return transport


def test_paper_batches(spark, tmp_path):
    ids = [f"24{i:02}.1" for i in range(7)]
    wanted = spark.createDataFrame([(i, f"https://arxiv.org/abs/{p}") for i, p in enumerate([*ids, ids[0]])], "ord long, url string").coalesce(1)
    log = str(tmp_path / "log")
    answers = papers.fetch(wanted, transport=served(log, 3, set(ids[:6])), batch=10, delays=(0, 0, 0, 0)).persist()
    rows = papers.outcome(wanted, answers).collect()
    assert [r.paper_id for r in rows] == [*ids, ids[0]] and [r.title for r in rows] == [f"Paper {i}" for i in ids[:6]] + [None, f"Paper {ids[0]}"]
    assert {(r.status, r.attempts) for r in rows} == {("fetched", 4)} and called(log) == [7] * 4
    log2 = str(tmp_path / "log2")
    given_up = papers.outcome(wanted, papers.fetch(wanted, transport=served(log2, 99, set()), batch=3, delays=(0, 0)).persist()).collect()
    assert {(r.status, r.attempts, r.title) for r in given_up} <= {("network_error", 2, None), ("http_error", 2, None)} and len(called(log2)) >= 6
    assert papers.fetch(wanted.limit(0), transport=served(log, 0, set())).count() == 0


def test_window_bounds_from_marks_and_from_history_agree(spark):
    """A carry below the floor caps the window whether or not the drained run before it is looked for."""
    today = F.lit("2024-01-31").cast("date")
    bounds = lambda anchor, carry: flow.window_bounds(today, F.lit(anchor).cast("date"), F.lit(True), F.lit(carry).cast("date"))
    row = spark.range(1).select(bounds("2024-01-25", "2024-01-02").alias("a"), bounds(None, "2024-01-02").alias("b")).first()
    assert row.a == row.b and row.a.capped
