"""Stream forms give what the batch forms give."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import text, time
from tidemark.operators import changelog, joins, lateness, project, rolling, state, topn, windows
from tidemark.streaming import keyed, runs

SENSOR = "arr int, id string, ts bigint, vc int"

GROUPS = [
    [(3, "s1", 4, 9), (1, "s1", 1, 5), (2, "s2", 2, 30)],
    [(5, "s1", 11, 21), (4, "s2", 3, 2)],
    [(8, "s1", 13, 20), (7, "s1", 8, 7), (6, "s2", 9, 14), (9, "s2", 30, 14)],
]
ALL = [r for g in GROUPS for r in g]


@pytest.fixture
def pair(spark, stream_of):
    return spark.createDataFrame(ALL, SENSOR), stream_of(SENSOR, *GROUPS)


def drained(df, label="out"):
    return runs.drain_to_table(df, label)


def test_running_folds(pair):
    batch, stream = pair
    assert rows(drained(keyed.running_count(stream, ["id"], ["arr"]))) == rows(
        state.partition_running_count(batch, ["id"], ["arr"])
    )
    assert rows(drained(keyed.running_sum(stream, ["id"], "vc", ["arr"]))) == rows(
        state.running_sum_of(batch, ["id"], "vc", ["arr"])
    )


def test_running_average_and_reduce(pair):
    batch, stream = pair
    assert rows(drained(keyed.running_avg(stream, ["id"], "vc", ["arr"]))) == rows(
        rolling.running_avg(batch, ["id"], "vc", ["arr"])
    )
    reduced = drained(keyed.rolling_reduce(stream, ["id"], "vc", ["arr"]))
    assert rows(reduced, "arr", "id", "ts", "total") == rows(rolling.rolling_reduce(batch, ["id"], "vc", ["arr"]))


def test_jump_alert(pair):
    batch, stream = pair
    assert rows(drained(keyed.jump_alert(stream, ["id"], "vc", ["arr"]))) == rows(
        state.jump_alert(batch, ["id"], "vc", ["arr"])
    )


def test_list_and_map_state(pair):
    batch, stream = pair
    assert rows(drained(keyed.running_top_n(stream, ["id"], "vc", ["arr"]))) == rows(
        state.running_top_n(batch, ["id"], "vc", ["arr"])
    )
    assert rows(drained(keyed.running_value_counts(stream, ["id"], "vc", ["arr"]))) == rows(
        state.running_value_counts(batch, ["id"], "vc", ["arr"])
    )


def test_count_windows(pair):
    batch, stream = pair
    elements = {"elements": F.transform(F.array_sort(F.collect_list(F.struct("arr", "vc"))), lambda e: e["vc"])}
    slid = windows.count_slide(batch, ["id"], ["arr"], 3, 2, elements)
    assert rows(drained(keyed.count_slide(stream, ["id"], "vc", ["arr"], 3, 2))) == rows(slid)
    tumbled = windows.count_tumble(batch, ["id"], ["arr"], 2, elements)
    assert rows(
        drained(keyed.count_tumble(stream, ["id"], "vc", ["arr"], 2)).withColumn("firing", F.col("firing") - 1)
    ) == rows(tumbled)


def test_event_timer(spark, stream_of):
    groups = [[(1, "s1", 1, 0), (2, "s1", 5, 0)], [(3, "s1", 8, 0)], [(4, "s1", 9, 0)], [(5, "s1", 20, 0)]]
    for refire, expected in ((False, [("s1", 5000, 1)]), (True, [("s1", 5000, 1), ("s1", 5000, 2)])):
        stream = time.event_time(stream_of(SENSOR, *groups, name=f"in{refire}"))
        fired = drained(keyed.event_timer(stream, ["id"], "event_time", 5000, "3 seconds", refire))
        assert rows(fired) == expected


def settled(df, tmp_path, name):
    """Processing-time state asks for batch after batch without end, so the stream is stopped by hand."""
    out = str(tmp_path / name)
    writer = df.writeStream.format("parquet").option("path", out + "/out")
    query = writer.option("checkpointLocation", out + "/check").trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            if sum(p["numInputRows"] for p in query.recentProgress) >= len(ALL):
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    return df.sparkSession.read.schema(df.schema).parquet(out + "/out")


def test_ttl(pair, tmp_path):
    batch, stream = pair
    kept = settled(keyed.ttl_last_value(stream, ["id"], "vc", ["arr"], ttl_ms=3_600_000), tmp_path, "kept")
    endless = state.ttl_last_value(batch, ["id"], "vc", "ts", ["arr"], ttl=10_000)
    assert rows(kept) == rows(endless)


def test_ttl_refreshed_by_reads(pair, tmp_path):
    batch, stream = pair
    marked = stream.withColumn("write", F.col("vc") > 10)
    refreshed = settled(
        keyed.ttl_read_refresh(marked, ["id"], "vc", ["arr"], "write", ttl_ms=3_600_000), tmp_path, "refreshed"
    )
    endless = state.ttl_read_refresh(batch, ["id"], "vc", "ts", ["arr"], F.col("vc") > 10, ttl=10_000)
    assert rows(refreshed, *endless.columns) == rows(endless)


def test_time_windows(spark, stream_of):
    """Append mode closes every window the final watermark has passed."""
    batch = time.event_time(spark.createDataFrame(ALL, SENSOR))
    aggs = {"cnt": F.count(F.lit(1)), "total": F.sum("vc")}
    passed = F.unix_seconds("window_end") <= 30 - 10

    def stream(name):
        return time.event_time(stream_of(SENSOR, *GROUPS, name=name)).withWatermark("event_time", "10 seconds")

    tumbled = windows.tumble(stream("a"), ["id"], "event_time", "10 seconds", aggs)
    assert rows(drained(tumbled)) == rows(windows.tumble(batch, ["id"], "event_time", "10 seconds", aggs).where(passed))
    slid = windows.slide(stream("b"), [], "event_time", "10 seconds", "5 seconds", aggs)
    assert rows(drained(slid)) == rows(windows.slide(batch, [], "event_time", "10 seconds", "5 seconds", aggs).where(passed))
    sessions = windows.session_stream(stream("c"), ["id"], "event_time", "2 seconds", aggs)
    whole = windows.session(
        batch, ["id"], "event_time", time.seconds(2), {"cnt": ("count", F.lit(1)), "total": ("sum", F.col("vc"))}
    )
    assert rows(drained(sessions)) == rows(whole.where(passed))
    gaps = F.concat((F.col("vc") % 5 + 1).cast("string"), F.lit(" seconds"))
    dynamic = windows.session_stream(stream("d"), ["id"], "event_time", gaps, aggs)
    whole = windows.session(
        batch, ["id"], "event_time", F.make_dt_interval(secs=F.col("vc") % 5 + 1),
        {"cnt": ("count", F.lit(1)), "total": ("sum", F.col("vc"))},
    )
    assert rows(drained(dynamic)) == rows(whole.where(passed))


def test_window_functions(spark, stream_of):
    batch = time.event_time(spark.createDataFrame(ALL, SENSOR))
    passed = F.unix_seconds("window_end") <= 20

    def stream(name):
        return time.event_time(stream_of(SENSOR, *GROUPS, name=name)).withWatermark("event_time", "10 seconds")

    for i, op in enumerate(
        (
            lambda d: windows.window_reduce(d, ["id"], "event_time", "10 seconds", "vc", "arr"),
            lambda d: windows.window_aggregate(d, ["id"], "event_time", "10 seconds", "vc"),
        )
    ):
        assert rows(drained(op(stream(f"w{i}")))) == rows(op(batch).where(passed))
    meta = drained(windows.window_agg_meta(stream("m"), ["id"], "event_time", "10 seconds", "vc"))
    expected = windows.window_agg_meta(batch, ["id"], "event_time", "10 seconds", "vc")
    assert rows(meta) == rows(expected.where("window_end <= '1970-01-01 00:00:20.000'"))


def test_top_n(spark, stream_of):
    batch = time.event_time(spark.createDataFrame(ALL, SENSOR))
    stream = time.event_time(stream_of(SENSOR, *GROUPS)).withWatermark("event_time", "10 seconds")
    expected = topn.window_top_n(batch, "event_time", "vc", "10 seconds", "5 seconds", 2)
    counts = topn.window_counts(stream, "event_time", "vc", "10 seconds", "5 seconds")
    found = runs.drain_batches(counts, "top", lambda batch: topn.best_counts(batch, "vc", 2))
    assert rows(found) == rows(expected.where(F.unix_seconds("window_end") <= 20))


def test_processing_time_windows(stream_of):
    aggs = {"cnt": F.count(F.lit(1))}
    for i, op in enumerate((windows.tumble_proc, lambda d, k, s, a: windows.slide_proc(d, k, s, "30 seconds", a))):
        df = op(stream_of(SENSOR, *GROUPS, name=f"p{i}"), ["id"], "60 seconds", aggs)
        counts = runs.drain_updates(df, "proc", ["id", "window_start", "window_end"])
        total = counts.agg(F.sum("cnt")).first()[0]
        assert total == len(ALL) * (i + 1)


def test_word_count_updates(spark, stream_of):
    lines = [[("hello world",), ("hello  there ",)], [("hello",), ("   ",)]]
    words = project.tokenize(stream_of("value string", *lines))
    counts = runs.drain_updates(rolling.word_count(words), "words", ["word"])
    assert rows(counts) == [("", 1), ("hello", 3), ("there", 1), ("world", 1)]


def test_stream_joins(spark, stream_of):
    ls, rs = "k string, l int", "k string, r int, n int"
    left = [[("a", 1), ("a", 2)], [("b", 3), ("c", 4)]]
    right = [[("a", 1, 1), ("a", 3, 3), ("b", 2, 2)], [("b", 5, 5), ("c", 6, 6), ("d", 7, 7)]]

    def side(kind, schema, groups, column, watermark="0 seconds"):
        df = time.event_time(stream_of(schema, *groups, name=kind), column, name=f"{column}_time")
        return df.withWatermark(f"{column}_time", watermark) if watermark else df

    bl = time.event_time(spark.createDataFrame(sum(left, []), ls), "l", name="l_time")
    br = time.event_time(spark.createDataFrame(sum(right, []), rs), "r", name="r_time")
    wide = "100 seconds"
    joined = joins.interval_join(
        side("l1", ls, left, "l", wide), side("r1", rs, right, "r", wide), ["k"], "l_time", "r_time", -2, 2
    )
    batch = joins.interval_join(bl, br, ["k"], "l_time", "r_time", -2, 2)
    assert rows(drained(joined)) == rows(batch)
    joined = joins.window_join(
        side("l2", ls, left, "l", wide), side("r2", rs, right, "r", wide), ["k"], "l_time", "r_time", "15 seconds"
    )
    assert rows(drained(joined)) == rows(joins.window_join(bl, br, ["k"], "l_time", "r_time", "15 seconds"))
    joined = joins.equi_join(side("l3", ls, left, "l", None), side("r3", rs, right, "r", None), ["k"])
    assert rows(drained(joined)) == rows(joins.equi_join(bl, br, ["k"]))


def test_union_and_connect(spark, stream_of):
    a, b = stream_of(SENSOR, *GROUPS, name="a"), stream_of(SENSOR, GROUPS[0], name="b")
    assert rows(drained(joins.union_all(a, b))) == sorted(ALL + GROUPS[0], key=repr)
    mapped = joins.connect_map(
        stream_of(SENSOR, *GROUPS, name="c"), stream_of("word string", [("x",)], name="d"),
        {"value": F.col("vc").cast("string")}, {"value": F.col("word")},
    )
    assert rows(drained(mapped)) == sorted([(str(r[3]),) for r in ALL] + [("x",)], key=repr)


def test_fan_out(spark, stream_of, tmp_path):
    """Side outputs: each row in the output of its tag."""
    routed = project.route(stream_of(SENSOR, *GROUPS), {"s1": F.col("id") == "s1", "s2": F.col("id") == "s2"})

    def sink(name):
        return lambda df, n: df.write.mode("overwrite").parquet(str(tmp_path / "out" / name / f"batch={n}"))

    writer = runs.fan_out(routed, "tag", {t: sink(t) for t in ("s1", "s2", "main")}, str(tmp_path / "check"))
    runs.drain(writer)
    for name in ("s1", "s2"):
        found = spark.read.schema(SENSOR).parquet(str(tmp_path / "out" / name))
        assert rows(found, "arr", "id", "ts", "vc") == sorted([r for r in ALL if r[1] == name], key=repr)


def test_threshold_stream(spark, stream_of, tmp_path):
    schema = "arr int, vc int, rule int"
    groups = [[(1, 5, None), (2, None, 10)], [(3, 20, None)], [(4, None, 5), (5, 8, None)]]
    out = str(tmp_path / "out")
    writer = runs.threshold_stream(
        stream_of(schema, *groups), ["arr"], "rule", ["arr", "vc"], out, str(tmp_path / "check")
    )
    runs.drain(writer)
    found = spark.read.schema("arr int, vc int, threshold int").parquet(out + "/rows")
    assert rows(found, "arr", "vc", "threshold") == [(1, 5, 0), (3, 20, 10), (5, 8, 5)]


def test_dedupe(spark, stream_of):
    stream = time.event_time(stream_of(SENSOR, GROUPS[0], GROUPS[0], GROUPS[1]))
    found = drained(changelog.dedupe(stream, "arr", "event_time", "100 seconds"))
    assert rows(found, "arr") == [(1,), (2,), (3,), (4,), (5,)]


def test_parse_stream(stream_of):
    lines = stream_of("value string", [("s1,1,2",)], [("s2,3,4",)])
    assert rows(drained(text.parse_delimited(lines))) == [("s1", 1, 2), ("s2", 3, 4)]


def test_resume(spark, stream_of, tmp_path):
    """Stopped and started again from its checkpoint: nothing lost, nothing repeated."""
    path = str(tmp_path / "table")
    stream = stream_of(SENSOR, *GROUPS[:2])
    first = runs.drain_to_table(keyed.running_count(stream, ["id"], ["arr"]), "x", path=path)
    assert first.count() == 5
    spark.createDataFrame(GROUPS[2], SENSOR).coalesce(1).write.parquet(str(tmp_path / "late"))
    (part,) = (tmp_path / "late").glob("*.parquet")
    target = tmp_path / "in" / "9999.parquet"
    target.write_bytes(part.read_bytes())
    os.utime(target, (1_800_000_000, 1_800_000_000))
    again = runs.drain_to_table(keyed.running_count(stream, ["id"], ["arr"]), "x", path=path)
    batch = spark.createDataFrame(ALL, SENSOR)
    assert rows(again) == rows(state.partition_running_count(batch, ["id"], ["arr"]))


@pytest.mark.parametrize("name", ["stream_jump_alert", "stream_tumble", "stream_wordcount", "stream_running_sum"])
def test_a_table_is_a_file_or_a_folder(spark, tmp_path, name):
    """The same rows from one file as from a folder of parts, read in several micro-batches."""
    from tidemark.plans.catalog import QUERIES

    source, folder = "/root/testdata/sf0.001", tmp_path / "sf"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for table, order in (("events", "event_id"), ("conversations", "conv_id")):
            parts = spark.read.parquet(f"{source}/{table}.parquet").repartitionByRange(6, order).sortWithinPartitions(order)
            parts.write.parquet(str(folder / f"{table}.parquet"))
            for i, part in enumerate(sorted((folder / f"{table}.parquet").glob("part-*"))):
                os.utime(part, (1_700_000_000 + i, 1_700_000_000 + i))
        assert rows(QUERIES[name](spark, str(folder))) == rows(QUERIES[name](spark, source)) != []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_missing_table_raises(spark, tmp_path):
    from tidemark.streaming.runs import table_stream

    with pytest.raises(FileNotFoundError):
        table_stream(spark, str(tmp_path / "events.parquet"), spark.range(1).schema)


def test_sums_keep_their_type(pair, spark, stream_of):
    values = [(1, "a", 1, None), (2, "a", 2, 100.2), (3, "a", 3, 85.02), (4, "b", 4, None)]
    schema = "arr int, id string, ts bigint, vc double"
    stream = stream_of(schema, values[:2], values[2:], name="doubles")
    found = rows(drained(keyed.running_sum(stream, ["id"], "vc", ["arr"])), "arr", F.round("total", 2))
    assert found == [(1, None), (2, 100.2), (3, 185.22), (4, None)]
    mean = rows(drained(keyed.running_avg(stream, ["id"], "vc", ["arr"])), "arr", F.round("avg", 2))
    assert mean == [(1, None), (2, 100.2), (3, 92.61), (4, None)]


def test_user_process_with_event_timers(spark, stream_of):
    """Alerts as a side output; a timer 10 s after each row, put off by the next one."""
    stream = time.event_time(stream_of(SENSOR, *GROUPS)).withWatermark("event_time", "1 second")

    def on_row(context, state, row):
        if state:
            context.cancel(state[0])
        due = row["ts"] * 1000 + 10_000
        context.register(due)
        if row["vc"] > 20:
            context.emit("alert", row["ts"] * 1000)
        return (due,)

    def on_timer(context, state, at_ms):
        assert context.now >= at_ms
        context.emit("silent", at_ms)
        return None

    done = keyed.process(stream, ["id"], ["arr"], "due bigint", "at_ms bigint", on_row, on_timer, clock="eventTime")
    found = drained(done)
    alerts = [(r[1], r[2] * 1000) for r in ALL if r[3] > 20]
    assert rows(found.where("tag = 'alert'"), "id", "at_ms") == sorted(alerts)
    assert rows(found.where("tag = 'silent'"), "id", "at_ms") == [("s1", 23_000)]


def test_user_process_with_processing_time_timers(stream_of, tmp_path):
    def on_row(context, state, row):
        context.register(context.now + 500)
        return ((state[0] if state else 0) + 1,)

    def on_timer(context, state, at_ms):
        context.emit("fired", state[0])
        return state

    stream = stream_of(SENSOR, ALL)
    done = keyed.process(stream, ["id"], ["arr"], "n bigint", "n bigint", on_row, on_timer, clock="processingTime")
    out = str(tmp_path / "timers")
    writer = done.writeStream.format("parquet").option("path", out + "/out").option("checkpointLocation", out + "/check")
    query = writer.trigger(processingTime="1 second").start()
    found = []
    try:
        for _ in range(60):
            query.awaitTermination(1)
            found = stream.sparkSession.read.schema(done.schema).parquet(out + "/out").collect() if os.path.exists(out + "/out") else []
            if len(found) >= 2:
                break
    finally:
        query.stop()
    assert sorted((r.id, r.tag, r.n) for r in found) == [("s1", "fired", 5), ("s2", "fired", 4)]


@pytest.mark.parametrize("groups", [[ALL], GROUPS, [[r] for r in sorted(ALL)]])
def test_late_rows_and_firings_on_the_clock_of_the_stream(spark, stream_of, tmp_path, groups):
    """However the arrival order is cut into micro-batches, late rows and firings are those of the batch forms."""
    ordered = sorted(ALL)
    cut, at = [], 0
    for g in groups:
        cut.append(ordered[at : at + len(g)])
        at += len(g)
    batch = time.event_time(spark.createDataFrame(ALL, SENSOR))
    stream = time.event_time(stream_of(SENSOR, *cut))
    args = ("event_time", ["arr"], "10 seconds")
    runs.drain(runs.late_stream(stream, *args, 3, 2, f"{tmp_path}/late", f"{tmp_path}/c1"))
    expected = lateness.late_classify(batch, *args, 3, 2)
    found = spark.read.schema(expected.schema).parquet(f"{tmp_path}/late/rows")
    assert rows(found, "arr", "late_class") == rows(expected, "arr", "late_class")
    fired = lateness.window_firings(batch, ["id"], "event_time", ["arr"], "10 seconds", "vc", 3, 20)
    runs.drain(runs.firings_stream(stream, ["id"], "event_time", ["arr"], "10 seconds", "vc", 3, 20, f"{tmp_path}/fire", f"{tmp_path}/c2"))
    found = spark.read.schema(fired.schema).parquet(f"{tmp_path}/fire/rows")
    assert rows(found, *fired.columns) == rows(fired) != []


@pytest.mark.parametrize("files", [1, 3])
def test_late_interval_join_on_the_clock_of_the_stream(spark, stream_of, tmp_path, files):
    rng = random.Random(5)
    data = [(i, rng.choice("ab"), i + rng.randint(-4, 4), rng.choice("lr")) for i in range(60)]
    df = spark.createDataFrame(data, "arr int, k string, ts bigint, side string")
    groups = [data[i : i + 60 // files] for i in range(0, 60, 60 // files)]
    stream = stream_of("arr int, k string, ts bigint, side string", *groups)

    def sides(source):
        timed = time.event_time(source)
        return [
            timed.where(F.col("side") == n).select("k", "arr", F.col("event_time").alias(f"{n}t"), F.col("ts").alias(f"{n}s")) for n in "lr"
        ]

    expected = joins.interval_join_late(*sides(df), ["k"], "lt", "rt", ["arr"], -3, 2, 1)
    tagged = joins.tag_sides(*sides(stream), "lt", "rt", ["arr"])
    runs.drain(runs.interval_join_late_stream(tagged, ["k"], "lt", "rt", -3, 2, 1, f"{tmp_path}/out", f"{tmp_path}/check"))
    pairs = spark.read.schema(expected[0].schema).parquet(f"{tmp_path}/out/pairs")
    assert rows(pairs, *expected[0].columns) == rows(expected[0]) != []
    late = spark.read.schema(tagged.schema).parquet(f"{tmp_path}/out/late")
    for n, want in zip("lr", expected[1:]):
        assert rows(late.where(F.col("side") == n).select(f"{n}.*")) == rows(want) != []


def test_processors_spare_calls_to_the_state(spark):
    """A timer that several rows ask for is set once, and a state is read without asking first whether it is there."""
    from pyspark.sql import Row
    from tidemark.streaming import processors

    class State:
        def __init__(self):
            self.calls, self.held = [], None

        def get(self):
            self.calls.append("get")
            return self.held

        def exists(self):
            self.calls.append("exists")
            return self.held is not None

        def update(self, value):
            self.calls.append("update")
            self.held = value

    class Handle:
        def __init__(self):
            self.state, self.timers = State(), []

        def getValueState(self, name, schema):
            return self.state

        def registerTimer(self, at):
            self.timers.append(at)

        def deleteTimer(self, at):
            self.timers.append(-at)

    class Times:
        def getCurrentWatermarkInMs(self):
            return 0

    def on_row(context, state, row):
        if row["n"] == 4:
            context.cancel(10)
        context.register(10)
        context.register(20)
        context.emit("t", row["n"])
        return ((state or (0,))[0] + 1,)

    handle = Handle()
    run = processors.UserProcessor(["n"], ["k"], "c bigint", ["n"], on_row, None, "eventTime")
    run.init(handle)
    out = list(run.handleInputRows(("a",), iter([Row(k="a", n=n) for n in (3, 1, 2, 4)]), Times()))
    assert out == [Row(k="a", tag="t", n=n) for n in (1, 2, 3, 4)] and handle.state.held == (4,)
    assert handle.timers == [10, 20, -10, 10] and handle.state.calls == ["get", "update"]
    step = processors.StepProcessor(["n"], ["k", "n"], "c bigint", ["c"], lambda s, r: (((s or (0,))[0] + 1,),) * 2, ["c"])
    handle = Handle()
    step.init(handle)
    assert list(step.handleInputRows(("a",), iter([Row(k="a", n=7)]), None)) == [Row(k="a", n=7, c=1)] and handle.state.calls == ["get", "update"]
