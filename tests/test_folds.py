"""Carried folds, rows held back, keyed tables, triggers and user windows over several micro-batches."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import rows
from tidemark.operators import changelog, rolling, state, userwindow
from tidemark.operators.scan import Fold, first_value, last_known, running, running_max, running_min, running_sum
from tidemark.sources.keyed_table import KeyedTable
from tidemark.streaming import folds, keyed, processors, runs, triggers

SCHEMA = "arr int, id string, vc int"


def made(n=60, seed=1):
    r = random.Random(seed)
    return [(i, r.choice(["a", "a", "a", "b", "c", None]), r.choice([None, *range(40)])) for i in range(n)]


def grouped(all_rows, size=13):
    return [all_rows[i : i + size] for i in range(0, len(all_rows), size)]


def run(spark, tmp_path, fold, *args, name="run", kind="rows", schema=None, **options):
    writer = lambda out, checkpoint: fold(*args, out, checkpoint, **options)
    return folds.drained(spark, writer, str(tmp_path / name), schema, kind)


@pytest.mark.parametrize("every", [16, 2])
def test_folds_carry_on_over_micro_batches(spark, stream_of, tmp_path, every):
    data = made()
    stream, batch = stream_of(SCHEMA, *grouped(data)), spark.createDataFrame(data, SCHEMA)
    value = F.col("vc")
    wanted = {
        "total": running_sum(value),
        "low": running_min(value),
        "high": running_max(value),
        "first": first_value(value),
        "last": last_known(value),
        "before": Fold("last", value, before=True),
    }
    schema = SCHEMA + ", total bigint, low int, high int, first int, last int, before int"
    # Cut everywhere, so that what is carried passes through segments too.
    for name, segment in (("plain", None), ("cut", F.floor(F.col("arr") / 4))):
        got = run(spark, tmp_path, folds.fold_stream, stream, ["id"], ["arr"], wanted, name=name, schema=schema, every=every, segment=segment)
        assert rows(got) == rows(running(batch, ["id"], ["arr"], wanted))


def test_named_folds_match_their_batch_forms(spark, stream_of, tmp_path):
    data = made(50, 2)
    stream, batch = stream_of(SCHEMA, *grouped(data)), spark.createDataFrame(data, SCHEMA)
    jumps = run(spark, tmp_path, folds.jump_alert, stream, ["id"], "vc", ["arr"], name="j", schema=SCHEMA + ", last_vc int")
    assert rows(jumps) == rows(state.jump_alert(batch, ["id"], "vc", ["arr"]))
    mean = run(spark, tmp_path, folds.running_avg, stream, ["id"], "vc", ["arr"], name="m", schema=SCHEMA + ", avg double")
    assert rows(mean) == rows(rolling.running_avg(batch, ["id"], "vc", ["arr"]))
    counts = run(spark, tmp_path, folds.running_value_counts, stream, ["id"], "vc", ["arr"], name="v", schema=SCHEMA + ", cnt bigint")
    assert rows(counts) == rows(state.running_value_counts(batch, ["id"], "vc", ["arr"]))
    for name, segment in (("t", None), ("tc", F.floor(F.col("arr") / 5))):
        top = run(spark, tmp_path, folds.running_top_n, stream, ["id"], "vc", ["arr"], name=name, schema=SCHEMA + ", top array<int>", segment=segment)
        assert rows(top) == rows(state.running_top_n(batch, ["id"], "vc", ["arr"]))


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    data = grouped(made(40, 3))
    fold = folds._Folds(spark.createDataFrame(data[0], SCHEMA), ["id"], ["arr"], {"total": running_sum(F.col("vc"))}, str(tmp_path), None, 2, None, None)
    for n, group in enumerate(data):
        for _ in range(2):
            fold.take(spark.createDataFrame(group, SCHEMA), n)
    got = spark.read.schema(SCHEMA + ", total bigint").parquet(f"{tmp_path}/rows").drop("batch")
    whole = spark.createDataFrame([r for g in data for r in g], SCHEMA)
    assert rows(got) == rows(state.running_sum_of(whole, ["id"], "vc", ["arr"]))


def test_counts_go_on_after_a_stop(spark, stream_of, tmp_path):
    """Stopped and resumed in a session with other settings: what had been counted, kept by key, is counted on."""
    data = grouped(made(52, 4))
    counts, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, groups in ((4, data[:2]), (7, data)):
            stream = stream_of(SCHEMA, *groups) if not counts else counts[0]
            counts.append(stream)
            if len(counts) == 2:
                for i, group in enumerate(groups[2:]):
                    spark.createDataFrame(group, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = run(spark, tmp_path, folds.running_count, stream, ["id"], ["arr"], schema=SCHEMA + ", cnt bigint")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    whole = spark.createDataFrame([r for g in data for r in g], SCHEMA)
    assert rows(got) == rows(state.partition_running_count(whole, ["id"], ["arr"]))


TIMED = "arr int, id string, at timestamp, vc int"


def disordered(n=60, late=(), seed=5):
    """A row every ten seconds, up to four places late; the rows ``late`` come at the very end."""
    r = random.Random(seed)
    order = sorted(range(n), key=lambda i: (i in late, i + r.randrange(5)))
    return [(i, r.choice("ab"), 1_700_000_000 + 10 * i, r.randrange(40)) for i in order]


def timed(spark, data):
    return spark.createDataFrame(data, "arr int, id string, s bigint, vc int").select("arr", "id", F.timestamp_seconds("s").alias("at"), "vc")


def timed_stream(stream_of, data):
    raw = stream_of("arr int, id string, s bigint, vc int", *grouped(data, 11))
    return raw.select("arr", "id", F.timestamp_seconds("s").alias("at"), "vc")


def test_rows_held_back_are_folded_in_event_time(spark, stream_of, tmp_path):
    data = disordered(late=(20, 21))
    hold = folds.HoldBack("at", 60)
    got = run(spark, tmp_path, folds.jump_alert, timed_stream(stream_of, data), ["id"], "vc", ["arr"], hold=hold, schema=TIMED + ", last_vc int", every=2)
    high = max(r[2] for r in data)
    done = timed(spark, [r for r in data if r[2] <= high - 60 and r[0] not in (20, 21)])
    assert rows(got) == rows(state.jump_alert(done, ["id"], "vc", ["at", "arr"]))
    late = spark.read.schema(TIMED).parquet(str(tmp_path / "run" / "out" / "late"))
    assert [r[0] for r in rows(late, "arr")] == [20, 21]


def test_user_code_sees_event_time_and_its_late_rows(spark, stream_of, tmp_path):
    data = disordered(late=(20, 21))
    stream = timed_stream(stream_of, data).withWatermark("at", "60 seconds").withColumn("ms", F.unix_millis("at"))

    def on_row(context, held, row):
        context.register(row["ms"] + 25_000)
        if row["vc"] % 7 == 0:
            context.cancel(row["ms"] + 25_000)
        context.emit("row", row["arr"], held[0] if held else None)
        return (row["arr"],)

    def on_timer(context, held, at_ms):
        context.emit("timer", at_ms // 1000 - 1_700_000_000, held[0])
        return held

    def on_late(context, held, row):
        context.emit("late", row["arr"], None)
        return held

    out = keyed.process(stream, ["id"], ["arr"], "arr int", "a int, b int", on_row, on_timer, hold="ms", on_late=on_late)
    got = runs.drain_to_table(out, "x", path=str(tmp_path / "out"))
    mark = (max(r[2] for r in data) - 1_700_000_000) - 60
    want = [("late", next(r[1] for r in data if r[0] == i), i, None) for i in (20, 21)]
    for key in "ab":
        own = sorted(r for r in data if r[1] == key and r[0] not in (20, 21) and 10 * r[0] < mark)
        before = None
        for r in own:
            want.append(("row", key, r[0], before))
            before = r[0]
        for at in sorted({10 * r[0] + 25 for r in own if r[3] % 7}):
            if at < mark:
                want.append(("timer", key, at, max(r[0] for r in own if 10 * r[0] <= at)))
    assert rows(got, "tag", "id", "a", "b") == sorted(want, key=repr)


class Calls:
    """A share's state, and how often it is asked for anything."""

    def __init__(self):
        self.made, self.lists, self.value, self.timers = 0, [], None, set()

    def __getattr__(self, name):
        def call(*args):
            self.made += 1
            if name == "appendList":
                self.lists += args[0]
            elif name == "put":
                self.lists = list(args[0])
            elif name == "clear":
                self.lists = []
            elif name == "update":
                self.value = args[0]
            elif name == "registerTimer":
                self.timers.add(args[0])
            return self if name.startswith("get") and name != "get" else None

        return call


@pytest.fixture
def one_share(spark, monkeypatch):
    """Runs what ``keyed.process`` makes of user code over a share's micro-batches of (id, ms, n), and counts its calls."""
    import pyarrow as pa

    caught, handle, held, kept = [], Calls(), Calls(), Calls()
    held.get, kept.get = lambda: iter(held.lists), lambda: kept.value
    handle.getListState, handle.getValueState = lambda *_: held, lambda *_: kept
    monkeypatch.setattr(keyed, "_apply", lambda df, keys, processor, schema, mode: caught.append(processor) or spark.createDataFrame([], schema))

    def batch(mark, given):
        (shares,) = caught
        shares.init(handle)
        times = type("Times", (), {"getCurrentWatermarkInMs": lambda self: mark})()
        columns = [pa.array(c, t) for c, t in zip(zip(*given), (pa.int64(), pa.int64(), pa.int32()))]
        whole = pa.record_batch([*columns, pa.array([3] * len(given), pa.int32())], names=["id", "ms", "n", "__share"])
        found = [r for part in processors.packed("__share")(iter([whole.slice(0, 50), whole.slice(50)])) for r in part.to_pylist()]
        assert [r["share"] for r in found] == [3]
        out = list(shares.handleInputRows((3,), iter(found), times))
        for at in sorted(t for t in handle.timers if t < mark):
            out += shares.handleExpiredTimer((3,), times, None)
            handle.timers.discard(at)
        return sorted(tuple(r.values()) for block in out for r in block["rows"].as_py())

    return spark.createDataFrame([], "id bigint, ms bigint, n int"), batch, lambda: handle.made + held.made + kept.made


def test_rows_of_many_keys_wait_with_few_calls_to_the_state(one_share):
    """As many as a share needs, however many keys it has: a call takes longer than a row."""
    df, batch, calls = one_share

    def on_row(context, state, row):
        context.register(row["ms"] // 100 * 100 + 100)
        return ((state or (0,))[0] + row["n"],)

    def on_timer(context, state, at_ms):
        context.emit("sum", at_ms, state[0])
        return state

    keyed.process(df, ["id"], ["n"], "total bigint", "at_ms bigint, total bigint", on_row, on_timer, hold="ms")
    keys = range(2000)
    assert batch(0, [(k, 10 + k % 50, k) for k in keys]) == []
    assert batch(60, [(k, 80, 1) for k in keys]) == []
    assert batch(150, [(k, 220, 7) for k in keys if k % 2]) == [(k, "sum", 100, k + 1) for k in keys]
    assert batch(301, [(0, 350, 0)]) == [(k, "sum", 300, k + 8) for k in keys if k % 2]
    assert calls() < 30


def test_windows_of_many_keys_fire_with_few_calls_to_the_state(one_share):
    df, batch, calls = one_share
    add = lambda held, row: (held[0] + 1, held[1] + row["n"])
    triggers.trigger_window(df, ["id"], ["n"], triggers.EventTime(100), "cnt bigint, total bigint", lambda: (0, 0), add, time_ms="ms")
    keys = range(2000)
    assert batch(0, [(k, 10 + k % 50, k) for k in keys]) == []
    assert batch(60, [(k, 80, 1) for k in keys]) == []
    assert batch(150, [(k, 220, 7) for k in keys if k % 2]) == [(k, "fire", 1, 2, k + 1) for k in keys]
    assert batch(301, [(0, 350, 0)]) == [(k, "fire", 2, 3, k + 8) for k in keys if k % 2]
    assert calls() < 30


def test_a_drain_keeps_its_state_in_few_partitions(spark, stream_of, tmp_path):
    """Bounded micro-batches need no more for a larger table; the session's own number is as before."""
    stream = stream_of("arr int, id string", [(1, "a"), (2, "b"), (3, "a")])
    spark.conf.set("spark.sql.shuffle.partitions", 5)
    for most, want in ((2, 2), (9, 5), (None, 5)):
        path = tmp_path / f"most-{most}"
        got = runs.drain_to_table(keyed.running_count(stream, ["id"], ["arr"]), "x", path=str(path), partitions=most)
        assert rows(got) == [(1, "a", 1), (2, "b", 1), (3, "a", 2)]
        assert len([p for p in (path / "checkpoint" / "state" / "0").iterdir() if p.name.isdigit()]) == want
        assert spark.conf.get("spark.sql.shuffle.partitions") == "5"


def test_rows_wait_by_keys_and_columns_of_any_type(stream_of, tmp_path):
    """Equal keys as Spark has them (null, NaN, -0.0, lists, times), and columns that are structs or maps."""
    nan, data = float("nan"), []
    for i, k in enumerate([None, nan, 0.0, 1.5, nan, -0.0, None, 1.5, 0.0]):
        data.append((i, k, [i % 2], 1_700_000_000 + i))
    stream = stream_of("arr int, k double, l array<int>, s bigint", data[5:] + data[:2], data[2:5], [(i + 20, k, l, s + 1000) for i, k, l, s in data], [(99, 9.0, [9], 1_700_009_000)])
    stream = stream.select("arr", "k", "l", F.timestamp_seconds("s").alias("at"), F.struct("arr").alias("t"), F.create_map(F.lit("x"), "arr").alias("m"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("u"))
    stream = stream.withWatermark("at", "60 seconds").withColumn("ms", F.unix_millis(F.col("at")))

    def on_row(context, held, row):
        n = held[0] + 1 if held else 1
        assert held is None or held[2].arr < row["arr"]
        context.emit("row", row["arr"], n, row["t"].arr + dict(row["m"])["x"], row["at"].tzinfo is None and held != (0, None))
        return n, row["at"], row["t"]

    out = keyed.process(stream, ["k", "l", "u"], ["arr"], "n int, last timestamp, t struct<arr:int>", "arr int, n int, twice int, plain boolean", on_row, hold="ms")
    got = runs.drain_to_table(out, "x", path=str(tmp_path / "out"))
    seen, want = {}, []
    for i, k, l, _ in data + [(i + 20, k, l, s) for i, k, l, s in data]:
        own = "nan" if k != k else k, *l
        seen[own] = seen.get(own, 0) + 1
        want.append((i, seen[own], 2 * i, True))
    assert rows(got, "arr", "n", "twice", "plain") == sorted(want, key=repr)
    assert rows(got, "u") == rows(stream.sparkSession.sql("SELECT timestamp_seconds(1700000000) FROM range(18)"))


def _sums(held, row):
    return held[0] + 1, held[1] + (row["vc"] or 0)


def fired(stream, trigger, tmp_path, name, **options):
    add = lambda held, row: (held[0] + 1, held[1] + (row["vc"] or 0))
    out = triggers.trigger_window(stream, ["id"], ["arr"], trigger, "n bigint, total bigint", lambda: (0, 0), add, **options)
    return rows(runs.drain_to_table(out, "x", path=str(tmp_path / name)))


def test_count_triggers(stream_of, tmp_path):
    data = made(40, 6)
    stream = stream_of(SCHEMA, *grouped(data))
    for purge, trigger in ((False, triggers.Count(3)), (True, triggers.Purging(triggers.Count(3)))):
        want = []
        for key in ("a", "b", "c", None):
            values = [r[2] or 0 for r in data if r[1] == key]
            for k in range(3, len(values) + 1, 3):
                part = values[k - 3 : k] if purge else values[:k]
                want.append((key, k // 3, len(part), sum(part)))
        assert fired(stream, trigger, tmp_path, f"count-{purge}") == sorted(want, key=repr)


def test_event_time_triggers(stream_of, tmp_path):
    data = disordered()
    stream = timed_stream(stream_of, data).withWatermark("at", "60 seconds").withColumn("ms", F.unix_millis("at"))
    mark = 10 * max(r[0] for r in data) - 60
    shift = 1_700_000_000 % 100
    for purge in (False, True):
        trigger = triggers.Purging(triggers.EventTime(100_000)) if purge else triggers.EventTime(100_000)
        want = []
        for key in "ab":
            own = sorted((10 * r[0], r[3]) for r in data if r[1] == key)
            ends = sorted({(t + shift) // 100 * 100 + 100 - shift for t, _ in own})
            low = -1
            for k, end in enumerate(e for e in ends if e < mark):
                part = [v for t, v in own if low < t <= end]
                want.append((key, k + 1, len(part), sum(part)))
                low = end if purge else -1
        assert fired(stream, trigger, tmp_path, f"time-{purge}", time_ms="ms") == sorted(want, key=repr)
    with pytest.raises(ValueError):
        triggers.trigger_window(stream, ["id"], ["arr"], triggers.EventTime(1), "n bigint", lambda: (0,), _sums)


def test_clock_triggers():
    class Context:
        now, timers = 1000, []

        def register(self, at):
            self.timers.append(at)

    context, trigger = Context(), triggers.Clock(500)
    action, held = trigger.on_row(context, 0, None)
    assert action == triggers.GO_ON and held == 1500 == context.timers[0]
    assert trigger.on_row(context, held, None) == (triggers.GO_ON, 1500) and context.timers == [1500]
    assert trigger.on_timer(context, held, 1500) == (triggers.FIRE, 0)
    assert triggers.Purging(trigger).on_timer(context, held, 1500) == (triggers.FIRE_AND_PURGE, 0)
    assert triggers.Purging(trigger).clock == "processingTime"


def test_keyed_table_over_batches(spark, tmp_path):
    schema = T._parse_datatype_string("k string, v int")
    table, want, r = KeyedTable(spark, str(tmp_path), ["k"], schema, every=3), {}, random.Random(7)
    for n in range(11):
        changed = {k: r.choice([None, r.randrange(99)]) for k in r.sample(["a", "b", "c", "d", None], 2)}
        gone = {k for k in changed if r.random() < 0.3}
        for _ in range(r.choice([1, 2])):
            table.begin(n)
            assert rows(table.read(n)) == sorted(want.items(), key=repr) and (n == 0 or rows(table.view(n - 1)) == rows(table.read(n)))
            df = spark.createDataFrame([(k, v, k in gone) for k, v in changed.items()], "k string, v int, dead boolean")
            table.write(n, df, F.col("dead"))
        want = {k: v for k, v in {**want, **changed}.items() if k not in gone}
    only = spark.createDataFrame([("a",), (None,)], "k string")
    table.begin(11)
    assert rows(table.read(11, only)) == sorted((x for x in want.items() if x[0] in ("a", None)), key=repr)


def test_change_log_as_a_stream(spark, stream_of, tmp_path):
    r = random.Random(8)
    log = [(i, r.choice(["a", "b", "c", None]), r.randrange(9), r.choice(["insert", "update", "delete"])) for i in range(40)]
    schema = "seq int, k string, v int, op string"
    stream = stream_of(schema, *grouped(log, 7))
    path = str(tmp_path / "table")
    runs.drain(changelog.apply_stream(stream, ["k"], "seq", path, str(tmp_path / "check"), every=2))
    got = changelog.stored(spark, path, ["k"], stream.schema, every=2)
    assert rows(got) == rows(changelog.latest(spark.createDataFrame(log, schema), ["k"], "seq"))


def longest():
    def add(held, part):
        assert len(part) <= 1000
        return held + [len(part)]

    return list, add, lambda held: [(sum(held), len(held))]


def test_a_window_larger_than_a_batch_comes_in_parts(spark):
    df = spark.range(4300).selectExpr("id AS arr", "if(id % 43 = 0, null, 'k') AS k", "timestamp_seconds(id % 10) AS at")
    df = userwindow.with_window(df.union(spark.sql("SELECT 1L, 'none', CAST(null AS timestamp)")), "at", "1 minute")
    got = userwindow.process_windows(df, ["k"], ["arr"], "n bigint, parts bigint", *longest())
    found = {r.k: (r.n, r.parts) for r in got.collect()}
    assert found[None][0] == 100 and found["k"][0] == 4200 and found["k"][1] >= 5 and set(found) == {None, "k"}
    assert userwindow.process_windows(df.where("false"), ["k"], ["arr"], "n bigint, parts bigint", *longest()).count() == 0


def test_user_windows_of_a_stream_close_once(spark, stream_of, tmp_path):
    data = disordered(late=(2,))
    stream = userwindow.with_window(timed_stream(stream_of, data), "at", "100 seconds")
    schema = "id string, window_start timestamp, window_end timestamp, n bigint, parts bigint"
    got = run(spark, tmp_path, userwindow.process_window_stream, stream, ["id"], "at", ["arr"], "n bigint, parts bigint", *longest(), 60, schema=schema)
    batch = userwindow.with_window(timed(spark, [r for r in data if r[0] != 2]), "at", "100 seconds")
    high = max(r[2] for r in data)
    closed = batch.where(F.col("window_end") <= F.timestamp_seconds(F.lit(high - 60)))
    want = userwindow.process_windows(closed, ["id"], ["arr"], "n bigint, parts bigint", *longest())
    assert rows(got, "id", "window_start", "n") == rows(want, "id", "window_start", "n") != []
    assert rows(spark.read.schema("arr int").parquet(str(tmp_path / "run" / "out" / "late")), "arr") == [(2,)]


def squares():
    return lambda: 0, lambda held, part: held + int((part["vc"].fillna(0).astype("int64") ** 2).sum()), lambda a, b: a + b, lambda held: held


@pytest.mark.parametrize("every", [2, 16])
def test_user_folds_merge_what_they_held(spark, stream_of, tmp_path, every):
    from tidemark.streaming import userfolds

    data = made(50, 9)
    stream, batch = stream_of(SCHEMA, *grouped(data)), spark.createDataFrame(data, SCHEMA)
    root = str(tmp_path / "run")
    runs.drain(userfolds.custom_fold_stream(stream, ["id"], *squares(), "bigint", f"{root}/out", f"{root}/checkpoint", every=every))
    found = spark.read.schema("id string, result bigint, batch bigint").parquet(f"{root}/out/rows")
    newest = found.groupBy("id").agg(F.max_by("result", "batch").alias("result"))
    assert rows(newest) == rows(rolling.custom_fold(batch, ["id"], *squares(), "bigint"))


def test_user_folds_of_windows_close_once(spark, stream_of, tmp_path):
    from tidemark.streaming import userfolds

    data = disordered(late=(2,))
    stream = userwindow.with_window(timed_stream(stream_of, data), "at", "100 seconds")
    keys, schema = ["id", "window_start", "window_end"], "id string, window_start timestamp, window_end timestamp, result bigint"
    closing = folds.HoldBack("at", 60, "window_end")
    got = run(spark, tmp_path, userfolds.custom_fold_stream, stream, keys, *squares(), "bigint", closing=closing, every=2, schema=schema)
    batch = userwindow.with_window(timed(spark, [r for r in data if r[0] != 2]), "at", "100 seconds")
    high = max(r[2] for r in data)
    closed = batch.where(F.col("window_end") <= F.timestamp_seconds(F.lit(high - 60)))
    assert rows(got) == rows(rolling.custom_fold(closed, keys, *squares(), "bigint")) != []
    assert rows(spark.read.schema("arr int").parquet(str(tmp_path / "run" / "out" / "late")), "arr") == [(2,)]
    with pytest.raises(ValueError):
        userfolds.custom_fold_stream(stream, ["id"], *squares(), "bigint", "x", "y", closing=closing)
