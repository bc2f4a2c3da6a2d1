"""Segmented folds equal the flat ones, whatever the cut and the skew."""

import random
import re

import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import rows
from tidemark.functions import time
from tidemark.operators import lateness, state, windows
from tidemark.operators.scan import (
    balanced_segment,
    first_value,
    last_known,
    last_value,
    previous,
    running,
    running_count,
    running_max,
    running_min,
    running_sum,
    segment_of,
)

KINDS = ["sum", "n", "low", "high", "first", "last", "known", "before"]


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; keys and values may be null."""
    rng = random.Random(7)
    data = []
    for i in range(400):
        key = rng.choice(["hot", "hot", "hot", "a", "b", None])
        value = rng.choice([None, *range(-20, 60)])
        data.append((i * 3 - 100, key, value, 1000 + i * rng.randint(1, 3)))
    return spark.createDataFrame(data, "arr int, k string, v int, ts int").repartition(5).cache()


def _folds():
    v = F.col("v")
    return {
        "sum": running_sum(v), "n": running_count(), "low": running_min(v), "high": running_max(v),
        "first": first_value(v), "last": last_value(v), "known": last_known(v), "before": previous(v),
    }


def _flat(df, keys):
    w = Window.partitionBy(*keys).orderBy("arr")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        "*",
        F.sum("v").over(upto).alias("sum"),
        F.count(F.lit(1)).over(upto).alias("n"),
        F.min("v").over(upto).alias("low"),
        F.max("v").over(upto).alias("high"),
        F.first("v").over(upto).alias("first"),
        F.last("v").over(upto).alias("last"),
        F.last("v", ignorenulls=True).over(upto).alias("known"),
        F.lag("v").over(w).alias("before"),
    )


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("cut", [None, 1, 7, 64, 100_000])
def test_equals_flat_windows(skewed, keys, cut):
    segment = F.floor(F.col("arr") / cut) if cut else None
    found = running(skewed, keys, ["arr"], _folds(), segment)
    assert found.columns == [*skewed.columns, *KINDS]
    assert rows(found) == rows(_flat(skewed, keys))


def test_several_order_columns(skewed):
    df = skewed.withColumn("major", F.floor(F.col("arr") / 10)).withColumn("minor", -F.col("v"))
    df = df.withColumn("minor", F.col("arr"))
    found = running(df, ["k"], ["major", "minor"], _folds(), F.floor(F.col("major") / 3))
    assert rows(found.drop("major", "minor")) == rows(_flat(skewed, ["k"]))


def test_order_is_required(skewed):
    with pytest.raises(ValueError, match="order"):
        running(skewed, ["k"], [], _folds())
    with pytest.raises(ValueError, match="not in the input"):
        running(skewed, ["k"], ["nowhere"], _folds())


def test_default_segments_never_decrease(spark):
    df = spark.createDataFrame([(i * 700_000 - 3_000_000,) for i in range(12)], "n bigint")
    df = df.withColumn("t", F.timestamp_seconds("n")).withColumn("d", F.to_date("t")).withColumn("z", F.col("t").cast("timestamp_ntz"))
    cuts = [segment_of(df, "n"), segment_of(df, "d"), *(balanced_segment(df, c, rows=3) for c in ("n", "t", "z"))]
    for segment in cuts:
        cut = [r[0] for r in df.orderBy("n").select(segment).collect()]
        assert cut == sorted(cut) and len(set(cut)) > 1
    assert {r[0] for r in df.select(segment_of(df, "t")).collect()} == {0}
    assert df.limit(0).select(segment_of(df.limit(0), "t")).collect() == []
    with pytest.raises(ValueError):
        segment_of(df.withColumn("s", F.col("n").cast("string")), "s")


@pytest.mark.parametrize("cut", [1, 9, 100_000])
def test_top_n_equals_brute_force(skewed, cut):
    found = state.running_top_n(skewed, ["k"], "v", ["arr"], 3, F.floor(F.col("arr") / cut))
    held, expected = {}, []
    for r in sorted(skewed.collect(), key=lambda r: r["arr"]):
        best = held.get(r["k"], [])
        if r["v"] is not None:
            best = sorted([*best, r["v"]], reverse=True)[:3]
        held[r["k"]] = best
        expected.append((r["arr"], best))
    assert rows(found, "arr", "top") == sorted(expected, key=repr)


@pytest.mark.parametrize("cut", [1, 13, 200, 100_000])
def test_sessions_equal_sparks(spark, skewed, cut):
    """Including gaps so long that a session spans many segments."""
    df = time.event_time(skewed.where("k IS NOT NULL AND v IS NOT NULL"))
    gap = F.when(F.col("v") == 7, 90).otherwise(F.pmod("v", F.lit(5)) + 1)
    aggs = {"cnt": ("count", F.lit(1)), "total": ("sum", F.col("v")), "low": ("min", F.col("v"))}
    found = windows.session(df, ["k"], "event_time", F.make_dt_interval(secs=gap), aggs, F.floor(F.col("ts") / cut))
    plain = windows.session_stream(
        df, ["k"], "event_time", F.concat(gap.cast("string"), F.lit(" seconds")),
        {"cnt": F.count(F.lit(1)), "total": F.sum("v"), "low": F.min("v")},
    )
    assert rows(found) == rows(plain)


def test_late_classes_partition_the_rows(skewed):
    df = time.event_time(skewed.withColumn("ts", F.col("ts") - F.pmod(F.hash("arr"), F.lit(60))))
    args = ("event_time", ["arr"], "10 seconds", 5, 10, F.floor(F.col("arr") / 50))
    classed = lateness.late_classify(df, *args)
    counts = {r[0]: r[1] for r in classed.groupBy("late_class").count().collect()}
    assert sum(counts.values()) == df.count() and len(counts) == 3
    # Firings cover the accepted rows of every window that was closed.
    fired = lateness.window_firings(df, ["k"], "event_time", ["arr"], "10 seconds", "v", 5, 10, F.floor(F.col("arr") / 50))
    newest = fired.groupBy("k", "window_start").agg(F.max("cnt").alias("cnt"), F.max("window_end").alias("window_end"))
    accepted = classed.where("late_class <> 'dropped'").groupBy("k", "window_start", "window_end").count()
    reached = df.agg((F.max("event_time") - time.seconds(5)).alias("v")).first()[0]
    closed = accepted.where(F.col("window_end") <= F.lit(reached))
    assert rows(newest, "k", "window_start", "cnt") == rows(closed, "k", "window_start", "count")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_single_partition_exchange(skewed, monkeypatch):
    from tidemark.operators import scan

    monkeypatch.setattr(scan, "SEGMENT_ROWS", 1 << 4)
    df = time.event_time(skewed)
    for out in (
        lateness.late_classify(df, "event_time", ["arr"], "10 seconds", 5, 10),
        lateness.watermarks(df, "event_time", ["arr"], 5),
        running(df, ["k"], ["arr"], _folds()),
        state.running_top_n(df, ["k"], "v", ["arr"]),
        state.partition_running_count(df, ["k"], ["arr"]),
    ):
        plan = _plan(out)
        # Only the few per-segment rows of a fold without keys may meet in one place.
        big = set(re.findall(r"Exchange SinglePartition.*(plan_id=\d+)", plan))
        assert len(big) <= 1
        assert "__segment" in plan


def test_without_hot_keys_the_plan_is_one_exchange_and_a_window(skewed):
    plan = _plan(running(skewed, ["k"], ["arr"], _folds()))
    assert plan.count("Exchange hashpartitioning") == 1 and "Union" not in plan and "Join" not in plan


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "v"]])
def test_cutting_hot_keys_only_changes_nothing(skewed, keys, monkeypatch):
    """With a limit between the frequencies of the keys, some are cut by default and others are not."""
    from tidemark.operators import scan

    whole = rows(running(skewed, keys, ["arr"], _folds(), F.floor(F.col("arr") / 10_000)))
    monkeypatch.setattr(scan, "SEGMENT_ROWS", 1 << 4)
    monkeypatch.setattr(scan, "_GROUP_BITS", 1)
    monkeypatch.setattr(scan.segment_of, "__defaults__", (1 << 4,))
    assert rows(running(skewed, keys, ["arr"], _folds())) == whole
    monkeypatch.setattr(scan, "MOST_CUT", 3)
    assert rows(running(skewed, keys, ["arr"], _folds())) == whole


def test_sliding_counts_borrow_over_blocks(skewed, monkeypatch):
    aggs = {"cnt": F.count(F.lit(1)), "total": F.sum("v"), "low": F.min("v")}
    monkeypatch.setattr(windows, "BLOCK_ROWS", 7)
    for size, step in ((1, 1), (5, 2), (7, 3), (20, 1), (3, 10)):
        framed = windows.count_slide(skewed, ["k"], ["arr"], size, step, aggs)
        numbered = running(skewed, ["k"], ["arr"], {"__rn": running_count()})
        assert rows(framed, "k", "firing", *aggs) == rows(windows._copied_slide(numbered, ["k"], size, step, aggs), "k", "firing", *aggs)


def _largest(df, keys, order, spark):
    """Rows of the largest segment, and the number of segments."""
    from tidemark.operators import scan

    cut, _ = scan.with_segment(df, keys, order, None, "__s")
    sizes = cut.groupBy(*keys, "__s").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.count("*").alias("parts")).first()
    return sizes.most, sizes.parts


@pytest.fixture
def small_segments(monkeypatch):
    from tidemark.operators import scan

    monkeypatch.setattr(scan, "SEGMENT_ROWS", 1 << 10)


def test_a_burst_is_split(spark, small_segments):
    """Twenty thousand rows in one second of a month: no segment is much larger than its share."""
    rare = spark.range(3000).selectExpr("id AS n", "'k' AS k", "timestamp_seconds(id * 864) AS at")
    burst = spark.range(20_000).selectExpr("id + 3000 AS n", "'k' AS k", "timestamp_micros(864000000000 + id * 50) AS at")
    df = rare.union(burst)
    most, parts = _largest(df, ["k"], ["at"], spark)
    assert most < 1.5 * (1 << 10) and parts >= 20
    cut = windows.session(df, ["k"], "at", F.expr("INTERVAL 1000 SECONDS"), {"n": ("count", F.col("n"))})
    whole = windows.session(df, ["k"], "at", F.expr("INTERVAL 1000 SECONDS"), {"n": ("count", F.col("n"))}, segment=F.lit(0))
    assert rows(cut) == rows(whole)


def test_ties_in_the_first_order_column_are_split_by_the_others(spark, small_segments):
    """A word in every turn of a few long conversations."""
    df = spark.range(30_000).selectExpr("id % 3 AS conv", "CAST(id / 3 AS int) AS turn", "id % 7 AS pos", "'w' AS word", "id AS v")
    most, parts = _largest(df, ["word"], ["conv", "turn", "pos"], spark)
    assert most < 1.5 * (1 << 10) and parts >= 25
    folds = {"so_far": running_count(), "total": running_sum(F.col("v"))}
    got = running(df, ["word"], ["conv", "turn", "pos"], folds)
    assert rows(got) == rows(running(df, ["word"], ["conv", "turn", "pos"], folds, F.col("conv")))


def test_splitters_take_nulls_wide_orders_and_many_keys(spark, small_segments, monkeypatch):
    from tidemark.operators import scan

    df = spark.range(9000).selectExpr("if(id % 2 = 0, null, 'b') AS k", "if(id < 40, null, id * 1000000000000000) AS a", "id AS b", "id % 5 AS v")
    folds = {"total": running_sum(F.col("v")), "first": first_value(F.col("v")) if "first_value" in globals() else running_sum(F.col("v"))}
    want = rows(running(df, ["k"], ["a", "b"], folds, F.lit(0)))
    assert rows(running(df, ["k"], ["a", "b"], folds)) == want
    monkeypatch.setattr(scan, "MOST_SPLITTERS", 1)
    assert rows(running(df, ["k"], ["b"], {"total": running_sum(F.col("v"))})) == rows(running(df, ["k"], ["b"], {"total": running_sum(F.col("v"))}, F.lit(0)))
