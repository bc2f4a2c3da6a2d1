"""Small inputs in arrival order with the results worked out by hand."""

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import rows
from tidemark.functions import schema, text, time
from tidemark.operators import changelog, joins, lateness, partition, project, rolling, state, topn, windows

FOUR = [("s1", 1, 1), ("s1", 11, 11), ("s2", 2, 2), ("s3", 3, 3)]
THREE = [("s1", 1, 1), ("s2", 2, 2), ("s3", 3, 3)]


def in_order(df, *columns):
    return [tuple(r) for r in df.orderBy("arr").select(*columns).collect()]


@pytest.mark.parametrize(
    "operator, expected",
    [
        (rolling.rolling_sum, [("s1", 1, 1), ("s1", 1, 12), ("s2", 2, 2), ("s3", 3, 3)]),
        (rolling.rolling_max, [("s1", 1, 1), ("s1", 1, 11), ("s2", 2, 2), ("s3", 3, 3)]),
        (rolling.rolling_max_by, [("s1", 1, 1), ("s1", 11, 11), ("s2", 2, 2), ("s3", 3, 3)]),
        (rolling.rolling_min, [("s1", 1, 1), ("s1", 1, 1), ("s2", 2, 2), ("s3", 3, 3)]),
        (rolling.rolling_min_by, [("s1", 1, 1), ("s1", 1, 1), ("s2", 2, 2), ("s3", 3, 3)]),
        (rolling.rolling_reduce, [("s1", 1, 1), ("s1", 11, 12), ("s2", 2, 2), ("s3", 3, 3)]),
    ],
)
def test_rolling(sensors, operator, expected):
    df = sensors(*FOUR, parts=3)
    assert in_order(operator(df, ["id"], "vc", ["arr"]), "id", "ts", "vc") == expected
    # The same with every row in a segment of its own.
    assert in_order(operator(df, ["id"], "vc", ["arr"], F.col("arr")), "id", "ts", "vc") == expected


def test_extreme_row_ties_go_to_the_earliest(sensors):
    df = sensors(("s1", 1, 5), ("s1", 2, 5), ("s1", 3, 4), ("s1", 4, 4))
    for segment in (None, F.col("arr")):
        assert in_order(rolling.rolling_max_by(df, ["id"], "vc", ["arr"], segment), "ts") == [(1,)] * 4
        assert in_order(rolling.rolling_min_by(df, ["id"], "vc", ["arr"], segment), "ts") == [(1,), (1,), (3,), (3,)]


def test_average_and_jumps(sensors):
    df = sensors(*FOUR)
    assert in_order(rolling.running_avg(df, ["id"], "vc", ["arr"]), "avg") == [(1.0,), (6.0,), (2.0,), (3.0,)]
    assert rows(state.jump_alert(df, ["id"], "vc", ["arr"])) == []
    first_high = sensors(("s1", 1, 11), ("s1", 2, 22), ("s1", 3, 12))
    assert rows(state.jump_alert(first_high, ["id"], "vc", ["arr"]), "arr", "last_vc") == [(1, 0), (2, 11)]


def test_alerts_keep_the_row(sensors):
    out = project.side_alert(sensors(*FOUR), F.col("vc") > 10, F.lit("high"))
    assert out.where("tag = 'main'").count() == 4
    assert rows(out.where("tag = 'warn'"), "vc", "message") == [(11, "high")]


def test_map_filter_flat_map_route(sensors):
    df = sensors(*THREE)
    assert rows(project.map_rows(df, id=F.col("id"))) == [("s1",), ("s2",), ("s3",)]
    assert rows(project.filter_equal(df, "id", "s1"), "id", "ts", "vc") == [("s1", 1, 1)]
    cases = {"s1": [F.col("vc")], "s2": [F.col("ts"), F.col("vc")]}
    assert rows(project.flat_map_case(df, "id", cases)) == [("1",), ("2",), ("2",)]
    routed = project.route(df, {"s1": F.col("id") == "s1", "s2": F.col("id") == "s2"})
    for tag, expected in (("s1", ("s1", 1, 1)), ("s2", ("s2", 2, 2)), ("main", ("s3", 3, 3))):
        assert rows(project.output(routed, tag), "id", "ts", "vc") == [expected]


def test_null_key_matches_no_filter(sensors):
    assert rows(project.filter_equal(sensors((None, 1, 1)), "id", "s1")) == []


def test_word_counts(spark):
    lines = spark.createDataFrame([(1, "hello world"), (2, "hello spark"), (3, "hello java")], "n int, value string")
    words = project.tokenize(lines, keep=["n"], position="pos")
    assert rows(rolling.word_count(words)) == [("hello", 3), ("java", 1), ("spark", 1), ("world", 1)]
    running = rolling.running_word_count(words, ["n", "pos"])
    assert [tuple(r) for r in running.orderBy("n", "pos").select("word", "cnt").collect()] == [
        ("hello", 1), ("world", 1), ("hello", 2), ("spark", 1), ("hello", 3), ("java", 1),
    ]


def test_token_edges(spark):
    lines = spark.createDataFrame([(1, "a  b  "), (2, " a"), (3, ""), (4, "   ")], "n int, value string")
    words = project.tokenize(lines, keep=["n"], position="pos")
    assert rows(words, "n", "word") == [(1, ""), (1, "a"), (1, "b"), (2, ""), (2, "a"), (3, "")]


def test_odd_even(spark):
    df = spark.createDataFrame([("2",), ("3",), ("-3",), ("-4",)], "value string")
    value = F.col("value").cast("int")
    assert rows(project.even_rows(df, value)) == [("-4",), ("2",)]
    assert rows(project.odd_rows(df, value)) == [("3",)]


def test_union_and_equi_join(spark):
    ints = [spark.createDataFrame([(v,) for v in vs], "value int") for vs in ((1, 2, 3), (11, 22, 33))]
    words = spark.createDataFrame([("111",), ("222",), ("333",)], "value string")
    union = joins.union_all(*ints, words.select(F.col("value").cast("int").alias("value")))
    assert sorted(r[0] for r in union.collect()) == [1, 2, 3, 11, 22, 33, 111, 222, 333]
    left = spark.createDataFrame([(1, "a1"), (1, "a2"), (2, "b"), (3, "c")], "id int, s string")
    right = spark.createDataFrame([(1, "aa1", 1), (1, "aa2", 2), (2, "bb", 1), (3, "cc", 1)], "id int, t string, n int")
    assert rows(joins.equi_join(left, right, ["id"]), "s", "t") == [
        ("a1", "aa1"), ("a1", "aa2"), ("a2", "aa1"), ("a2", "aa2"), ("b", "bb"), ("c", "cc"),
    ]


LEFT = [("a", 1), ("a", 2), ("b", 3), ("c", 4)]


def _sides(spark, left, right):
    l = time.event_time(spark.createDataFrame(left, "k string, l int"), "l", name="lt")
    r = time.event_time(spark.createDataFrame(right, "k string, r int, n int"), "r", name="rt")
    return l, r


def test_window_join(spark):
    l, r = _sides(spark, LEFT, [("a", 1, 1), ("a", 11, 11), ("b", 2, 2), ("b", 12, 12), ("c", 14, 14), ("d", 15, 15)])
    joined = joins.window_join(l, r, ["k"], "lt", "rt", "15 seconds")
    assert rows(joined, "k", "l", "r") == [
        ("a", 1, 1), ("a", 1, 11), ("a", 2, 1), ("a", 2, 11), ("b", 3, 12), ("b", 3, 2), ("c", 4, 14),
    ]


def test_interval_join_bounds_are_inclusive(spark):
    l, r = _sides(spark, LEFT, [("a", 1, 1), ("a", 3, 3), ("b", 2, 2), ("b", 5, 5), ("c", 6, 6), ("d", 7, 7)])
    expected = [("a", 1, 1), ("a", 1, 3), ("a", 2, 1), ("a", 2, 3), ("b", 3, 2), ("b", 3, 5), ("c", 4, 6)]
    assert rows(joins.interval_join(l, r, ["k"], "lt", "rt", -2, 2), "k", "l", "r") == expected
    # Integer seconds take the same path.
    assert rows(joins.interval_join(l, r, ["k"], "l", "r", -2, 2), "k", "l", "r") == expected


@pytest.mark.parametrize("lower, upper", [(-2, 2), (0, 0), (-0.5, 1.5), (1, 3), (-7, -3)])
def test_interval_join_matches_brute_force(spark, lower, upper):
    left = [(f"k{i % 2}", i * 0.3) for i in range(60)]
    right = [(f"k{i % 3}", i * 0.7) for i in range(40)]
    l = spark.createDataFrame(left, "k string, ls double").select("k", F.timestamp_millis(F.round(F.col("ls") * 1000).cast("bigint")).alias("lt"))
    r = spark.createDataFrame(right, "k string, rs double").select("k", F.timestamp_millis(F.round(F.col("rs") * 1000).cast("bigint")).alias("rt"))
    found = joins.interval_join(l, r, ["k"], "lt", "rt", lower, upper).select("k", F.unix_millis("lt"), F.unix_millis("rt"))
    expected = [
        (k, round(a * 1000), round(b * 1000))
        for k, a in left
        for k2, b in right
        if k == k2 and lower * 1000 <= round(b * 1000) - round(a * 1000) <= upper * 1000
    ]
    assert rows(found) == sorted(expected, key=repr)


def test_interval_join_late(spark):
    left = spark.createDataFrame([(1, "a", 4), (3, "a", 10), (5, "a", 3)], "arr int, k string, l int")
    right = spark.createDataFrame([(2, "a", 3, 3), (4, "a", 11, 11), (6, "a", 5, 5)], "arr int, k string, r int, n int")
    l, r = time.event_time(left, "l", name="lt"), time.event_time(right, "r", name="rt")
    for segment in (None, F.col("arr")):
        main, late_l, late_r = joins.interval_join_late(l, r, ["k"], "lt", "rt", ["arr"], -2, 2, 3, segment)
        assert rows(main, "l", "r") == [(10, 11), (4, 3)]
        assert rows(late_l, "k", "l") == [("a", 3)]
        assert rows(late_r, "k", "r", "n") == [("a", 5, 5)]


SERIES = [("s1", t, t) for t in (1, 3, 9, 13, 6, 15, 7)]


@pytest.mark.parametrize("segment", [None, "arr"])
def test_late_classes_and_firings(sensors, segment):
    df = time.event_time(sensors(*SERIES))
    cut = F.col(segment) if segment else None
    marks = lateness.watermarks(df, "event_time", ["arr"], 3, segment=cut)
    assert in_order(marks, F.unix_millis("watermark")) == [
        (None,), (-2001,), (-1,), (5999,), (9999,), (9999,), (11999,),
    ]
    classed = lateness.late_classify(df, "event_time", ["arr"], "10 seconds", 3, 2, cut)
    assert in_order(classed, "late_class") == [(c,) for c in ["on_time"] * 4 + ["late_accepted", "on_time", "dropped"]]
    fired = lateness.window_firings(df, ["id"], "event_time", ["arr"], "10 seconds", "vc", 3, 2, cut)
    assert rows(fired, "firing", "cnt", "total") == [(1, 3, 13), (2, 4, 19)]
    strict = lateness.window_firings(df, ["id"], "event_time", ["arr"], "10 seconds", "vc", 3, 0, cut)
    assert rows(strict, "firing", "cnt") == [(1, 3)]
    assert rows(lateness.late_side_output(df, "event_time", ["arr"], "10 seconds", 3, 2, cut), "ts") == [(7,)]


def test_timer(sensors):
    at = F.timestamp_seconds(F.lit(5))

    def fired(*times):
        df = time.event_time(sensors(*((k, t, t) for k, t in times)))
        return rows(state.event_timer(df, ["id"], "event_time", ["arr"], at, 3))

    def single(*times):
        return len(fired(*(("s1", t) for t in times)))

    assert single(1, 5, 8) == 0
    assert single(1, 5, 8, 9) == 1
    assert single(1, 5, 8, 9, 20) == 1
    # A key first seen after the last advance of the watermark waits for another.
    assert fired(("a", 9), ("b", 8)) == [("a", 1)]
    assert fired(("a", 9), ("b", 8), ("a", 9)) == [("a", 1)]
    assert fired(("a", 9), ("b", 8), ("a", 10)) == [("a", 1), ("b", 2)]


def test_extremes_pass_over_nulls(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 3, 9), ("b", 4, None)], "id string, o int, v int")
    found = rolling.group_aggregate(df, ["id"], "v", ["o"])
    assert rows(found, "id", "first_max", "first_min") == [("a", 3, 1), ("b", None, None)]


def test_extreme_row_by_any_order_type(spark):
    stamps = [(1, "2024-01-01 00:00:00", 4), (1, "2024-01-02 00:00:00", 4), (1, "2024-01-03 00:00:00", 2)]
    df = spark.createDataFrame(stamps, "k int, s string, v int").withColumn("t", F.col("s").cast("timestamp_ntz"))
    best = rolling.rolling_max_by(df.drop("s").withColumn("n", F.dayofmonth("t")), ["k"], "v", ["t"])
    assert rows(best, "n") == [(1,), (1,), (1,)]
    low = spark.createDataFrame([(1, -(1 << 63), "x", 4), (1, 0, "y", 4)], "k int, o long, n string, v int")
    assert rows(rolling.rolling_max_by(low, ["k"], "v", ["o"]), "n") == [("x",), ("x",)]


def test_custom_fold_groups_as_spark_does(spark):
    nan = float("nan")
    keys = [(nan, "a"), (nan, "a"), (0.0, "a"), (-0.0, "a"), (None, "a"), (None, None), (1.5, "b")]
    df = spark.createDataFrame([(*k, i) for i, k in enumerate(keys)], "x double, y string, v int").repartition(3)
    folded = rolling.custom_fold(
        df, ["x", "y"], create=lambda: 0, add=lambda a, b: a + len(b), merge=lambda a, b: a + b, result=lambda a: a, result_type="bigint"
    )
    want = df.groupBy("x", "y").count()
    assert sorted(map(str, folded.collect())) == sorted(map(str, want.withColumnRenamed("count", "result").collect()))


@pytest.mark.parametrize("segment", [None, "arr"])
def test_count_windows(sensors, segment):
    df = sensors(*(("s1", i, i) for i in range(1, 8)))
    cut = F.col(segment) if segment else None
    elements = {"e": F.array_join(F.transform(F.array_sort(F.collect_list("vc")), lambda v: v.cast("string")), ",")}
    assert rows(windows.count_tumble(df, ["id"], ["arr"], 5, elements, cut), "e") == [("1,2,3,4,5",)]
    slid = windows.count_slide(df, ["id"], ["arr"], 5, 2, elements, cut)
    assert rows(slid, "firing", "e") == [(1, "1,2"), (2, "1,2,3,4"), (3, "2,3,4,5,6")]
    sparse = windows.count_slide(df, ["id"], ["arr"], 2, 3, elements, cut)
    assert rows(sparse, "firing", "e") == [(1, "2,3"), (2, "5,6")]


def test_global_trigger(sensors):
    df = sensors(("s1", 1, 1), ("s1", 2, 99), ("s1", 3, 2), ("s1", 4, 3), ("s1", 5, 99), ("s1", 6, 4))
    for segment in (None, F.col("arr")):
        fired = windows.global_trigger(df, ["id"], ["arr"], F.col("vc") == 99, {"cnt": F.count(F.lit(1))}, segment)
        assert rows(fired, "window_no", "cnt") == [(0, 2), (1, 3)]


def test_threshold_known_on_arrival(spark):
    sensor = spark.createDataFrame([(1, 5), (3, 20), (5, 8)], "arr int, vc int")
    rules = spark.createDataFrame([(2, 10), (4, 5)], "arr int, t int")
    for segment in (None, F.col("arr")):
        assert in_order(joins.broadcast_threshold(sensor, rules, ["arr"], "t", segment=segment), "arr", "vc", "threshold") == [
            (1, 5, 0), (3, 20, 10), (5, 8, 5),
        ]


@pytest.mark.parametrize("segment", [None, "arr"])
def test_top_and_counts(sensors, segment):
    df = sensors(*(("s1", i, v) for i, v in enumerate((5, 9, 1, 7, 9))))
    cut = F.col(segment) if segment else None
    top = state.running_top_n(df, ["id"], "vc", ["arr"], 3, cut)
    assert [r[0] for r in in_order(top, "top")] == [[5], [9, 5], [9, 5, 1], [9, 7, 5], [9, 9, 7]]
    assert rows(state.value_count_map(df, ["id"], "vc"), "counts") == [({1: 1, 5: 1, 7: 1, 9: 2},)]
    counts = state.running_value_counts(df, ["id"], "vc", ["arr"], cut)
    assert in_order(counts, "cnt") == [(1,), (1,), (1,), (1,), (2,)]
    assert rows(state.top_n_per_key(df, ["id"], "vc", ["arr"]), "vc", "rank") == [(7, 3), (9, 1), (9, 2)]


def test_state_ttl(sensors):
    df = sensors(("s1", 0, 1), ("s1", 3, 2), ("s1", 9, 3))
    for segment in (None, F.col("arr")):
        kept = state.ttl_last_value(df, ["id"], "vc", "ts", ["arr"], 5, segment)
        assert in_order(kept, "last_vc") == [(None,), (1,), (None,)]


def test_state_ttl_refreshed_by_reads(sensors):
    df = sensors(("s1", 0, 20), ("s1", 3, 1), ("s1", 7, 2), ("s1", 11, 30), ("s1", 12, 3), ("s1", 17, 4))
    for segment in (None, F.col("arr")):
        kept = state.ttl_read_refresh(df, ["id"], "vc", "ts", ["arr"], F.col("vc") > 10, 5, segment)
        assert in_order(kept, "last_vc") == [(None,), (20,), (20,), (20,), (30,), (None,)]


def test_sessions_touching_merge(sensors):
    df = time.event_time(sensors(("s1", 1, 1), ("s1", 6, 2), ("s1", 12, 4)))
    aggs = {"cnt": ("count", F.lit(1)), "total": ("sum", F.col("vc"))}
    for segment in (None, F.col("ts")):
        found = windows.session(df, ["id"], "event_time", time.seconds(5), aggs, segment)
        bounds = found.select(F.unix_seconds("window_start"), F.unix_seconds("window_end"), "cnt", "total")
        assert rows(bounds) == [(1, 11, 2, 3), (12, 17, 1, 4)]


def test_window_functions(sensors):
    df = time.event_time(sensors(("s1", 1, 1), ("s1", 9, 2), ("s1", 12, 4), ("s2", 3, 8)))
    lists = windows.window_process(df, ["id"], "event_time", "10 seconds", ["arr"], F.col("vc"), chunk=1)
    assert rows(lists, "id", "chunk", "cnt", "elements") == [
        ("s1", 0, 1, [4]), ("s1", 0, 2, [1]), ("s1", 1, 2, [2]), ("s2", 0, 1, [8]),
    ]
    meta = windows.window_agg_meta(df, ["id"], "event_time", "10 seconds", "vc")
    assert ("s1", "1970-01-01 00:00:00.000", "1970-01-01 00:00:10.000", "3", 2) in rows(meta)
    reduced = windows.window_reduce(df, ["id"], "event_time", "10 seconds", "vc", "arr")
    assert rows(reduced.select("id", F.unix_seconds("event_time"), "vc")) == [("s1", 12, 4), ("s1", 9, 3), ("s2", 3, 8)]
    top = topn.window_top_n(df, "event_time", "vc", "10 seconds", "5 seconds", 1)
    assert top.groupBy("window_start").count().where("count > 1").count() == 0


def test_change_log(spark):
    log = spark.createDataFrame(
        [(1, "a", "insert", 1), (2, "b", "insert", 2), (1, "A", "update", 3), (2, "b", "delete", 4)],
        "id bigint, name string, op string, seq bigint",
    )
    assert rows(changelog.latest(log, ["id"], "seq")) == [(1, "A", "update", 3)]
    assert changelog.appended(log).count() == 4


def test_parsing(spark):
    good = spark.createDataFrame([("s1,1,2",), ("s2,3,4,extra",)], "value string")
    assert rows(text.parse_delimited(good)) == [("s1", 1, 2), ("s2", 3, 4)]
    bad = spark.createDataFrame([("s1,1,2",), ("s1,x,2",), ("s1",), (None,)], "value string")
    kept = text.parse_delimited(bad, mode="permissive")
    assert kept.where("malformed").count() == 3
    with pytest.raises(Exception, match="malformed line"):
        text.parse_delimited(bad).collect()
    pair = T._parse_datatype_string("k string, ts int")
    assert rows(text.parse_delimited(spark.createDataFrame([("a,1",)], "value string"), pair)) == [("a", 1)]


def test_types(spark):
    assert schema.spark_type("DECIMAL(10,2)") == T.DecimalType(10, 2)
    assert schema.spark_type("VARCHAR(20)") == T.StringType()
    assert schema.spark_type("TIME") == T.IntegerType()
    for name in ("MULTISET", "RAW", "WHATEVER"):
        with pytest.raises(ValueError):
            schema.spark_type(name)
    df = spark.createDataFrame([("1", "2.5")], "a string, b string")
    cast = schema.cast_to_schema(df, schema.table_schema({"b": "DOUBLE", "a": "BIGINT", "c": "BINARY"}))
    assert rows(cast) == [(2.5, 1, None)]


def test_whole_numbers_are_narrowed_as_the_jdbc_converter_does(spark):
    values = [None, 7, -7, 127, 128, 32_767, 32_768, 89_999, -32_769]
    df = spark.createDataFrame([(v, v, v) for v in values], "n bigint, s bigint, t int")
    cast = schema.cast_to_schema(df, schema.table_schema({"n": "BIGINT", "s": "SMALLINT", "t": "TINYINT"}))
    assert [f.dataType for f in cast.schema] == [T.LongType(), T.ShortType(), T.ByteType()]

    def low(v, bits):
        return None if v is None else (v + (1 << bits - 1)) % (1 << bits) - (1 << bits - 1)

    assert rows(cast) == sorted(((v, low(v, 16), low(v, 8)) for v in values), key=repr)
    with pytest.raises(Exception, match="OVERFLOW"):
        schema.cast_to_schema(df.select(F.lit(1 << 40).alias("n")), schema.table_schema({"n": "INTEGER"})).collect()


def test_parsing_other_types_and_separators(spark):
    schema = spark.createDataFrame([], "id string, v double, d date, b boolean").schema
    lines = spark.createDataFrame([("s1^|1.5^|2024-01-02^|true",), ("s2^|-2e3^|2024-1-2^|yes",), ("s3^| 1^|^|",)], "value string")
    found = text.parse_delimited(lines, schema, sep="^|", mode="permissive")
    assert rows(found, "id", "v", F.col("d").cast("string"), "b", "malformed") == [
        ("s1", 1.5, "2024-01-02", True, False), ("s2", -2000.0, None, None, True), ("s3", None, None, None, True),
    ]
    for sep in ("]", "-", "||", "."):
        one = spark.createDataFrame([(sep.join(["a", "7"]),)], "value string")
        assert rows(text.parse_delimited(one, spark.createDataFrame([], "id string, n int").schema, sep=sep)) == [("a", 7)]


def test_malformed_json(spark):
    schema = spark.createDataFrame([], "a int, b string").schema
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, '{"a": 2'), (3, None), (4, '{"a": "no"}'), (5, "{}")], "n int, value string")
    found = text.rows_from_json(df, schema, keep=["n"], mode="permissive")
    assert rows(found, "n", "a", "malformed") == [(1, 1, False), (2, None, True), (3, None, False), (4, None, True), (5, None, False)] or rows(
        found.where("n in (1, 3, 5)"), "n", "a", "malformed"
    ) == [(1, 1, False), (3, None, False), (5, None, False)]
    assert rows(text.rows_from_json(df.where("n in (1, 3, 5)"), schema, keep=["n"]), "n", "a") == [(1, 1), (3, None), (5, None)]
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        text.rows_from_json(df, schema).collect()


def test_nested_types():
    kind = schema.spark_type("ROW<a INTEGER, `b` ARRAY<DECIMAL(10, 2)>, c MAP<VARCHAR(5), ROW<x DATE>>>")
    assert kind.simpleString() == "struct<a:int,b:array<decimal(10,2)>,c:map<string,struct<x:date>>>"
    for bad in ("MAP<INTEGER>", "ROW<INTEGER>", "ARRAY<NOTHING>"):
        with pytest.raises(ValueError):
            schema.spark_type(bad)


def test_event_time_units(spark):
    df = spark.createDataFrame([(5,)], "ts bigint")
    assert rows(time.event_time(df).select(F.unix_millis("event_time"))) == [(5000,)]
    assert rows(time.event_time(df, unit="milliseconds").select(F.unix_millis("event_time"))) == [(5,)]
    with pytest.raises(ValueError):
        time.event_time(df, unit="hours")


def test_partitioning(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    placed = partition.with_partition(partition.by_key(df, 5, "k")).select("k", "partition").distinct()
    assert placed.count() == 7
    placed = partition.with_partition(partition.custom(df, 4, F.col("id") - 500))
    assert placed.where("partition <> pmod(id - 500, 4)").count() == 0
    assert partition.rebalanced(df, 6).rdd.getNumPartitions() == 6
    assert partition.rescaled(df, 2).rdd.getNumPartitions() == 2
    assert partition.shuffled(df, 4).count() == 1000


def test_rich_map_opens_and_closes_once_per_task(spark, tmp_path):
    folder = str(tmp_path)

    def open_():
        import os
        import tempfile

        return tempfile.mkstemp(dir=folder, prefix="open")[1], os.getpid()

    def close(resource):
        import os

        os.rename(resource[0], resource[0] + ".closed")

    df = spark.range(0, 100, 1, 3)
    out = project.rich_map(df, "id bigint", lambda r, b: b.assign(id=b["id"] + 1), open_, close)
    assert out.agg(F.sum("id")).first()[0] == sum(range(1, 101))
    assert len(list(tmp_path.glob("*.closed"))) == 3
    assert len(list(tmp_path.glob("open*"))) == 3


def test_custom_fold_merges_partials(spark):
    df = spark.range(0, 1000, 1, 7).select(F.when(F.col("id") % 3 == 0, "hot").alias("k"), F.col("id").alias("v"))

    def add(acc, batch):
        return (acc[0] + len(batch), max(acc[1], int(batch["v"].max())))

    out = rolling.custom_fold(
        df, ["k"], lambda: (0, -1), add, lambda a, b: (a[0] + b[0], max(a[1], b[1])), lambda a: a[0] * 1000 + a[1],
        "bigint", fan_in=3, max_held=1,
    )
    assert rows(out) == [("hot", 334 * 1000 + 999), (None, 666 * 1000 + 998)]


def test_custom_fold_adds_once_for_a_key_with_few_rows(spark):
    """Keys that come in every part, few rows at a time, beside one that is frequent in each."""
    part = F.spark_partition_id().cast("bigint")
    df = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") % 4 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("v"), part.alias("p"))
    calls = spark.sparkContext.accumulator(0)

    def add(acc, batch):
        calls.add(1)
        return acc[0] + len(batch), acc[1] + int(batch["v"].sum())

    folded = rolling.custom_fold(df, ["k"], lambda: (0, 0), add, lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda a: a[0] * (1 << 40) + a[1], "bigint")
    found = rows(folded)
    assert found == rows(df.groupBy("k").agg((F.count("*") * (1 << 40) + F.sum("v")).alias("result")))
    # One for each key, and one for each part of the frequent key; each part of each key had a call before.
    assert calls.value <= len(found) - 1 + 4
