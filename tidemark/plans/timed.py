"""Time windows, top-N, lateness and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import time as TM
from tidemark.operators import joins, lateness, topn, userwindow, windows
from tidemark.plans.inputs import SENSORS, bucket, sensors, table
from tidemark.plans.registry import query

TOP_N = (
    SENSORS
    + f""", p AS (SELECT {bucket('5 HOUR')} AS w, vc FROM s),
w AS (SELECT w AS window_start, vc FROM p UNION ALL SELECT w - INTERVAL 5 HOUR, vc FROM p),
c AS (SELECT window_start, vc, count(*) AS cnt FROM w GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 10 HOUR AS window_end, vc, cnt, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, vc) AS r FROM c) WHERE r <= 2"""
)


@query("window_topn", TOP_N)
def window_topn(spark, sf):
    return topn.window_top_n(sensors(spark, sf), "ts", "vc", "10 hours", "5 hours", 2)


def _aggs():
    return {"cnt": F.count(F.lit(1)), "total": F.sum("vc"), "largest": F.max("vc")}


SQL_AGGS = "count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total, max(vc) AS largest"


@query(
    "tumble_event",
    SENSORS
    + f"SELECT id, {bucket('1 HOUR')} AS window_start, {bucket('1 HOUR')} + INTERVAL 1 HOUR AS window_end, {SQL_AGGS} FROM s GROUP BY 1, 2, 3",
)
def tumble_event(spark, sf):
    return windows.tumble(sensors(spark, sf), ["id"], "ts", "1 hour", _aggs())


@query(
    "slide_event",
    SENSORS
    + f""", p AS (SELECT id, vc, {bucket('5 HOUR')} AS w FROM s),
w AS (SELECT id, vc, w AS window_start FROM p UNION ALL SELECT id, vc, w - INTERVAL 5 HOUR FROM p)
SELECT id, window_start, window_start + INTERVAL 10 HOUR AS window_end, {SQL_AGGS} FROM w GROUP BY 1, 2""",
)
def slide_event(spark, sf):
    return windows.slide(sensors(spark, sf), ["id"], "ts", "10 hours", "5 hours", _aggs())


@query(
    "window_all",
    SENSORS
    + f"SELECT {bucket('6 HOUR')} AS window_start, {bucket('6 HOUR')} + INTERVAL 6 HOUR AS window_end, {SQL_AGGS} FROM s GROUP BY 1, 2",
)
def window_all(spark, sf):
    return windows.tumble(sensors(spark, sf), [], "ts", "6 hours", _aggs())


@query(
    "window_reduce",
    SENSORS
    + f"""SELECT id, {bucket('1 DAY')} AS window_start, {bucket('1 DAY')} + INTERVAL 1 DAY AS window_end,
  arg_max(ts, event_id) AS ts, CAST(sum(vc) AS BIGINT) AS vc FROM s GROUP BY 1, 2, 3""",
)
def window_reduce(spark, sf):
    return windows.window_reduce(sensors(spark, sf), ["id"], "ts", "1 day", "vc", "event_id")


@query(
    "window_aggregate",
    SENSORS
    + f"""SELECT id, {bucket('1 DAY')} AS window_start, {bucket('1 DAY')} + INTERVAL 1 DAY AS window_end,
  CAST(CAST(sum(vc) AS BIGINT) AS VARCHAR) AS result FROM s GROUP BY 1, 2, 3""",
)
def window_aggregate(spark, sf):
    return windows.window_aggregate(sensors(spark, sf), ["id"], "ts", "1 day", "vc")


DAY_TEXT = f"strftime({bucket('1 DAY')}, '%Y-%m-%d %H:%M:%S.%g')"
DAY_END_TEXT = f"strftime({bucket('1 DAY')} + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S.%g')"


@query(
    "window_agg_meta",
    SENSORS
    + f"""SELECT id, {DAY_TEXT} AS window_start, {DAY_END_TEXT} AS window_end,
  CAST(CAST(sum(vc) AS BIGINT) AS VARCHAR) AS result, count(*) AS cnt FROM s GROUP BY 1, 2, 3""",
)
def window_agg_meta(spark, sf):
    return windows.window_agg_meta(sensors(spark, sf), ["id"], "ts", "1 day", "vc")


@query(
    "window_format",
    SENSORS + f"SELECT {DAY_TEXT} AS window_start, {DAY_END_TEXT} AS window_end, count(*) AS cnt FROM s GROUP BY 1, 2",
)
def window_format(spark, sf):
    return windows.window_format(
        windows.tumble(sensors(spark, sf), [], "ts", "1 day", {"cnt": F.count(F.lit(1))})
    )


@query(
    "window_process",
    SENSORS
    + f""", n AS (SELECT *, {bucket('5 DAY')} AS w FROM s),
m AS (SELECT *, row_number() OVER (PARTITION BY id, w ORDER BY event_id) AS rn, count(*) OVER (PARTITION BY id, w) AS cnt FROM n)
SELECT id, w AS window_start, w + INTERVAL 5 DAY AS window_end, (rn - 1) // 1000 AS chunk, cnt,
  string_agg(vc, ',' ORDER BY event_id) AS elements FROM m GROUP BY 1, 2, 3, 4, 5""",
)
def window_process(spark, sf):
    rows = sensors(spark, sf).select("event_id", "id", "ts", "vc")
    lists = windows.window_process(rows, ["id"], "ts", "5 days", ["event_id"], F.col("vc").cast("string"))
    return lists.withColumn("elements", F.array_join("elements", ","))


STREAKS = (
    SENSORS
    + f""", n AS (SELECT event_type, event_id, vc, {bucket('10 DAY')} AS window_start, {bucket('10 DAY')} + INTERVAL 10 DAY AS window_end FROM s),
o AS (SELECT *, CASE WHEN vc >= lag(vc) OVER (PARTITION BY event_type, window_start ORDER BY event_id) THEN 0 ELSE 1 END AS opens FROM n),
g AS (SELECT *, sum(opens) OVER (PARTITION BY event_type, window_start ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no FROM o),
c AS (SELECT event_type, window_start, window_end, no, count(*) AS n FROM g GROUP BY ALL),
w AS (SELECT event_type, window_start, window_end, CAST(sum(n) AS BIGINT) AS rows, max(n) AS streak FROM c GROUP BY 1, 2, 3)
SELECT * FROM w"""
)


def streak():
    """User code over a window: its rows, and the longest run in which values don't fall, in one pass over its parts."""

    def create():
        return None, 0, 0, 0

    def add(state, part):
        last, run, best, n = state
        values = part["vc"].to_numpy()
        falls = [i for i in range(1, len(values)) if values[i] < values[i - 1]]
        if last is None or values[0] < last:
            run = 0
        for low, high in zip([0, *falls], [*falls, len(values)]):
            run = (run if low == 0 else 0) + high - low
            best = max(best, run)
        return values[-1], run, best, n + len(values)

    def close(state):
        return [(state[3], state[2])]

    return create, add, close


@query("window_user_process", STREAKS)
def window_user_process(spark, sf):
    """A user function that sees each window's rows in order, part by part: some windows have more rows than an Arrow batch."""
    rows = userwindow.with_window(sensors(spark, sf).select("event_type", "event_id", "ts", "vc"), "ts", "10 days")
    return userwindow.process_windows(rows, ["event_type"], ["event_id"], "rows bigint, streak bigint", *streak())


# Lateness

PRIOR_MAX = "max(ts) OVER (ORDER BY arr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query("assign_event_time", "SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts, date_trunc('second', ts) AS event_time FROM events")
def assign_event_time(spark, sf):
    """Epoch seconds, and the event time made of them."""
    events = table(spark, sf, "events")
    rows = events.select("event_id", TM.epoch_seconds(events, "ts").alias("ts"))
    return TM.event_time(rows).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("watermark", SENSORS + f"SELECT arr, ts, {PRIOR_MAX} - INTERVAL 600001 MILLISECOND AS watermark FROM s")
def watermark(spark, sf):
    return lateness.watermarks(sensors(spark, sf).select("arr", "ts"), "ts", ["arr"], delay=600)


CLASSED = (
    SENSORS
    + f""", m AS (SELECT *, {PRIOR_MAX} AS mx, {bucket('10 MINUTE')} AS window_start FROM s),
c AS (SELECT *, window_start + INTERVAL 10 MINUTE AS window_end,
  CASE WHEN window_start + INTERVAL 10 MINUTE <= mx - INTERVAL 20 MINUTE THEN 'dropped'
       WHEN window_start + INTERVAL 10 MINUTE <= mx - INTERVAL 10 MINUTE THEN 'late_accepted' ELSE 'on_time' END AS late_class FROM m)
"""
)


@query("late_classify", CLASSED + "SELECT event_id, arr, ts, window_start, window_end, late_class FROM c")
def late_classify(spark, sf):
    rows = sensors(spark, sf).select("event_id", "arr", "ts")
    return lateness.late_classify(rows, "ts", ["arr"], "10 minutes", delay=600, lateness=600)


@query("late_side_output", CLASSED + "SELECT event_id, arr, ts, window_start, window_end FROM c WHERE late_class = 'dropped'")
def late_side_output(spark, sf):
    rows = sensors(spark, sf).select("event_id", "arr", "ts")
    return lateness.late_side_output(rows, "ts", ["arr"], "10 minutes", delay=600, lateness=600)


@query(
    "window_allowed_lateness",
    CLASSED
    + """, fin AS (SELECT max(ts) - INTERVAL 10 MINUTE AS m FROM s),
a AS (SELECT event_type, window_start, window_end, late_class, count(*) OVER w AS cnt, CAST(sum(vc) OVER w AS BIGINT) AS total,
  CAST(sum(CASE WHEN late_class = 'late_accepted' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS lates
  FROM c WHERE late_class <> 'dropped'
  WINDOW w AS (PARTITION BY event_type, window_start, window_end ORDER BY arr ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_type, window_start, window_end, CAST(1 AS BIGINT) AS firing, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total
FROM c, fin WHERE late_class = 'on_time' AND window_end <= m GROUP BY 1, 2, 3
UNION ALL SELECT event_type, window_start, window_end, lates + CASE WHEN cnt > lates THEN 1 ELSE 0 END, cnt, total
FROM a WHERE late_class = 'late_accepted'""",
)
def window_allowed_lateness(spark, sf):
    rows = sensors(spark, sf).select("event_type", "arr", "ts", "vc")
    return lateness.window_firings(rows, ["event_type"], "ts", ["arr"], "10 minutes", "vc", delay=600, lateness=600)


# Unions and joins


def _side(spark, sf, kind, prefix):
    rows = sensors(spark, sf).where(F.col("event_type") == kind)
    return rows.select("id", *(F.col(c).alias(f"{prefix}_{c}") for c in ("event_id", "ts", "vc")))


def _pair(left: str, right: str) -> str:
    return (
        SENSORS
        + f""", l AS (SELECT id, event_id AS l_event_id, ts AS l_ts, vc AS l_vc, arr AS l_arr FROM s WHERE event_type = '{left}'),
r AS (SELECT id, event_id AS r_event_id, ts AS r_ts, vc AS r_vc, arr AS r_arr FROM s WHERE event_type = '{right}')
"""
    )


@query("union_all", SENSORS + "SELECT CAST(vc AS VARCHAR) AS value FROM s UNION ALL SELECT CAST(id AS VARCHAR) FROM s UNION ALL SELECT event_type FROM s")
def union_all(spark, sf):
    rows = sensors(spark, sf)
    return joins.union_all(*(rows.select(F.col(c).cast("string").alias("value")) for c in ("vc", "id", "event_type")))


@query(
    "connect_comap",
    SENSORS
    + """SELECT 'number' AS kind, CAST(vc AS VARCHAR) AS value FROM s
UNION ALL SELECT 'text', c_name FROM customer""",
)
def connect_comap(spark, sf):
    return joins.connect_map(
        sensors(spark, sf),
        table(spark, sf, "customer"),
        {"kind": F.lit("number"), "value": F.col("vc").cast("string")},
        {"kind": F.lit("text"), "value": F.col("c_name")},
    )


@query(
    "equi_join",
    """SELECT o_orderkey AS k, o_custkey, o_totalprice, l_linenumber, l_partkey, l_quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def equi_join(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey", "o_totalprice")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", "l_quantity")
    return joins.equi_join(orders, lines, ["k"])


@query(
    "window_join",
    _pair("click", "view")
    + f"""SELECT l.id, {bucket('6 HOUR', 'l_ts')} AS window_start, {bucket('6 HOUR', 'l_ts')} + INTERVAL 6 HOUR AS window_end,
  l_event_id, l_ts, l_vc, r_event_id, r_ts, r_vc
FROM l JOIN r ON l.id = r.id AND {bucket('6 HOUR', 'l_ts')} = {bucket('6 HOUR', 'r_ts')}""",
)
def window_join(spark, sf):
    l, r = _side(spark, sf, "click", "l"), _side(spark, sf, "view", "r")
    return joins.window_join(l, r, ["id"], "l_ts", "r_ts", "6 hours")


@query(
    "interval_join",
    _pair("click", "purchase")
    + """SELECT l.id, l_event_id, l_ts, l_vc, r_event_id, r_ts, r_vc FROM l JOIN r ON l.id = r.id
AND r_ts BETWEEN l_ts - INTERVAL 2 HOUR AND l_ts + INTERVAL 2 HOUR""",
)
def interval_join(spark, sf):
    l, r = _side(spark, sf, "click", "l"), _side(spark, sf, "purchase", "r")
    return joins.interval_join(l, r, ["id"], "l_ts", "r_ts", -7200, 7200)


JUDGED = (
    _pair("click", "purchase")
    + """, k AS (SELECT l_arr AS arr, l_ts AS lt, CAST(NULL AS TIMESTAMP) AS rt FROM l UNION ALL SELECT r_arr, NULL, r_ts FROM r),
m AS (SELECT arr, max(lt) OVER b AS lm, max(rt) OVER b AS rm FROM k
  WINDOW b AS (ORDER BY arr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
j AS (SELECT arr, CASE WHEN lm IS NULL OR rm IS NULL THEN NULL ELSE least(lm, rm) - INTERVAL 60001 MILLISECOND END AS wm FROM m)
"""
)


def _judged(spark, sf):
    rows = sensors(spark, sf)
    sides = [
        rows.where(F.col("event_type") == kind).select(
            "id", "arr", *(F.col(c).alias(f"{p}_{c}") for c in ("event_id", "ts", "vc"))
        )
        for kind, p in (("click", "l"), ("purchase", "r"))
    ]
    return joins.interval_join_late(*sides, ["id"], "l_ts", "r_ts", ["arr"], -7200, 7200, delay=60)


@query(
    "interval_join_late",
    JUDGED
    + """SELECT l.id, l_arr AS arr, l_event_id, l_ts, l_vc, r_event_id, r_ts, r_vc
FROM l JOIN r ON l.id = r.id AND r_ts BETWEEN l_ts - INTERVAL 2 HOUR AND l_ts + INTERVAL 2 HOUR
JOIN j jl ON jl.arr = l_arr JOIN j jr ON jr.arr = r_arr
WHERE NOT coalesce(l_ts < jl.wm, false) AND NOT coalesce(r_ts < jr.wm, false)""",
)
def interval_join_late(spark, sf):
    return _judged(spark, sf)[0]


@query(
    "interval_join_late_left",
    JUDGED + "SELECT id, l_arr AS arr, l_event_id, l_ts, l_vc FROM l JOIN j ON j.arr = l_arr WHERE l_ts < wm",
)
def interval_join_late_left(spark, sf):
    return _judged(spark, sf)[1]


@query(
    "interval_join_late_right",
    JUDGED + "SELECT id, r_arr AS arr, r_event_id, r_ts, r_vc FROM r JOIN j ON j.arr = r_arr WHERE r_ts < wm",
)
def interval_join_late_right(spark, sf):
    return _judged(spark, sf)[2]


@query(
    "broadcast_threshold",
    SENSORS
    + """SELECT event_id, id, vc, threshold FROM (SELECT event_id, id, vc, event_type,
  coalesce(last_value(CASE WHEN event_type = 'signup' THEN vc END IGNORE NULLS) OVER
  (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS threshold FROM s) WHERE event_type <> 'signup'""",
)
def broadcast_threshold(spark, sf):
    rows = sensors(spark, sf).select("event_id", "id", "vc", "event_type")
    rules = rows.where(F.col("event_type") == "signup").select("event_id", F.col("vc").alias("limit"))
    sensor = rows.where(F.col("event_type") != "signup").drop("event_type")
    return joins.broadcast_threshold(sensor, rules, ["event_id"], "limit")
