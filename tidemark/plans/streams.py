"""Stream forms over the standard tables: each drains what is there and reads its sink back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.schema import SENSOR
from tidemark.operators import changelog, joins, project, rolling, topn, userwindow, windows
from tidemark.operators.scan import running_count, running_max, running_sum
from tidemark.plans.inputs import SENSORS, bucket, table
from tidemark.plans.keyed import SOFAR
from tidemark.plans.registry import SQL, query
from tidemark.plans.rows import TOKENS
from tidemark.plans.timed import CLASSED, SQL_AGGS, STREAKS, _pair, streak
from tidemark.session import scratch_path
from tidemark.sources import files, log
from tidemark.sources.tables import typed_table_stream
from tidemark.streaming import folds, keyed, restore, runs, triggers, userfolds


def _stream(spark, sf, name, order=None, slices=0):
    order = F.expr(order) if order else None
    return runs.table_stream(spark, f"{sf}/{name}.parquet", table(spark, sf, name).schema, order, slices=slices)


# The arrival order in which some rows come up to twelve places late.
ARRIVAL = "(event_id + event_id * 7919 % 13) * 13 + 12 - event_id * 7919 % 13"


def _sensor_stream(spark, sf, order="event_id", slices=0):
    """``events`` as a sensor stream with event time, in the given order whatever that of its files."""
    rows = _stream(spark, sf, "events", order, slices).select(
        "event_id",
        F.expr(ARRIVAL).alias("arr"),
        F.col("user_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").cast("int").alias("vc"),
        "event_type",
    )
    return rows


def _drained(spark, df, label, *times, partitions=None):
    out = runs.drain_to_table(df, label, partitions=partitions)
    return out.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


def _folded(spark, label, schema, fold, *args, kind="rows", **options):
    """A fold over what is there now; its rows."""
    run = lambda out, checkpoint: fold(*args, out, checkpoint, **options)
    return folds.drained(spark, run, scratch_path(spark, label), schema, kind)


CLOSED = "(SELECT max(ts) FROM s) - INTERVAL 1 HOUR"
WINDOW = ("window_start", "window_end")


def _aggs():
    return {"cnt": F.count(F.lit(1)), "total": F.sum("vc"), "largest": F.max("vc")}


@query("stream_wordcount", f"SELECT word, count(*) AS cnt FROM (SELECT {TOKENS} FROM conversations) GROUP BY word")
def stream_wordcount(spark, sf):
    words = project.tokenize(_stream(spark, sf, "conversations"), "text")
    return runs.drain_updates(rolling.word_count(words), "wordcount", ["word"])


@query(
    "stream_tumble",
    SENSORS
    + f"""SELECT event_type, {bucket('6 HOUR')} AS window_start, {bucket('6 HOUR')} + INTERVAL 6 HOUR AS window_end, {SQL_AGGS}
FROM s GROUP BY 1, 2, 3 HAVING window_end <= {CLOSED}""",
)
def stream_tumble(spark, sf):
    """Windows the watermark has closed, one hour behind the newest event."""
    rows = _sensor_stream(spark, sf).withWatermark("ts", "1 hour")
    return _drained(spark, windows.tumble(rows, ["event_type"], "ts", "6 hours", _aggs()), "tumble", *WINDOW)


@query(
    "stream_window_topn",
    SENSORS
    + f""", p AS (SELECT {bucket('5 HOUR')} AS w, vc FROM s),
w AS (SELECT w AS window_start, vc FROM p UNION ALL SELECT w - INTERVAL 5 HOUR, vc FROM p),
c AS (SELECT window_start, vc, count(*) AS cnt FROM w GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 10 HOUR AS window_end, vc, cnt, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, vc) AS r FROM c)
WHERE r <= 2 AND window_start + INTERVAL 10 HOUR <= {CLOSED}""",
)
def stream_window_topn(spark, sf):
    rows = _sensor_stream(spark, sf).withWatermark("ts", "1 hour")
    counts = topn.window_counts(rows, "ts", "vc", "10 hours", "5 hours")
    top = runs.drain_batches(counts, "topn", lambda batch: topn.best_counts(batch, "vc", 2))
    return top.withColumns({t: F.col(t).cast("timestamp_ntz") for t in WINDOW})


@query(
    "stream_session",
    SENSORS
    + f""", n AS (SELECT *, CASE WHEN ts > lag(ts) OVER w + INTERVAL 1 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens
  FROM s WINDOW w AS (PARTITION BY id ORDER BY ts)),
m AS (SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no FROM n)
SELECT id, min(ts) AS window_start, max(ts) + INTERVAL 1 HOUR AS window_end, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total
FROM m GROUP BY id, no HAVING max(ts) + INTERVAL 1 HOUR <= date_trunc('millisecond', {CLOSED})""",
)
def stream_session(spark, sf):
    rows = _sensor_stream(spark, sf).withWatermark("ts", "1 hour")
    aggs = {"cnt": F.count(F.lit(1)), "total": F.sum("vc")}
    return _drained(spark, windows.session_stream(rows, ["id"], "ts", "1 hour", aggs), "session", *WINDOW)


def _side(rows, kind, prefix):
    side = rows.where(F.col("event_type") == kind).select(
        "id", *(F.col(c).alias(f"{prefix}_{c}") for c in ("event_id", "ts", "vc"))
    )
    return side.withWatermark(f"{prefix}_ts", "1 hour")


@query(
    "stream_interval_join",
    _pair("click", "purchase")
    + """SELECT l.id, l_event_id, l_ts, l_vc, r_event_id, r_ts, r_vc FROM l JOIN r ON l.id = r.id
AND r_ts BETWEEN l_ts - INTERVAL 2 HOUR AND l_ts + INTERVAL 2 HOUR""",
)
def stream_interval_join(spark, sf):
    rows = _sensor_stream(spark, sf)
    l, r = _side(rows, "click", "l"), _side(rows, "purchase", "r")
    joined = joins.interval_join(l, r, ["id"], "l_ts", "r_ts", -7200, 7200)
    return _drained(spark, joined, "interval", "l_ts", "r_ts")


@query(
    "stream_window_join",
    _pair("click", "view")
    + f"""SELECT l.id, {bucket('6 HOUR', 'l_ts')} AS window_start, {bucket('6 HOUR', 'l_ts')} + INTERVAL 6 HOUR AS window_end,
  l_event_id, l_ts, l_vc, r_event_id, r_ts, r_vc
FROM l JOIN r ON l.id = r.id AND {bucket('6 HOUR', 'l_ts')} = {bucket('6 HOUR', 'r_ts')}""",
)
def stream_window_join(spark, sf):
    rows = _sensor_stream(spark, sf)
    l, r = _side(rows, "click", "l"), _side(rows, "view", "r")
    joined = joins.window_join(l, r, ["id"], "l_ts", "r_ts", "6 hours")
    return _drained(spark, joined, "window", *WINDOW, "l_ts", "r_ts")


@query(
    "stream_jump_alert",
    SENSORS
    + """SELECT * FROM (SELECT event_id, id, vc, coalesce(lag(vc) OVER (PARTITION BY id ORDER BY event_id), 0) AS last_vc
  FROM s) WHERE abs(vc - last_vc) > 10""",
)
def stream_jump_alert(spark, sf):
    rows = _sensor_stream(spark, sf).select("event_id", "id", "vc")
    return _folded(spark, "jump", "event_id bigint, id bigint, vc int, last_vc int", folds.jump_alert, rows, ["id"], "vc", ["event_id"])


@query(
    "stream_running_avg",
    SENSORS + f"SELECT event_id, id, vc, CAST(sum(vc) OVER {SOFAR} AS DOUBLE) / count(vc) OVER {SOFAR} AS avg FROM s",
)
def stream_running_avg(spark, sf):
    rows = _sensor_stream(spark, sf).select("event_id", "id", "vc")
    return _folded(spark, "avg", "event_id bigint, id bigint, vc int, avg double", folds.running_avg, rows, ["id"], "vc", ["event_id"])


@query(
    "stream_running_sum",
    SENSORS.replace("vc, event_type", "vc, value AS amount, event_type")
    + f"""SELECT event_id, id, round(sum(CASE WHEN event_type <> 'error' THEN round(amount, 2) END) OVER {SOFAR}, 2) AS total FROM s""",
)
def stream_running_sum(spark, sf):
    """Sums of doubles, null until a key has a value."""
    amount = F.when(F.col("event_type") != "error", F.round("value", 2)).alias("amount")
    rows = _stream(spark, sf, "events", "event_id").select("event_id", F.col("user_id").alias("id"), amount)
    summed = _folded(spark, "sum", "event_id bigint, id bigint, total double", folds.running_sum, rows, ["id"], "amount", ["event_id"])
    return summed.select("event_id", "id", F.round("total", 2).alias("total"))


@query(
    "stream_running_top3",
    SENSORS
    + f"""SELECT event_id, id, vc, array_to_string(list_slice(list_reverse_sort(list(vc) OVER {SOFAR}), 1, 3), ',') AS top FROM s""",
)
def stream_running_top3(spark, sf):
    rows = _sensor_stream(spark, sf).select("event_id", "id", "vc")
    top = _folded(spark, "top", "event_id bigint, id bigint, vc int, top array<int>", folds.running_top_n, rows, ["id"], "vc", ["event_id"])
    return top.withColumn("top", F.array_join(F.col("top").cast("array<string>"), ","))


def _day_end(ms):
    return ms - ms % 86_400_000 + 86_400_000


@query(
    "stream_user_process",
    SENSORS
    + """SELECT 'alert' AS tag, id, epoch_us(ts) // 1000 AS at_ms, CAST(vc AS BIGINT) AS n FROM s WHERE vc > 80
UNION ALL SELECT DISTINCT 'day', id, epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY) // 1000, CAST(NULL AS BIGINT) FROM s
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(ts)) FROM s) - INTERVAL 1 HOUR""",
)
def stream_user_process(spark, sf):
    """User code per key: a side output of high values, and an event-time timer at the end of each day with a row."""
    rows = _sensor_stream(spark, sf).withWatermark("ts", "1 hour")
    rows = rows.select("event_id", "id", "ts", F.unix_millis("ts").alias("ms"), "vc")

    def on_row(context, state, row):
        context.register(_day_end(row["ms"]))
        if row["vc"] > 80:
            context.emit("alert", row["ms"], row["vc"])
        return state

    def on_timer(context, state, at_ms):
        context.emit("day", at_ms, None)
        return state

    done = keyed.process(rows, ["id"], ["event_id"], "n bigint", "at_ms bigint, n bigint", on_row, on_timer, clock="eventTime")
    return _drained(spark, done, "process").select("tag", "id", "at_ms", "n")


@query(
    "stream_count_slide",
    SENSORS
    + """SELECT id, rn // 2 AS firing, elements FROM (SELECT id,
  row_number() OVER (PARTITION BY id ORDER BY event_id) AS rn,
  array_to_string(list(vc) OVER (PARTITION BY id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), ',') AS elements
  FROM s) WHERE rn % 2 = 0""",
)
def stream_count_slide(spark, sf):
    rows = _sensor_stream(spark, sf).select("event_id", "id", "vc")
    fired = _drained(spark, keyed.count_slide(rows, ["id"], "vc", ["event_id"], 5, 2), "slide")
    return fired.withColumn("elements", F.array_join(F.col("elements").cast("array<string>"), ","))


@query("stream_late_side_output", CLASSED + "SELECT event_id, arr, ts, window_start, window_end FROM c WHERE late_class = 'dropped'")
def stream_late_side_output(spark, sf):
    """The rows beyond the allowed lateness, on the clock of the whole stream."""
    root = scratch_path(spark, "lateness")
    rows = _sensor_stream(spark, sf, ARRIVAL).select("event_id", "arr", "ts")
    runs.drain(runs.late_stream(rows, "ts", ["arr"], "10 minutes", 600, 600, f"{root}/out", f"{root}/checkpoint"))
    schema = "event_id bigint, arr bigint, ts timestamp, window_start timestamp, window_end timestamp, late_class string"
    late = spark.read.schema(schema).parquet(f"{root}/out/rows").where("late_class = 'dropped'")
    return late.select("event_id", "arr", *(F.col(c).cast("timestamp_ntz") for c in ("ts", "window_start", "window_end")))


@query("stream_allowed_lateness", SQL["window_allowed_lateness"])
def stream_allowed_lateness(spark, sf):
    """The firings of windows that take late rows for ten minutes, on the clock of the whole stream."""
    root = scratch_path(spark, "firings")
    rows = _sensor_stream(spark, sf, ARRIVAL).select("event_type", "arr", "ts", "vc")
    run = runs.firings_stream(rows, ["event_type"], "ts", ["arr"], "10 minutes", "vc", 600, 600, f"{root}/out", f"{root}/checkpoint")
    runs.drain(run)
    schema = "event_type string, window_start timestamp, window_end timestamp, firing bigint, cnt bigint, total bigint"
    fired = spark.read.schema(schema).parquet(f"{root}/out/rows").drop("batch")
    return fired.withColumns({t: F.col(t).cast("timestamp_ntz") for t in WINDOW})


def _late_join(spark, sf):
    """Drains the late interval join of clicks and purchases; gives its folder."""
    rows, root = _sensor_stream(spark, sf, ARRIVAL), scratch_path(spark, "latejoin")
    sides = [
        rows.where(F.col("event_type") == kind).select("id", "arr", *(F.col(c).alias(f"{p}_{c}") for c in ("event_id", "ts", "vc")))
        for kind, p in (("click", "l"), ("purchase", "r"))
    ]
    tagged = joins.tag_sides(*sides, "l_ts", "r_ts", ["arr"])
    run = runs.interval_join_late_stream(tagged, ["id"], "l_ts", "r_ts", -7200, 7200, 60, f"{root}/out", f"{root}/checkpoint")
    runs.drain(run)
    return f"{root}/out", tagged.schema


@query("stream_interval_join_late", SQL["interval_join_late"])
def stream_interval_join_late(spark, sf):
    out, _ = _late_join(spark, sf)
    schema = "id bigint, arr bigint, l_event_id bigint, l_ts timestamp, l_vc int, r_event_id bigint, r_ts timestamp, r_vc int"
    pairs = spark.read.schema(schema).parquet(f"{out}/pairs").drop("batch")
    return pairs.withColumns({t: F.col(t).cast("timestamp_ntz") for t in ("l_ts", "r_ts")})


@query("stream_interval_join_late_left", SQL["interval_join_late_left"])
def stream_interval_join_late_left(spark, sf):
    out, schema = _late_join(spark, sf)
    late = spark.read.schema(schema).parquet(f"{out}/late").where("side = 'l'").select("l.*")
    return late.withColumn("l_ts", F.col("l_ts").cast("timestamp_ntz"))


@query("stream_interval_join_late_right", SQL["interval_join_late_right"])
def stream_interval_join_late_right(spark, sf):
    out, schema = _late_join(spark, sf)
    late = spark.read.schema(schema).parquet(f"{out}/late").where("side = 'r'").select("r.*")
    return late.withColumn("r_ts", F.col("r_ts").cast("timestamp_ntz"))


@query("stream_dedupe", "SELECT event_id, user_id FROM events")
def stream_dedupe(spark, sf):
    """A log delivered twice over, each record kept once."""
    def side():
        return rows.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))

    rows = _stream(spark, sf, "events", "event_id")
    twice = joins.union_all(side(), side())
    kept = changelog.dedupe(twice, "event_id", "ts", "1 hour")
    return _drained(spark, kept.select("event_id", "user_id"), "dedupe")


@query("stream_side_outputs", SENSORS + "SELECT event_type, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS ids FROM s WHERE event_type IN ('click', 'view') GROUP BY 1")
def stream_side_outputs(spark, sf):
    """One stream into two tables, by tag."""
    root = scratch_path(spark, "outputs")
    rows = _sensor_stream(spark, sf).select("event_id", "event_type", "vc")
    routed = project.route(rows, {t: F.col("event_type") == t for t in ("click", "view")})

    def sink(name):
        return lambda batch, n: batch.write.mode("overwrite").parquet(f"{root}/{name}/batch={n}")

    runs.drain(runs.fan_out(routed, "tag", {t: sink(t) for t in ("click", "view")}, f"{root}/checkpoint"))
    both = joins.union_all(*(spark.read.schema(rows.schema).parquet(f"{root}/{t}") for t in ("click", "view")))
    return both.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"), F.sum("event_id").alias("ids"))


@query(
    "stream_threshold",
    SENSORS
    + """SELECT event_id, id, vc, threshold FROM (SELECT event_id, id, vc, event_type,
  coalesce(last_value(CASE WHEN event_type = 'signup' THEN vc END IGNORE NULLS) OVER
  (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS threshold FROM s) WHERE event_type <> 'signup'""",
)
def stream_threshold(spark, sf):
    root = scratch_path(spark, "threshold")
    rows = _sensor_stream(spark, sf).select(
        "event_id", "id", "vc", F.when(F.col("event_type") == "signup", F.col("vc")).alias("rule")
    )
    runs.drain(
        runs.threshold_stream(rows, ["event_id"], "rule", ["event_id", "id", "vc"], f"{root}/out", f"{root}/checkpoint")
    )
    found = spark.read.schema("event_id bigint, id bigint, vc int, threshold int").parquet(f"{root}/out/rows")
    return found.select("event_id", "id", "vc", "threshold")


@query(
    "stream_slide",
    SENSORS
    + f""", p AS (SELECT event_type, vc, {bucket('5 HOUR')} AS w FROM s),
w AS (SELECT event_type, vc, w AS window_start FROM p UNION ALL SELECT event_type, vc, w - INTERVAL 5 HOUR FROM p)
SELECT event_type, window_start, window_start + INTERVAL 10 HOUR AS window_end, {SQL_AGGS}
FROM w GROUP BY 1, 2 HAVING window_end <= {CLOSED}""",
)
def stream_slide(spark, sf):
    rows = _sensor_stream(spark, sf).withWatermark("ts", "1 hour")
    return _drained(spark, windows.slide(rows, ["event_type"], "ts", "10 hours", "5 hours", _aggs()), "slid", *WINDOW)


@query(
    "stream_wm_monotonic",
    SENSORS
    + f"""SELECT event_type, {bucket('1 DAY')} AS window_start, {bucket('1 DAY')} + INTERVAL 1 DAY AS window_end,
  arg_max(ts, event_id) AS ts, CAST(sum(vc) AS BIGINT) AS vc
FROM s GROUP BY 1, 2, 3 HAVING window_end <= (SELECT max(ts) FROM s)""",
)
def stream_wm_monotonic(spark, sf):
    """Ascending timestamps: the watermark follows without delay."""
    rows = _sensor_stream(spark, sf).withWatermark("ts", "0 seconds")
    reduced = windows.window_reduce(rows, ["event_type"], "ts", "1 day", "vc", "event_id")
    return _drained(spark, reduced, "monotonic", *WINDOW, "ts")


def _minutes(column):
    return F.unix_seconds(column) / 60


@query("stream_tumble_proc", SENSORS + "SELECT event_type, count(*) AS cnt, true AS ten_minutes FROM s GROUP BY 1")
def stream_tumble_proc(spark, sf):
    """Windows over the processing time: which ones depends on the clock, but each row is in one, ten minutes wide."""
    rows = _sensor_stream(spark, sf)
    counted = windows.tumble_proc(rows, ["event_type"], "10 minutes", {"cnt": F.count(F.lit(1))})
    updates = runs.drain_updates(counted, "proc", ["event_type", *WINDOW])
    start, end = (_minutes(F.col(c)) for c in WINDOW)
    return updates.groupBy("event_type").agg(F.sum("cnt").alias("cnt"), F.bool_and((end - start == 10) & (start % 10 == 0)).alias("ten_minutes"))


@query(
    "stream_running_value_counts",
    SENSORS
    + """SELECT event_id, id, vc, count(*) OVER (PARTITION BY id, vc ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM s""",
)
def stream_running_value_counts(spark, sf):
    rows = _sensor_stream(spark, sf).select("event_id", "id", "vc")
    return _folded(spark, "values", "event_id bigint, id bigint, vc int, cnt bigint", folds.running_value_counts, rows, ["id"], "vc", ["event_id"])


@query("stream_log_to_table", SENSORS + "SELECT CAST(id AS VARCHAR) AS id, event_id AS ts, vc FROM s")
def stream_log_to_table(spark, sf):
    """Log records decoded, parsed and appended to a table."""
    records = log.encode_keyed(
        _sensor_stream(spark, sf).select(F.concat_ws(",", "id", "event_id", "vc").alias("value"))
    )
    parsed = text.parse_delimited(log.decode(records))
    root = scratch_path(spark, "logtable")
    runs.drain(typed_table_stream(parsed, SENSOR, f"{root}/table", f"{root}/checkpoint", every=None))
    return spark.read.schema(SENSOR).parquet(f"{root}/table")


# Stream forms of batch operators, each against the batch query's SQL.


@query("stream_union_all", SQL["union_all"])
def stream_union_all(spark, sf):
    rows = _sensor_stream(spark, sf)
    parts = (rows.select(F.col(c).cast("string").alias("value")) for c in ("vc", "id", "event_type"))
    return _drained(spark, joins.union_all(*parts), "union")


@query("stream_connect_comap", SQL["connect_comap"])
def stream_connect_comap(spark, sf):
    mapped = joins.connect_map(
        _sensor_stream(spark, sf),
        _stream(spark, sf, "customer"),
        {"kind": F.lit("number"), "value": F.col("vc").cast("string")},
        {"kind": F.lit("text"), "value": F.col("c_name")},
    )
    return _drained(spark, mapped, "comap")


@query("stream_equi_join", SQL["equi_join"])
def stream_equi_join(spark, sf):
    orders = _stream(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey", "o_totalprice")
    lines = _stream(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", "l_quantity")
    return _drained(spark, joins.equi_join(orders, lines, ["k"]), "equi")


@query("stream_partition_running_count", SQL["partition_running_count"])
def stream_partition_running_count(spark, sf):
    rows = _sensor_stream(spark, sf).select("event_id", "event_type")
    return _folded(spark, "counts", "event_id bigint, event_type string, cnt bigint", folds.running_count, rows, ["event_type"], ["event_id"])


def _halves(spark, sf):
    """The sensor stream up to the middle of its order, and the rest of it, in micro-batches of at most a slice."""
    middle = table(spark, sf, "events").agg(F.expr("max(event_id) div 2")).scalar()
    rows = _sensor_stream(spark, sf, slices=2).select("event_id", "vc")
    return rows.where(F.col("event_id") <= middle), rows.where(F.col("event_id") > middle)


def _in_shares(rows, shares):
    return rows.select(F.pmod("event_id", F.lit(shares)).alias("share"), "*")


# Both halves with the number of their share: seven of them at first, then four.
HALVES = (
    SENSORS
    + """, m AS (SELECT max(event_id) // 2 AS middle FROM s),
f AS (SELECT event_id % 7 AS share, event_id, vc FROM s, m WHERE event_id <= middle),
l AS (SELECT event_id % 4 AS share, event_id, vc FROM s, m WHERE event_id > middle)
"""
)


def _resumed(how, given):
    """SQL for both halves' counts; the second's begin with what ``given`` has for their share."""
    return (
        HALVES
        + f""", g AS ({given})
SELECT '{how}' AS phase, share, event_id, count(*) OVER (PARTITION BY share ORDER BY event_id) AS cnt FROM f
UNION ALL SELECT 'resumed', l.share, event_id, coalesce(g.n, 0) + count(*) OVER (PARTITION BY l.share ORDER BY event_id)
FROM l LEFT JOIN g USING (share)"""
    )


def _recounted(spark, sf, deal, label):
    first, rest = _halves(spark, sf)
    root = scratch_path(spark, label)
    counted = runs.drain_to_table(keyed.running_count(_in_shares(first, 7), ["share"], ["event_id"]), label, path=root)
    held = restore.stored_state(spark, f"{root}/checkpoint")
    initial = deal(held, "share", 4, {"n": F.sum("n")})
    again = keyed.running_count(_in_shares(rest, 4), ["share"], ["event_id"], initial=initial)
    phases = ("stopped", counted), ("resumed", runs.drain_to_table(again, label))
    both = [df.select(F.lit(phase).alias("phase"), "share", "event_id", "cnt") for phase, df in phases]
    return both[0].unionByName(both[1])


@query("stream_count_resumed", _resumed("stopped", "SELECT share % 4 AS share, count(*) AS n FROM f GROUP BY 1"))
def stream_count_resumed(spark, sf):
    """A count per share, stopped with seven shares and gone on with four: each takes over the counts of the old ones
    dealt to it."""
    return _recounted(spark, sf, restore.dealt, "resumed")


@query(
    "stream_count_resumed_whole",
    _resumed("stopped", "SELECT share, n FROM (SELECT count(*) AS n FROM f) c, (SELECT unnest(range(4)) AS share) r WHERE n > 0"),
)
def stream_count_resumed_whole(spark, sf):
    """The same where each new share takes over all that has been counted."""
    return _recounted(spark, sf, restore.dealt_whole, "resumed_whole")


@query(
    "stream_folds_resumed",
    HALVES
    + """, g AS (SELECT share % 4 AS share, count(*) AS n, sum(vc) AS total, max(vc) AS high FROM f GROUP BY 1)
SELECT l.share, event_id, coalesce(g.n, 0) + count(*) OVER w AS cnt,
  CAST(CASE WHEN count(vc) OVER w > 0 OR g.total IS NOT NULL THEN coalesce(g.total, 0) + coalesce(sum(vc) OVER w, 0) END AS BIGINT) AS total,
  greatest(g.high, max(vc) OVER w) AS high
FROM l LEFT JOIN g USING (share) WINDOW w AS (PARTITION BY l.share ORDER BY event_id)""",
)
def stream_folds_resumed(spark, sf):
    """Count, sum and maximum per share, gone on with four shares after a stop with seven; no Python sees a row."""
    first, rest = _halves(spark, sf)
    wanted = {"cnt": running_count(), "total": running_sum(F.col("vc")), "high": running_max(F.col("vc"))}
    seven, root = _in_shares(first, 7), scratch_path(spark, "folds_stopped")
    runs.drain(folds.fold_stream(seven, ["share"], ["event_id"], wanted, f"{root}/out", f"{root}/checkpoint"))
    held = folds.stored_folds(seven, ["share"], ["event_id"], wanted, f"{root}/out", f"{root}/checkpoint")
    merge = {"cnt": F.sum("cnt"), "total": F.sum("total"), "high": F.max("high")}
    initial = restore.dealt(held, "share", 4, merge)
    schema = "share bigint, event_id bigint, cnt bigint, total bigint, high int"
    found = _folded(
        spark, "folds_resumed", schema, folds.fold_stream, _in_shares(rest, 4), ["share"], ["event_id"], wanted, initial=initial
    )
    return found.select("share", "event_id", "cnt", "total", "high")


@query(
    "stream_count_tumble",
    SENSORS
    + """, n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id) AS rn FROM s)
SELECT id, (rn - 1) // 5 + 1 AS firing, string_agg(vc, ',' ORDER BY event_id) AS elements FROM n GROUP BY 1, 2 HAVING count(*) = 5""",
)
def stream_count_tumble(spark, sf):
    rows = _sensor_stream(spark, sf).select("event_id", "id", "vc")
    fired = _drained(spark, keyed.count_tumble(rows, ["id"], "vc", ["event_id"], 5), "tumbled")
    return fired.withColumn("elements", F.array_join(F.col("elements").cast("array<string>"), ","))


@query(
    "stream_session_dynamic",
    SENSORS
    + f""", e AS (SELECT *, ts + INTERVAL 1 HOUR * (1 + vc % 7) AS fin FROM s),
r AS (SELECT *, max(fin) OVER (PARTITION BY id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR ts > reach THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY ts
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no FROM r)
SELECT id, min(ts) AS window_start, max(fin) AS window_end, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total
FROM n GROUP BY id, no HAVING max(fin) <= date_trunc('millisecond', {CLOSED})""",
)
def stream_session_dynamic(spark, sf):
    rows = _sensor_stream(spark, sf).withWatermark("ts", "1 hour")
    gap = F.concat((1 + F.col("vc") % 7).cast("string"), F.lit(" hours"))
    aggs = {"cnt": F.count(F.lit(1)), "total": F.sum("vc")}
    return _drained(spark, windows.session_stream(rows, ["id"], "ts", gap, aggs), "sessions", *WINDOW)


@query("stream_slide_proc", SENSORS + "SELECT event_type, count(*) AS even, count(*) AS odd, true AS twenty_minutes FROM s GROUP BY 1")
def stream_slide_proc(spark, sf):
    """Sliding windows over the processing time: each row is in one that starts at an even ten minutes and in one between."""
    counted = windows.slide_proc(_sensor_stream(spark, sf), ["event_type"], "20 minutes", "10 minutes", {"cnt": F.count(F.lit(1))})
    updates = runs.drain_updates(counted, "slideproc", ["event_type", *WINDOW])
    start, end = (_minutes(F.col(c)) for c in WINDOW)
    even = start % 20 == 0
    return updates.groupBy("event_type").agg(
        F.sum(F.when(even, F.col("cnt"))).alias("even"),
        F.sum(F.when(~even, F.col("cnt"))).alias("odd"),
        F.bool_and((end - start == 20) & (start % 10 == 0)).alias("twenty_minutes"),
    )


@query(
    "stream_event_timer",
    SENSORS
    + """SELECT DISTINCT id, CAST(epoch_ms(TIMESTAMP '2024-01-15') AS BIGINT) AS fired_at_ms, CAST(1 AS BIGINT) AS firing FROM s
WHERE (SELECT max(ts) - INTERVAL 10 MINUTE FROM s) >= TIMESTAMP '2024-01-15 00:00:00.001'""",
)
def stream_event_timer(spark, sf):
    at_ms = 1_705_276_800_000
    return _drained(spark, keyed.event_timer(_sensor_stream(spark, sf), ["id"], "ts", at_ms, "10 minutes"), "timer")


@query("stream_sink_bucketed", SQL["sink_bucketed"])
def stream_sink_bucketed(spark, sf):
    root = scratch_path(spark, "bucketstream")
    lines = _stream(spark, sf, "events").select("ts", F.concat(F.lit("Number:"), F.col("event_id").cast("string")).alias("value"))
    runs.drain(files.bucketed_stream(lines, f"{root}/out", f"{root}/checkpoint", "ts"))
    number = F.substring_index("value", ":", -1).cast("bigint")
    return files.read_bucketed(spark, f"{root}/out").groupBy("bucket").agg(F.count(F.lit(1)).alias("cnt"), F.sum(number).alias("ids"))


# Over several micro-batches, from rows that do not come in the order of events.

DELAYED = SENSORS.replace("FROM events", "FROM events WHERE ts <= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR")
HELD = folds.HoldBack("ts", 21_600)


def _disordered(spark, sf):
    """``events`` in six micro-batches; rows come up to twelve places late, across the ends of micro-batches too."""
    return _sensor_stream(spark, sf, ARRIVAL, slices=6).select("event_id", "id", "ts", "vc")


@query(
    "stream_jump_alert_reordered",
    DELAYED
    + """SELECT * FROM (SELECT event_id, id, vc, coalesce(lag(vc) OVER (PARTITION BY id ORDER BY ts, event_id), 0) AS last_vc
  FROM s) WHERE abs(vc - last_vc) > 10""",
)
def stream_jump_alert_reordered(spark, sf):
    """Jumps between neighbours in event time: rows are held back for six hours of it."""
    schema = "event_id bigint, id bigint, vc int, last_vc int"
    return _folded(spark, "jumps", schema, folds.jump_alert, _disordered(spark, sf), ["id"], "vc", ["event_id"], hold=HELD)


@query(
    "stream_running_avg_reordered",
    DELAYED
    + """SELECT event_id, id, vc, CAST(sum(vc) OVER w AS DOUBLE) / count(vc) OVER w AS avg FROM s
WINDOW w AS (PARTITION BY id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def stream_running_avg_reordered(spark, sf):
    schema = "event_id bigint, id bigint, vc int, avg double"
    return _folded(spark, "avgs", schema, folds.running_avg, _disordered(spark, sf), ["id"], "vc", ["event_id"], hold=HELD, every=2)


@query(
    "stream_running_top3_reordered",
    DELAYED
    + """SELECT event_id, id, vc, array_to_string(list_slice(list_reverse_sort(list(vc) OVER
  (PARTITION BY id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 1, 3), ',') AS top FROM s""",
)
def stream_running_top3_reordered(spark, sf):
    schema = "event_id bigint, id bigint, vc int, top array<int>"
    top = _folded(spark, "tops", schema, folds.running_top_n, _disordered(spark, sf), ["id"], "vc", ["event_id"], hold=HELD)
    return top.withColumn("top", F.array_join(F.col("top").cast("array<string>"), ","))


@query("stream_cdc_latest", SQL["cdc_latest"])
def stream_cdc_latest(spark, sf):
    """A change log kept as a table over five micro-batches, with a new base every second one."""
    keys, out = ["user_id"], scratch_path(spark, "latest")
    log_ = _stream(spark, sf, "events", "event_id", slices=5).select("user_id", "event_id", "value", "event_type")
    runs.drain(changelog.apply_stream(log_, keys, "event_id", f"{out}/table", f"{out}/checkpoint", "event_type", "error", every=2))
    return changelog.stored(spark, f"{out}/table", keys, log_.schema, every=2)


HELD_MS = "SELECT *, epoch_us(ts) // 1000 AS ms FROM s WHERE epoch_us(ts) // 1000 < (SELECT max(epoch_us(ts) // 1000) FROM s) - 21600000"


def _for_cores(spark):
    """State partitions for micro-batches of at most a slice: two for each core."""
    return max(12, 2 * spark.sparkContext.defaultParallelism)


def _waiting(spark, sf):
    rows = _disordered(spark, sf).withWatermark("ts", "6 hours")
    # The times go on as numbers, which cost Python less than timestamps.
    return rows.select("event_id", "id", F.unix_millis("ts").alias("ms"), "vc")


@query(
    "stream_user_process_reordered",
    SENSORS
    + f""", r AS ({HELD_MS})
SELECT 'alert' AS tag, id, ms AS at_ms, CAST(vc AS BIGINT) AS n FROM (SELECT *, lag(vc) OVER (PARTITION BY id ORDER BY ms, event_id) AS last FROM r)
WHERE abs(vc - last) > 10
UNION ALL SELECT 'day', id, ms - ms % 86400000 + 86400000 AS at_ms, count(*) FROM r GROUP BY 2, 3
HAVING at_ms < (SELECT max(epoch_us(ts) // 1000) FROM s) - 21600000""",
)
def stream_user_process_reordered(spark, sf):
    """User code that sees rows and its timers in event time, though rows come late: jumps, and each day's count at its end."""

    def on_row(context, state, row):
        last, n = state or (None, 0)
        context.register(_day_end(row["ms"]))
        if last is not None and abs(row["vc"] - last) > 10:
            context.emit("alert", row["ms"], row["vc"])
        return row["vc"], n + 1

    def on_timer(context, state, at_ms):
        context.emit("day", at_ms, state[1])
        return state[0], 0

    args = (["id"], ["event_id"], "last int, n bigint", "at_ms bigint, n bigint", on_row, on_timer)
    done = keyed.process(_waiting(spark, sf), *args, clock="eventTime", hold="ms")
    return _drained(spark, done, "waited", partitions=_for_cores(spark)).select("tag", "id", "at_ms", "n")


def _triggered(spark, rows, trigger, label, partitions=None, **options):
    def add(held, row):
        return held[0] + 1, held[1] + row["vc"]

    fired = triggers.trigger_window(rows, ["id"], ["event_id"], trigger, "cnt bigint, total bigint", lambda: (0, 0), add, **options)
    return _drained(spark, fired, label, partitions=partitions)


NUMBERED = """, n AS (SELECT id, vc, event_id, row_number() OVER (PARTITION BY id ORDER BY event_id) AS rn FROM s)"""


@query(
    "stream_trigger_count",
    SENSORS
    + NUMBERED
    + """SELECT id, rn // 7 AS firing, rn AS cnt, total FROM (SELECT *, CAST(sum(vc) OVER (PARTITION BY id ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM n) WHERE rn % 7 = 0""",
)
def stream_trigger_count(spark, sf):
    """A window over all rows of a key that fires at every seventh."""
    return _triggered(spark, _sensor_stream(spark, sf, slices=3).select("event_id", "id", "vc"), triggers.Count(7), "seventh")


@query(
    "stream_trigger_purging",
    SENSORS
    + NUMBERED
    + """SELECT id, (rn - 1) // 7 + 1 AS firing, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total FROM n GROUP BY 1, 2 HAVING count(*) = 7""",
)
def stream_trigger_purging(spark, sf):
    """The same, emptied at each firing."""
    return _triggered(spark, _sensor_stream(spark, sf, slices=3).select("event_id", "id", "vc"), triggers.Purging(triggers.Count(7)), "purged")


@query(
    "stream_trigger_event_time",
    SENSORS
    + f""", r AS ({HELD_MS}),
b AS (SELECT DISTINCT id, ms - ms % 86400000 + 86400000 AS due FROM r)
SELECT b.id, row_number() OVER (PARTITION BY b.id ORDER BY due) AS firing, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total
FROM b JOIN r ON r.id = b.id AND r.ms <= due WHERE due < (SELECT max(epoch_us(ts) // 1000) FROM s) - 21600000 GROUP BY b.id, due""",
)
def stream_trigger_event_time(spark, sf):
    """A window over all rows of a key that fires when the event time passes the end of a day with a row."""
    return _triggered(spark, _waiting(spark, sf), triggers.EventTime(86_400_000), "days", _for_cores(spark), time_ms="ms")


@query(
    "stream_window_user_process",
    STREAKS.replace("SELECT * FROM w", f"SELECT * FROM w WHERE window_end <= {CLOSED}"),
)
def stream_window_user_process(spark, sf):
    """The user function of ``window_user_process`` over a stream, each window once it has closed."""
    rows = userwindow.with_window(_sensor_stream(spark, sf, slices=3), "ts", "10 days").select("event_type", "event_id", "ts", "vc", *WINDOW)
    args = (["event_type"], "ts", ["event_id"], "rows bigint, streak bigint", *streak(), 3600)
    schema = "event_type string, window_start timestamp, window_end timestamp, rows bigint, streak bigint"
    found = _folded(spark, "streaks", schema, userwindow.process_window_stream, rows, *args)
    return found.withColumns({t: F.col(t).cast("timestamp_ntz") for t in WINDOW})


def _squares():
    """User code: the sum of squares."""
    return lambda: 0, lambda held, part: held + int((part["vc"].astype("int64") ** 2).sum()), lambda a, b: a + b, lambda held: held


@query("stream_custom_fold", SQL["custom_fold"])
def stream_custom_fold(spark, sf):
    """A user aggregate per key over four micro-batches; the newest result of each key."""
    rows = _sensor_stream(spark, sf, slices=4).select("id", "vc")
    root = scratch_path(spark, "squares")
    writer = userfolds.custom_fold_stream(rows, ["id"], *_squares(), "bigint", f"{root}/out", f"{root}/checkpoint", "squares", every=2)
    runs.drain(writer)
    found = spark.read.schema("id bigint, squares bigint, batch bigint").parquet(f"{root}/out/rows")
    return found.groupBy("id").agg(F.max_by("squares", "batch").alias("squares"))


@query(
    "stream_window_custom_fold",
    SENSORS
    + f"""SELECT event_type, {bucket('1 DAY')} AS window_start, {bucket('1 DAY')} + INTERVAL 1 DAY AS window_end,
  CAST(sum(vc * vc) AS BIGINT) AS squares FROM s GROUP BY 1, 2, 3 HAVING window_end <= {CLOSED}""",
)
def stream_window_custom_fold(spark, sf):
    """The same per window, from accumulators alone, once when the window closes."""
    rows = userwindow.with_window(_sensor_stream(spark, sf, slices=4), "ts", "1 day").select("event_type", "ts", "vc", *WINDOW)
    args = (["event_type", *WINDOW], *_squares(), "bigint")
    schema = "event_type string, window_start timestamp, window_end timestamp, squares bigint"
    closing = folds.HoldBack("ts", 3600, "window_end")
    found = _folded(spark, "daily", schema, userfolds.custom_fold_stream, rows, *args, name="squares", closing=closing, every=2)
    return found.withColumns({t: F.col(t).cast("timestamp_ntz") for t in WINDOW})


@query(
    "stream_sink_rolled",
    "SELECT strftime(ts, '%Y-%m-%d--%H') AS bucket, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS ids, true AS small FROM events GROUP BY 1",
)
def stream_sink_rolled(spark, sf):
    """Files of at most 100 bytes besides their last line, by bucket, over two micro-batches."""
    root = scratch_path(spark, "rolled")
    number = F.concat(F.lit("Number:"), F.col("event_id").cast("string")).alias("value")
    lines = _stream(spark, sf, "events", "event_id", slices=2).select("ts", "event_id", number)
    runs.drain(files.rolled_stream(lines, f"{root}/out", f"{root}/checkpoint", "ts", "event_id", size=100, every=None))
    found = files.read_rolled(spark, f"{root}/out")
    of_file = found.groupBy("bucket", "file").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.substring_index("value", ":", -1).cast("bigint")).alias("ids"),
        F.first(F.col("size") - F.octet_length("value") - 1).alias("before_last"),
    )
    return of_file.groupBy("bucket").agg(F.sum("n").alias("cnt"), F.sum("ids").alias("ids"), F.bool_and(F.col("before_last") < 110).alias("small"))
