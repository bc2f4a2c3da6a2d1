"""Rolling aggregates, keyed state, count and session windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import time as TM
from tidemark.operators import project, rolling, state, windows
from tidemark.plans.inputs import SENSORS, sensors, table
from tidemark.plans.registry import SQL, query
from tidemark.plans.rows import TOKENS

SOFAR = "(PARTITION BY id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
BEFORE = "(PARTITION BY id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _narrow(spark, sf):
    return sensors(spark, sf).select("event_id", "id", "ts", "vc")


@query("wordcount", f"SELECT word, count(*) AS cnt FROM (SELECT {TOKENS} FROM documents) GROUP BY word")
def wordcount(spark, sf):
    return rolling.word_count(project.tokenize(table(spark, sf, "documents"), "text"))


@query(
    "wordcount_running",
    f"""SELECT conv_id, turn, word, pos, count(*) OVER (PARTITION BY word ORDER BY conv_id, turn, pos
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM (SELECT conv_id, turn, {TOKENS}, CAST(generate_subscripts(CASE WHEN text <> '' AND regexp_replace(text, ' +$', '') = ''
  THEN CAST([] AS VARCHAR[]) ELSE string_split(regexp_replace(text, ' +$', ''), ' ') END, 1) - 1 AS INTEGER) AS pos
  FROM conversations)""",
)
def wordcount_running(spark, sf):
    lines = table(spark, sf, "conversations")
    words = project.tokenize(lines, "text", keep=["conv_id", "turn"], position="pos")
    return rolling.running_word_count(words, ["conv_id", "turn", "pos"])


@query("rolling_sum", SENSORS + f"SELECT event_id, id, first(ts) OVER {SOFAR} AS ts, CAST(sum(vc) OVER {SOFAR} AS BIGINT) AS vc FROM s")
def rolling_sum(spark, sf):
    return rolling.rolling_sum(_narrow(spark, sf), ["id"], "vc", ["event_id"])


@query("rolling_min", SENSORS + f"SELECT event_id, id, first(ts) OVER {SOFAR} AS ts, min(vc) OVER {SOFAR} AS vc FROM s")
def rolling_min(spark, sf):
    return rolling.rolling_min(_narrow(spark, sf), ["id"], "vc", ["event_id"])


@query("rolling_max", SENSORS + f"SELECT event_id, id, first(ts) OVER {SOFAR} AS ts, max(vc) OVER {SOFAR} AS vc FROM s")
def rolling_max(spark, sf):
    return rolling.rolling_max(_narrow(spark, sf), ["id"], "vc", ["event_id"])


@query(
    "rolling_max_by",
    SENSORS
    + f"""SELECT event_id, id, b.ts AS ts, b.vc AS vc FROM (SELECT event_id, id,
  max({{'vc': vc, 'neg': -event_id, 'ts': ts}}) OVER {SOFAR} AS b FROM s)""",
)
def rolling_max_by(spark, sf):
    return rolling.rolling_max_by(_narrow(spark, sf), ["id"], "vc", ["event_id"])


@query(
    "rolling_min_by",
    SENSORS
    + f"""SELECT event_id, id, b.ts AS ts, b.vc AS vc FROM (SELECT event_id, id,
  min({{'vc': vc, 'pos': event_id, 'ts': ts}}) OVER {SOFAR} AS b FROM s)""",
)
def rolling_min_by(spark, sf):
    return rolling.rolling_min_by(_narrow(spark, sf), ["id"], "vc", ["event_id"])


@query("rolling_reduce", SENSORS + f"SELECT event_id, id, ts, CAST(sum(vc) OVER {SOFAR} AS BIGINT) AS vc FROM s")
def rolling_reduce(spark, sf):
    return rolling.rolling_reduce(_narrow(spark, sf), ["id"], "vc", ["event_id"])


@query(
    "running_avg",
    SENSORS
    + f"SELECT event_id, id, CAST(sum(vc) OVER {SOFAR} AS DOUBLE) / count(vc) OVER {SOFAR} AS avg FROM s",
)
def running_avg(spark, sf):
    return rolling.running_avg(_narrow(spark, sf), ["id"], "vc", ["event_id"]).select("event_id", "id", "avg")


@query("running_sum", SENSORS + f"SELECT event_id, id, vc, CAST(sum(vc) OVER {SOFAR} AS BIGINT) AS total FROM s")
def running_sum(spark, sf):
    rows = sensors(spark, sf).select("event_id", "id", "vc")
    return state.running_sum_of(rows, ["id"], "vc", ["event_id"])


@query(
    "group_agg",
    SENSORS
    + """SELECT id, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total, min(vc) AS smallest, max(vc) AS largest,
  CAST(sum(vc) AS DOUBLE) / count(vc) AS mean,
  max({'v': vc, 'o': -event_id}).o * -1 AS first_max, min({'v': vc, 'o': event_id}).o AS first_min
FROM s GROUP BY id""",
)
def group_agg(spark, sf):
    return rolling.group_aggregate(sensors(spark, sf), ["id"], "vc", ["event_id"])


@query(
    "group_agg_nulls",
    SENSORS
    + """, n AS (SELECT id, event_id, CASE WHEN event_type <> 'click' AND id % 5 <> 0 THEN vc END AS vc FROM s)
SELECT id, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total, min(vc) AS smallest, max(vc) AS largest,
  CASE WHEN count(vc) > 0 THEN CAST(sum(vc) AS DOUBLE) / count(vc) END AS mean,
  min(event_id) FILTER (vc = mx) AS first_max, min(event_id) FILTER (vc = mn) AS first_min
FROM (SELECT *, max(vc) OVER (PARTITION BY id) AS mx, min(vc) OVER (PARTITION BY id) AS mn FROM n) GROUP BY id""",
)
def group_agg_nulls(spark, sf):
    """Rows without a value hold no extreme."""
    some = (F.col("event_type") != "click") & (F.col("id") % 5 != 0)
    return rolling.group_aggregate(sensors(spark, sf).withColumn("vc", F.when(some, F.col("vc"))), ["id"], "vc", ["event_id"])


@query("custom_fold", SENSORS + "SELECT id, CAST(sum(vc * vc) AS BIGINT) AS squares FROM s GROUP BY id")
def custom_fold(spark, sf):
    rows = sensors(spark, sf).select("id", "vc")
    return rolling.custom_fold(
        rows,
        ["id"],
        create=lambda: 0,
        add=lambda acc, batch: acc + int((batch["vc"].astype("int64") ** 2).sum()),
        merge=lambda a, b: a + b,
        result=lambda acc: acc,
        result_type="bigint",
        name="squares",
    )


# Keyed state


@query(
    "jump_alert",
    SENSORS
    + """SELECT * FROM (SELECT event_id, id, ts, vc, coalesce(lag(vc) OVER (PARTITION BY id ORDER BY event_id), 0) AS last_vc
  FROM s) WHERE abs(vc - last_vc) > 10""",
)
def jump_alert(spark, sf):
    return state.jump_alert(_narrow(spark, sf), ["id"], "vc", ["event_id"])


@query(
    "running_top3",
    SENSORS
    + f"""SELECT event_id, id, array_to_string(list_slice(list_reverse_sort(list(vc) OVER {SOFAR}), 1, 3), ',') AS top FROM s""",
)
def running_top3(spark, sf):
    top = state.running_top_n(sensors(spark, sf).select("event_id", "id", "vc"), ["id"], "vc", ["event_id"])
    return top.select("event_id", "id", F.array_join(F.col("top").cast("array<string>"), ",").alias("top"))


@query(
    "top3_per_key",
    SENSORS
    + """SELECT event_id, id, vc, CAST(r AS INTEGER) AS rank FROM (SELECT event_id, id, vc,
  row_number() OVER (PARTITION BY id ORDER BY vc DESC, event_id) AS r FROM s) WHERE r <= 3""",
)
def top3_per_key(spark, sf):
    return state.top_n_per_key(sensors(spark, sf).select("event_id", "id", "vc"), ["id"], "vc", ["event_id"])


@query(
    "running_value_counts",
    SENSORS
    + """SELECT event_id, id, vc, count(*) OVER (PARTITION BY id, vc ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM s""",
)
def running_value_counts(spark, sf):
    return state.running_value_counts(sensors(spark, sf).select("event_id", "id", "vc"), ["id"], "vc", ["event_id"])


@query("value_counts", SENSORS + "SELECT id, vc, count(*) AS cnt FROM s GROUP BY id, vc")
def value_counts(spark, sf):
    return state.value_counts(sensors(spark, sf), ["id"], "vc")


@query(
    "value_count_map",
    SENSORS
    + """SELECT id, string_agg(vc || ':' || cnt, ',' ORDER BY vc) AS counts
FROM (SELECT id, vc, count(*) AS cnt FROM s GROUP BY id, vc) GROUP BY id""",
)
def value_count_map(spark, sf):
    maps = state.value_count_map(sensors(spark, sf), ["id"], "vc")
    entries = F.transform(
        F.map_entries("counts"), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))
    )
    return maps.select("id", F.array_join(entries, ",").alias("counts"))


@query(
    "value_count_parts",
    SENSORS
    + """SELECT id, (rn - 1) // 10 AS part, string_agg(vc || ':' || cnt, ',' ORDER BY vc) AS counts
FROM (SELECT id, vc, count(*) AS cnt, row_number() OVER (PARTITION BY id ORDER BY vc) AS rn FROM s GROUP BY id, vc) GROUP BY 1, 2""",
)
def value_count_parts(spark, sf):
    """The map of each key in parts of ten entries."""
    parts = state.value_count_parts(sensors(spark, sf), ["id"], "vc", 10)
    entries = F.transform(
        F.map_entries("counts"), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))
    )
    return parts.select("id", "part", F.array_join(entries, ",").alias("counts"))


@query(
    "ttl_last_value",
    SENSORS
    + """SELECT event_id, id, ts, vc, CASE WHEN ts < lag(ts) OVER w + INTERVAL 2 HOUR THEN lag(vc) OVER w END AS last_vc
FROM s WINDOW w AS (PARTITION BY id ORDER BY event_id)""",
)
def ttl_last_value(spark, sf):
    return state.ttl_last_value(_narrow(spark, sf), ["id"], "vc", "ts", ["event_id"], ttl=7200)


@query(
    "ttl_read_refresh",
    SENSORS
    + f""", g AS (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY id ORDER BY event_id) + INTERVAL 12 HOUR THEN ts END AS broke FROM s),
h AS (SELECT *, max(broke) OVER {SOFAR} AS chain,
  last_value(CASE WHEN vc > 60 THEN {{'v': vc, 't': ts}} END IGNORE NULLS) OVER {BEFORE} AS w FROM g)
SELECT event_id, id, ts, vc, CASE WHEN chain IS NULL OR w.t >= chain THEN w.v END AS last_vc FROM h""",
)
def ttl_read_refresh(spark, sf):
    rows = _narrow(spark, sf)
    return state.ttl_read_refresh(rows, ["id"], "vc", "ts", ["event_id"], F.col("vc") > 60, ttl=43200)


@query(
    "partition_running_count",
    SENSORS
    + """SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM s""",
)
def partition_running_count(spark, sf):
    rows = sensors(spark, sf).select("event_id", "event_type")
    return state.partition_running_count(rows, ["event_type"], ["event_id"])


@query(
    "event_timer",
    SENSORS
    + """SELECT id, min(arr) AS registered FROM s
WHERE (SELECT max(ts) - INTERVAL 600001 MILLISECOND FROM s) >= TIMESTAMP '2024-01-15' GROUP BY id
HAVING min(arr) <= (SELECT min(arr) FROM s WHERE ts = (SELECT max(ts) FROM s))""",
)
def event_timer(spark, sf):
    at = F.lit("2024-01-15").cast("timestamp_ntz")
    return state.event_timer(sensors(spark, sf), ["id"], "ts", ["arr"], at, delay=600)


STOPPED = "(SELECT max(event_id) * 6 // 10 FROM s)"


@query(
    "event_timer_last",
    SENSORS
    + f"""SELECT event_id // 7 AS key, min(event_id) AS registered FROM s
WHERE (SELECT max(ts) - INTERVAL 600001 MILLISECOND FROM s WHERE event_id < {STOPPED}) >= TIMESTAMP '2024-01-10 06:00:00'
GROUP BY 1 HAVING min(event_id) <= (SELECT min(event_id) FROM s WHERE ts = (SELECT max(ts) FROM s WHERE event_id < {STOPPED}))""",
)
def event_timer_last(spark, sf):
    """As if time stood still after three fifths of the rows: keys that only come later don't fire."""
    rows = sensors(spark, sf)
    stopped = rows.select(F.floor(F.max("event_id") * 6 / 10)).scalar()
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    rows = rows.withColumn("key", F.floor(F.col("event_id") / 7))
    rows = rows.withColumn("ts", F.when(F.col("event_id") < stopped, F.col("ts")).otherwise(start))
    at = F.lit("2024-01-10 06:00:00").cast("timestamp_ntz")
    return state.event_timer(rows, ["key"], "ts", ["event_id"], at, delay=600)


# The same with segments so small that each key crosses many borders.


def _small(column="event_id", rows=97):
    return F.floor(F.col(column) / rows)


def _cut(name, function):
    query(f"{name}_cut", SQL[name])(function)


_cut("rolling_sum", lambda spark, sf: rolling.rolling_sum(_narrow(spark, sf), ["id"], "vc", ["event_id"], _small()))
_cut("rolling_min", lambda spark, sf: rolling.rolling_min(_narrow(spark, sf), ["id"], "vc", ["event_id"], _small()))
_cut("rolling_max", lambda spark, sf: rolling.rolling_max(_narrow(spark, sf), ["id"], "vc", ["event_id"], _small()))
_cut("rolling_max_by", lambda spark, sf: rolling.rolling_max_by(_narrow(spark, sf), ["id"], "vc", ["event_id"], _small()))
_cut("rolling_min_by", lambda spark, sf: rolling.rolling_min_by(_narrow(spark, sf), ["id"], "vc", ["event_id"], _small()))
_cut(
    "running_avg",
    lambda spark, sf: rolling.running_avg(_narrow(spark, sf), ["id"], "vc", ["event_id"], segment=_small()).select("event_id", "id", "avg"),
)
_cut(
    "running_sum",
    lambda spark, sf: state.running_sum_of(sensors(spark, sf).select("event_id", "id", "vc"), ["id"], "vc", ["event_id"], segment=_small()),
)
_cut("jump_alert", lambda spark, sf: state.jump_alert(_narrow(spark, sf), ["id"], "vc", ["event_id"], segment=_small()))
_cut(
    "wordcount_running",
    lambda spark, sf: rolling.running_word_count(
        project.tokenize(table(spark, sf, "conversations"), "text", keep=["conv_id", "turn"], position="pos"),
        ["conv_id", "turn", "pos"],
        segment=_small("conv_id", 7),
    ),
)


# Count, session and trigger windows


@query(
    "count_tumble",
    SENSORS
    + """, n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id) AS rn FROM s)
SELECT id, (rn - 1) // 5 AS window_no, CAST(sum(vc) AS BIGINT) AS total, max(ts) AS newest
FROM n GROUP BY 1, 2 HAVING count(*) = 5""",
)
def count_tumble(spark, sf):
    aggs = {"total": F.sum("vc"), "newest": F.max("ts")}
    return windows.count_tumble(_narrow(spark, sf), ["id"], ["event_id"], 5, aggs)


@query(
    "count_slide",
    SENSORS
    + """SELECT id, rn // 2 AS firing, cnt, total, newest FROM (SELECT id,
  row_number() OVER (PARTITION BY id ORDER BY event_id) AS rn, count(*) OVER f AS cnt,
  CAST(sum(vc) OVER f AS BIGINT) AS total, max(ts) OVER f AS newest
  FROM s WINDOW f AS (PARTITION BY id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE rn % 2 = 0""",
)
def count_slide(spark, sf):
    aggs = {"cnt": F.count(F.lit(1)), "total": F.sum("vc"), "newest": F.max("ts")}
    return windows.count_slide(_narrow(spark, sf), ["id"], ["event_id"], 5, 2, aggs)


@query(
    "global_trigger",
    SENSORS
    + f""", n AS (SELECT *, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER {BEFORE}, 0) AS no FROM s)
SELECT id, CAST(no AS BIGINT) AS window_no, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total FROM n
GROUP BY 1, 2 HAVING max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) = 1""",
)
def global_trigger(spark, sf):
    rows = sensors(spark, sf).select("event_id", "id", "vc", "event_type")
    aggs = {"cnt": F.count(F.lit(1)), "total": F.sum("vc")}
    return windows.global_trigger(rows, ["id"], ["event_id"], F.col("event_type") == "purchase", aggs)


def _sessions(gap: str) -> str:
    return (
        SENSORS
        + f""", e AS (SELECT *, ts + {gap} AS fin FROM s),
r AS (SELECT *, max(fin) OVER (PARTITION BY id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR ts > reach THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY ts
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no FROM r)
SELECT id, min(ts) AS window_start, max(fin) AS window_end, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total FROM n GROUP BY id, no"""
    )



@query("session_static", _sessions("INTERVAL 1 HOUR"))
def session_static(spark, sf):
    aggs = {"cnt": ("count", F.lit(1)), "total": ("sum", F.col("vc"))}
    return windows.session(_narrow(spark, sf), ["id"], "ts", TM.seconds(3600), aggs)


@query("session_dynamic", _sessions("INTERVAL 1 HOUR * (1 + vc % 7)"))
def session_dynamic(spark, sf):
    aggs = {"cnt": ("count", F.lit(1)), "total": ("sum", F.col("vc"))}
    gap = F.make_dt_interval(hours=1 + F.col("vc") % 7)
    return windows.session(_narrow(spark, sf), ["id"], "ts", gap, aggs)


def _half_days():
    return F.floor(F.unix_date(F.col("ts").cast("date")) * 2 + F.hour("ts") / 12)


def _session_cut(gap):
    def run(spark, sf):
        aggs = {"cnt": ("count", F.lit(1)), "total": ("sum", F.col("vc"))}
        return windows.session(_narrow(spark, sf), ["id"], "ts", gap(), aggs, _half_days())

    return run


_cut("session_static", _session_cut(lambda: TM.seconds(3600)))
_cut("session_dynamic", _session_cut(lambda: F.make_dt_interval(hours=1 + F.col("vc") % 7)))
