"""Row-wise operators, placement, and sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import schema as S, text as X, time as TM
from tidemark.operators import changelog, partition, project, tables
from tidemark.plans.inputs import SENSORS, sensors, table
from tidemark.plans.registry import query
from tidemark.session import scratch_path
from tidemark.sources import files, jdbc, log

TOKENS = """unnest(CASE WHEN text <> '' AND regexp_replace(text, ' +$', '') = '' THEN CAST([] AS VARCHAR[])
  ELSE string_split(regexp_replace(text, ' +$', ''), ' ') END) AS word"""


@query("map_id", SENSORS + "SELECT id FROM s")
def map_id(spark, sf):
    return project.map_rows(sensors(spark, sf), id=F.col("id"))


@query("filter_id", SENSORS + "SELECT event_id, id, vc FROM s WHERE event_type = 'click'")
def filter_id(spark, sf):
    return project.filter_equal(sensors(spark, sf), "event_type", "click").select("event_id", "id", "vc")


@query(
    "flatmap_case",
    SENSORS
    + """SELECT event_id, CAST(vc AS VARCHAR) AS value FROM s WHERE event_type IN ('click', 'purchase')
UNION ALL SELECT event_id, CAST(id AS VARCHAR) FROM s WHERE event_type = 'purchase'""",
)
def flatmap_case(spark, sf):
    cases = {"click": [F.col("vc")], "purchase": [F.col("id"), F.col("vc")]}
    return project.flat_map_case(sensors(spark, sf), "event_type", cases, keep=["event_id"])


@query("tokenize", f"SELECT conv_id, turn, {TOKENS} FROM conversations")
def tokenize(spark, sf):
    return project.tokenize(table(spark, sf, "conversations"), "text", keep=["conv_id", "turn"])


@query("split_even", SENSORS + "SELECT event_id, vc - 60 AS v FROM s WHERE (vc - 60) % 2 = 0")
def split_even(spark, sf):
    return project.even_rows(sensors(spark, sf).select("event_id", (F.col("vc") - 60).alias("v")), F.col("v"))


@query("split_odd", SENSORS + "SELECT event_id, vc - 60 AS v FROM s WHERE (vc - 60) % 2 = 1")
def split_odd(spark, sf):
    return project.odd_rows(sensors(spark, sf).select("event_id", (F.col("vc") - 60).alias("v")), F.col("v"))


@query(
    "side_output_route",
    SENSORS
    + "SELECT event_id, vc, CASE event_type WHEN 'click' THEN 's1' WHEN 'view' THEN 's2' ELSE 'main' END AS tag FROM s",
)
def side_output_route(spark, sf):
    rows = sensors(spark, sf)
    tags = {"s1": F.col("event_type") == "click", "s2": F.col("event_type") == "view"}
    return project.route(rows, tags).select("event_id", "vc", "tag")


@query(
    "side_output_alert",
    SENSORS
    + """SELECT event_id, 'main' AS tag, CAST(NULL AS VARCHAR) AS message FROM s
UNION ALL SELECT event_id, 'warn', 'vc=' || vc FROM s WHERE vc > 10""",
)
def side_output_alert(spark, sf):
    message = F.concat(F.lit("vc="), F.col("vc").cast("string"))
    return project.side_alert(sensors(spark, sf), F.col("vc") > 10, message).select("event_id", "tag", "message")


@query("rich_map", SENSORS + "SELECT event_id, vc + 1 AS vc FROM s")
def rich_map(spark, sf):
    rows = sensors(spark, sf).select("event_id", "vc")
    return project.rich_map(
        rows, "event_id bigint, vc int", lambda step, batch: batch.assign(vc=batch["vc"] + step), open=lambda: 1
    )


@query("rich_map_task", SENSORS + "SELECT count(*) AS cnt, CAST(4 AS BIGINT) AS tasks, CAST(0 AS BIGINT) AS low, CAST(3 AS BIGINT) AS high FROM s")
def rich_map_task(spark, sf):
    """The number of its task, as ``open`` gets it, on each row."""
    rows = sensors(spark, sf).select("event_id").repartition(4)
    numbered = project.rich_map(
        rows, "event_id bigint, task bigint", lambda number, batch: batch.assign(task=number), open=lambda task: task.number
    )
    return numbered.agg(
        F.count(F.lit(1)).alias("cnt"), F.countDistinct("task").alias("tasks"), F.min("task").alias("low"), F.max("task").alias("high")
    )


@query("parse_sensor", SENSORS + "SELECT CAST(id AS VARCHAR) AS id, CAST(floor(epoch(ts)) AS BIGINT) AS ts, vc FROM s")
def parse_sensor(spark, sf):
    rows = sensors(spark, sf)
    line = F.concat_ws(",", "id", TM.epoch_seconds(rows, "ts"), "vc")
    return X.parse_delimited(rows.select(line.alias("value")))


@query(
    "parse_measure",
    """SELECT event_id AS id, round(value, 3) AS amount, CAST(round(value, 2) AS DECIMAL(10,2)) AS price, CAST(ts AS DATE) AS day,
  user_id % 2 = 0 AS even FROM events""",
)
def parse_measure(spark, sf):
    """Fields of other types than whole numbers, between two-character separators."""
    amount = F.round("value", 3).cast("decimal(18,3)")
    fields = ["event_id", amount, F.round("value", 2).cast("decimal(10,2)"), F.col("ts").cast("date"), F.col("user_id") % 2 == 0]
    line = F.concat_ws("^|", *(f if isinstance(f, str) else f.cast("string") for f in fields))
    schema = S.T.StructType.fromDDL("id bigint, amount double, price decimal(10,2), day date, even boolean")
    return X.parse_delimited(table(spark, sf, "events").select(line.alias("value")), schema, sep="^|")


@query(
    "cast_nested",
    """SELECT event_id, CAST(event_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) AS list, CAST(user_id AS INTEGER) AS k,
  event_type AS t, value AS m, upper(hex(encode(event_type))) AS b, CAST(value AS FLOAT) AS f,
  CAST(epoch_us(ts) AS BIGINT) AS us, CAST(event_type AS VARCHAR) AS c FROM events""",
)
def cast_nested(spark, sf):
    """One column for each type that ``cast_to_schema`` leaves out there: lists, rows, maps, bytes and the rest."""
    raw = table(spark, sf, "events").select(
        "event_id",
        F.array("event_id", "user_id").alias("list"),
        F.struct(F.col("user_id").alias("k"), F.col("event_type").alias("t")).alias("pair"),
        F.create_map("event_type", F.col("value").cast("string")).alias("byname"),
        F.col("event_type").alias("b"),
        F.col("event_type").alias("vb"),
        F.col("value").cast("string").alias("f"),
        F.col("ts").alias("zoned"),
        F.col("event_type").alias("c"),
    )
    types = {
        "event_id": "BIGINT",
        "list": "ARRAY<VARCHAR>",
        "pair": "ROW<k INTEGER, t VARCHAR(10)>",
        "byname": "MAP<VARCHAR, DOUBLE>",
        "b": "BINARY",
        "vb": "VARBINARY(20)",
        "f": "FLOAT",
        "zoned": "TIMESTAMP_WITH_TIME_ZONE",
        "c": "CHAR(10)",
    }
    cast = S.cast_to_schema(raw, S.table_schema(types))
    return cast.where(F.col("b") == F.col("vb")).select(
        "event_id",
        F.array_join("list", ",").alias("list"),
        F.col("pair.k").alias("k"),
        F.col("pair.t").alias("t"),
        F.element_at("byname", F.col("c")).alias("m"),
        F.hex("b").alias("b"),
        "f",
        F.unix_micros("zoned").alias("us"),
        "c",
    )


@query("json_roundtrip", """SELECT event_id, '{"k":' || CAST(json_extract(props, '$.k') AS INTEGER) || '}' AS value FROM events""")
def json_roundtrip(spark, sf):
    schema = S.T.StructType([S.T.StructField("k", S.T.IntegerType())])
    parsed = X.rows_from_json(table(spark, sf, "events"), schema, "props", keep=["event_id"])
    return parsed.select("event_id", F.to_json(F.struct("k")).alias("value"))


@query(
    "rows_to_json",
    SENSORS + """SELECT '{"id":' || id || ',"vc":' || vc || ',"event_type":"' || event_type || '"}' AS value FROM s""",
)
def rows_to_json(spark, sf):
    return X.rows_to_json(sensors(spark, sf), ["id", "vc", "event_type"])


@query(
    "cast_to_schema",
    """SELECT event_id AS c_bigint, CAST(user_id AS INTEGER) AS c_integer, CAST(user_id % 100 AS TINYINT) AS c_tinyint,
  CAST(user_id AS SMALLINT) AS c_smallint, user_id % 2 = 1 AS c_boolean, value AS c_double,
  CAST(value AS DECIMAL(10,2)) AS c_decimal, CAST(ts AS DATE) AS c_date,
  CAST((epoch_us(ts) // 1000) % 86400000 AS INTEGER) AS c_time, ts AS c_timestamp, event_type AS c_varchar,
  CAST(NULL AS VARCHAR) AS c_absent FROM events""",
)
def cast_to_schema(spark, sf):
    events = table(spark, sf, "events")
    raw = events.select(
        F.col("event_id").alias("c_bigint"),
        F.col("user_id").alias("c_integer"),
        (F.col("user_id") % 100).alias("c_tinyint"),
        F.col("user_id").alias("c_smallint"),
        (F.col("user_id") % 2).alias("c_boolean"),
        F.col("value").cast("string").alias("c_double"),
        F.col("value").alias("c_decimal"),
        F.col("ts").alias("c_date"),
        (
            (TM.epoch_seconds(events, "ts") % 86400) * 1000 + F.date_format("ts", "SSS").cast("int")
        ).alias("c_time"),
        F.col("ts").alias("c_timestamp"),
        F.col("event_type").alias("c_varchar"),
    )
    types = {
        "c_bigint": "BIGINT",
        "c_integer": "INTEGER",
        "c_tinyint": "TINYINT",
        "c_smallint": "SMALLINT",
        "c_boolean": "BOOLEAN",
        "c_double": "DOUBLE",
        "c_decimal": "DECIMAL(10,2)",
        "c_date": "DATE",
        "c_time": "TIME",
        "c_timestamp": "TIMESTAMP",
        "c_varchar": "VARCHAR(20)",
        "c_absent": "VARCHAR",
    }
    return S.cast_to_schema(raw, S.table_schema(types))


# Placement


@query("part_keyby", "SELECT user_id, count(*) AS cnt, CAST(0 AS INTEGER) AS spread FROM events GROUP BY user_id")
def part_keyby(spark, sf):
    """Per key: its rows, and the distance between the partitions that hold them."""
    placed = partition.with_partition(partition.by_key(table(spark, sf, "events"), 16, "user_id"))
    spread = F.max("partition") - F.min("partition")
    return placed.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"), spread.alias("spread"))


def _loads(df):
    """Rows, partitions that hold some, and the smallest and largest share of a partition in an even one."""
    sizes = partition.with_partition(df).groupBy("partition").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").alias("cnt"), F.count("*").alias("parts"), F.min("n").alias("low"), F.max("n").alias("high"))


EVEN = "SELECT count(*) AS cnt, CAST(16 AS BIGINT) AS parts, true AS even FROM events"


@query("part_shuffle", EVEN)
def part_shuffle(spark, sf):
    """Random placement: no partition is far from an even share, and few neighbours stay together."""
    loads = _loads(partition.shuffled(table(spark, sf, "events"), 16))
    share = F.col("cnt") / F.col("parts")
    return loads.select("cnt", "parts", ((F.col("low") > share / 2) & (F.col("high") < share * 2)).alias("even"))


@query("part_rebalance", EVEN)
def part_rebalance(spark, sf):
    """Round robin: what a task deals out makes the partitions differ by a row at most."""
    source = partition.with_partition(table(spark, sf, "events"), "source")
    dealt = partition.with_partition(partition.rebalanced(source, 16)).groupBy("source", "partition").agg(F.count(F.lit(1)).alias("n"))
    low = F.when(F.count("*") == 16, F.min("n")).otherwise(0)
    even = dealt.groupBy("source").agg(F.sum("n").alias("n"), (F.max("n") - low <= 1).alias("even"))
    parts = dealt.agg(F.countDistinct("partition").alias("parts"))
    return even.agg(F.sum("n").alias("cnt"), F.bool_and("even").alias("even")).select("cnt", parts.scalar().alias("parts"), "even")


@query("part_rescale", "SELECT count(*) AS cnt, CAST(4 AS BIGINT) AS parts, CAST(1 AS BIGINT) AS torn FROM events")
def part_rescale(spark, sf):
    """Sixteen partitions merged to four: each of the sixteen is in one of the four."""
    source = partition.with_partition(partition.rebalanced(table(spark, sf, "events"), 16), "source")
    merged = partition.with_partition(partition.rescaled(source, 4))
    each = merged.groupBy("source", "partition").agg(F.count(F.lit(1)).alias("n"))
    held = each.groupBy("source").agg(F.sum("n").alias("n"), F.count("*").alias("places"), F.min("partition").alias("partition"))
    return held.agg(F.sum("n").alias("cnt"), F.countDistinct("partition").alias("parts"), F.max("places").alias("torn"))


@query("part_custom", "SELECT event_id, CAST(event_id % 16 AS INTEGER) AS partition FROM events")
def part_custom(spark, sf):
    placed = partition.custom(table(spark, sf, "events"), 16, F.col("event_id"))
    return partition.with_partition(placed).select("event_id", "partition")


# Logs, databases, files and tables


@query("kafka_decode", SENSORS + "SELECT CAST(id AS VARCHAR) AS id, event_id AS ts, vc FROM s")
def kafka_decode(spark, sf):
    line = F.concat_ws(",", "id", "event_id", "vc")
    records = log.encode(sensors(spark, sf), line)
    return X.parse_delimited(log.decode(records))


@query("kafka_encode", SENSORS + "SELECT upper(hex(encode(id || ',' || event_id || ',' || vc))) AS value FROM s")
def kafka_encode(spark, sf):
    records = log.encode(sensors(spark, sf), F.concat_ws(",", "id", "event_id", "vc"))
    return records.select(F.hex("value").alias("value"))


@query("kafka_encode_keyed", SENSORS + "SELECT CAST(id AS VARCHAR) AS key, id || ',' || event_id || ',' || vc AS value FROM s")
def kafka_encode_keyed(spark, sf):
    lines = sensors(spark, sf).select(F.concat_ws(",", "id", "event_id", "vc").alias("value"))
    return log.encode_keyed(lines).select(*(F.decode(c, "UTF-8").alias(c) for c in ("key", "value")))


@query("dedupe_record_id", "SELECT event_id, user_id, value FROM events")
def dedupe_record_id(spark, sf):
    """The log delivered twice over, each record kept once."""
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    twice = changelog.record_id(events.unionByName(events), events.columns)
    return changelog.dedupe(twice, "record_id").drop("record_id")


CDC = "SELECT user_id, event_id, value, event_type FROM events"


@query(
    "cdc_latest",
    f"SELECT * FROM ({CDC} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)"
    " WHERE event_type <> 'error'",
)
def cdc_latest(spark, sf):
    changes = table(spark, sf, "events").select("user_id", "event_id", "value", "event_type")
    return changelog.latest(changes, ["user_id"], "event_id", op="event_type", delete="error")


@query("cdc_append", CDC)
def cdc_append(spark, sf):
    return changelog.appended(table(spark, sf, "events").select("user_id", "event_id", "value", "event_type"))


@query("incremental_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey >= 1")
def incremental_scan(spark, sf):
    """Two polls that follow one another; together they deliver every row once."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    stop = jdbc.next_stop(orders, "o_orderkey", 1)
    middle = (1 + stop) // 2
    first = jdbc.incremental_scan(orders, "o_orderkey", 1, middle)
    return first.unionByName(jdbc.incremental_scan(orders, "o_orderkey", middle, stop))


@query(
    "sink_bucketed",
    "SELECT strftime(ts, '%Y-%m-%d--%H') AS bucket, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1",
)
def sink_bucketed(spark, sf):
    """Lines written to hourly buckets, read back and counted."""
    lines = table(spark, sf, "events").select("ts", F.concat(F.lit("Number:"), "event_id").alias("value"))
    path = scratch_path(spark, "bucketed")
    files.write_bucketed(lines, path, "ts")
    back = files.read_bucketed(spark, path)
    number = F.substring_index("value", ":", -1).cast("bigint")
    return back.groupBy("bucket").agg(F.count(F.lit(1)).alias("cnt"), F.sum(number).alias("ids"))


@query("sql_copy_table", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS address, c_acctbal AS balance FROM customer")
def sql_copy_table(spark, sf):
    """Database, table, table like it, insert-select, read."""
    root = scratch_path(spark, "tables")
    database = "copy_" + root.rsplit("-", 1)[1]
    tables.create_database(spark, database, f"{root}/db")
    columns = {"id": "BIGINT", "name": "VARCHAR", "address": "VARCHAR", "balance": "DOUBLE"}
    tables.create_table(spark, f"{database}.table1", columns)
    tables.create_like(spark, f"{database}.table2", f"{database}.table1")
    source = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    source.write.insertInto(f"{database}.table1")
    tables.copy_table(spark, f"{database}.table1", f"{database}.table2")
    return tables.read_table(spark, f"{database}.table2")
