"""Readers, writers and tables."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import schema
from tidemark.operators import changelog, tables
from tidemark.sources import files, jdbc, log, polling
from tidemark.sources.tables import table_stream, typed_table_stream
from tidemark.streaming import runs


def test_elements_and_sequence(spark):
    assert files.elements(spark, [("s1", 1, 1)], schema.SENSOR).count() == 1
    numbers = files.sequence(spark, 10, 2)
    assert numbers.rdd.getNumPartitions() == 2
    assert sorted(r[0] for r in numbers.collect()) == [f"Number:{i}" for i in range(10)]


def test_text_batch_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("hello world\n\nhello\n")
    path = str(tmp_path / "in")
    assert rows(files.text(spark, path)) == [("",), ("hello world",), ("hello",)]
    assert rows(runs.drain_to_table(files.text_stream(spark, path), "text")) == rows(files.text(spark, path))


def test_sequence_stream_shape(spark):
    stream = files.sequence_stream(spark, rows_per_second=5)
    assert stream.isStreaming and stream.columns == ["value"]


def test_bucketed_files(spark, tmp_path):
    df = spark.range(200).select(
        F.timestamp_seconds(F.col("id") * 60).alias("t"), F.concat(F.lit("Number:"), "id").alias("value")
    )
    path = str(tmp_path / "out")
    files.write_bucketed(df, path, "t", tasks=3)
    back = files.read_bucketed(spark, path)
    assert rows(back.groupBy("bucket").count()) == [
        ("1970-01-01--00", 60), ("1970-01-01--01", 60), ("1970-01-01--02", 60), ("1970-01-01--03", 20),
    ]
    assert rows(back, "value") == rows(df, "value")


def test_bucketed_stream(spark, stream_of, tmp_path):
    stream = stream_of("s bigint, value string", [(0, "a"), (3600, "b")], [(7200, "c")])
    timed = stream.withColumn("t", F.timestamp_seconds("s"))
    path = str(tmp_path / "out")
    runs.drain(files.bucketed_stream(timed, path, str(tmp_path / "check"), "t"))
    assert rows(files.read_bucketed(spark, path), "value", "bucket") == [
        ("a", "1970-01-01--00"), ("b", "1970-01-01--01"), ("c", "1970-01-01--02"),
    ]


def test_log_options():
    options = log.read_options("host:1", "t", "earliest", "g", read_committed=True)
    assert options["kafka.isolation.level"] == "read_committed"
    assert options["startingOffsets"] == "earliest" and options["kafka.group.id"] == "g"
    assert log.write_options("host:1", "t", transaction_timeout_ms=600000)["kafka.transaction.timeout.ms"] == "600000"
    with pytest.raises(ValueError):
        log.read_options("host:1", "t", "yesterday")


def test_log_records(spark):
    lines = spark.createDataFrame([("s1,1,2",), ("größe,3,4",)], "value string")
    keyed = log.encode_keyed(lines)
    assert [f.dataType.simpleString() for f in keyed.schema] == ["binary", "binary"]
    assert rows(log.decode(keyed)) == rows(lines)
    assert rows(keyed.select(F.decode("key", "UTF-8"))) == [("größe",), ("s1",)]


def test_dedupe_by_content(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n int, s string")
    assert rows(changelog.dedupe(changelog.record_id(df, ["n", "s"]), "record_id"), "n", "s") == [(1, "a"), (2, None)]


def test_incremental_ranges_deliver_each_row_once(spark):
    table = spark.range(1, 101).withColumnRenamed("id", "key")
    stop = jdbc.next_stop(table, "key", 1)
    parts = [jdbc.incremental_scan(table, "key", a, b) for a, b in ((1, 40), (40, stop))]
    assert sorted(r[0] for p in parts for r in p.collect()) == list(range(1, 101))
    assert jdbc.next_stop(table, "key", stop) == stop


def test_jdbc_writes_by_name(spark, stream_of, tmp_path):
    """The database write is Spark's own; here a file format stands in for it."""
    assert jdbc.write_options(1000, url="jdbc:x", dbtable="t") == {"url": "jdbc:x", "dbtable": "t", "batchsize": "1000"}
    with pytest.raises(ValueError):
        jdbc.write_options(url="jdbc:x")
    lines = stream_of("value string", [('{"url":"/a","money":5,"name":"x"}',)], [('{"name":"y"}',)])
    typed = jdbc.json_rows(lines, schema.EVENT)
    out = str(tmp_path / "out")
    writer = jdbc.write_stream(
        typed, {"path": out}, str(tmp_path / "check"), columns=["money", "name", "url"], format="json"
    )
    runs.drain(writer)
    assert rows(spark.read.schema("name string, url string, money bigint").json(out)) == [("x", "/a", 5), ("y", None, None)]


@pytest.fixture
def database(tmp_path):
    path = str(tmp_path / "events.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE event (id INTEGER PRIMARY KEY, name TEXT, url TEXT, money INTEGER)")
        db.executemany("INSERT INTO event VALUES (?, ?, ?, ?)", [(i, f"n{i}", "/u", i * 10) for i in range(1, 8)])
    return path


def test_polling_source_into_a_table(spark, database, tmp_path):
    """Two runs over a growing table: every id once."""
    spark.dataSource.register(polling.PollingSource)

    def run():
        stream = (
            spark.readStream.format("polling")
            .schema(schema.EVENT_TABLE)
            .options(module="sqlite3", connect=f'{{"database": "{database}"}}', table="event", column="id")
            .load()
        )
        writer = typed_table_stream(
            stream, schema.EVENT_TABLE, str(tmp_path / "out"), str(tmp_path / "check"), every=None
        )
        writer.start().awaitTermination()
        return spark.read.schema(schema.EVENT_TABLE).parquet(str(tmp_path / "out"))

    assert run().count() == 7
    with sqlite3.connect(database) as db:
        db.executemany("INSERT INTO event VALUES (?, ?, ?, ?)", [(i, f"n{i}", "/u", i * 10) for i in (8, 9)])
    assert rows(run(), "id", "money") == [(i, i * 10) for i in range(1, 10)]


def test_log_to_table(spark, stream_of, tmp_path):
    """Log records decoded, parsed and appended to a table."""
    records = stream_of("key binary, value binary", [(b"k", b'{"id":1,"name":"a"}')], [(None, b'{"id":2}')])
    typed = jdbc.json_rows(log.decode(records), schema.ADDRESS_TABLE)
    out = str(tmp_path / "out")
    table_stream(typed, out, str(tmp_path / "check")).start().awaitTermination()
    found = spark.read.schema(schema.ADDRESS_TABLE).parquet(out)
    assert rows(found) == [(1, "a", None, None), (2, None, None, None)]


def test_tables(spark, tmp_path):
    tables.create_database(spark, "shop", str(tmp_path / "shop"))
    columns = {"id": "BIGINT", "name": "VARCHAR", "address": "VARCHAR", "update_time": "VARCHAR"}
    tables.create_table(spark, "shop.table1", columns)
    tables.create_like(spark, "shop.table2", "shop.table1")
    data = [(i, f"n{i}", "street", "2023-01-01") for i in range(4)]
    tables.insert_rows(spark, "shop.table1", data)
    tables.copy_table(spark, "shop.table1", "shop.table2")
    assert rows(tables.read_table(spark, "shop.table2")) == data
    stream = tables.read_table(spark, "shop.table2", streaming=True)
    assert rows(runs.drain_to_table(stream, "table")) == data


def test_files_roll_by_size_and_a_repeated_batch_replaces_its_own(spark, tmp_path):
    lines = [(i, 1_700_000_000 + 700 * i, f"line {i} " + "x" * (i * 7 % 50)) for i in range(200)]
    df = spark.createDataFrame(lines, "n int, s bigint, value string").select("n", F.timestamp_seconds("s").alias("at"), "value").repartition(4)
    out = str(tmp_path / "out")
    for _ in range(2):
        files.write_rolled(df.where("n < 120"), f"{out}/batch=0", "at", "n", size=150)
    files.write_rolled(df.where("n >= 120"), f"{out}/batch=1", "at", "n", size=150)
    found = [p for p in (tmp_path / "out").glob("batch=*/bucket=*/roll=*/part-*")]
    held = [p.read_text().splitlines() for p in found]
    assert sorted(x for h in held for x in h) == sorted(r[2] for r in lines)
    for p, h in zip(found, held):
        assert p.stat().st_size - len(h[-1]) - 1 < 150
        numbers = [int(x.split()[1]) for x in h]
        assert numbers == sorted(numbers)
    per_bucket = {}
    for p in found:
        per_bucket.setdefault((p.parents[2].name, p.parents[1].name), set()).add(p.parent.name)
    assert max(map(len, per_bucket.values())) > 1
    files.write_rolled(df.where("false"), f"{out}/batch=2", "at", "n")


def test_small_files_are_written_by_many_tasks(spark, tmp_path):
    """However few bytes there are: each file takes its time."""
    df = spark.range(400).select("id", F.timestamp_seconds(F.col("id") * 60).alias("at"), F.format_string("line %03d", "id").alias("value"))
    out = str(tmp_path / "out")
    for _ in range(2):
        files.write_rolled(df, f"{out}/batch=0", "at", "id", size=20)
    found = list((tmp_path / "out").glob("batch=0/bucket=*/roll=*/part-*"))
    assert len({p.name.split("-")[1] for p in found}) > 8
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["batch=0"]
    assert spark.read.text(out).count() == 400


def test_rolled_files_of_a_local_folder_come_without_others_and_are_read_by_their_names(spark, tmp_path):
    """Spark's own writer would leave a checksum file beside each, and start a process for every file and folder."""
    lines = [(i, None if i % 5 == 4 else 3600 * (i % 3), None if i == 7 else f"Zeile {i} ü") for i in range(40)]
    df = spark.createDataFrame(lines, "n int, s bigint, value string").select("n", F.timestamp_seconds("s").alias("at"), "value").repartition(3)
    out = str(tmp_path / "a b" / "out")
    files.write_rolled(df.where("n < 30"), f"{out}/batch=0", "at", "n", size=30)
    files.write_rolled(df.where("n >= 30"), f"{out}/batch=1", "at", "n", size=30)
    assert {p.name for p in (tmp_path / "a b").rglob("*") if p.is_file() and not p.name.startswith("part-")} <= {"_SUCCESS", "._SUCCESS.crc"}
    found = files.read_rolled(spark, out).collect()
    hour = lambda s: None if s is None else f"1970-01-01--{s // 3600:02}"
    want = [(v or "", int(n >= 30), hour(s)) for n, s, v in lines]
    assert sorted(((r.value, r.batch, r.bucket) for r in found), key=repr) == sorted(want, key=repr)
    per_file = {}
    for r in found:
        per_file.setdefault((r.file, r.batch, r.bucket, r.roll, r.size), []).append(r.value)
    assert len(per_file) == len({k[0] for k in per_file}) == len({k[1:4] for k in per_file}) > 8
    assert all(sum(len(v.encode()) + 1 for v in held) == k[4] for k, held in per_file.items())


def test_catalogs_are_registered_and_used(spark):
    tables.create_catalog(spark, "shop", "org.example.ShopCatalog", url="mem")
    try:
        assert spark.conf.get("spark.sql.catalog.shop") == "org.example.ShopCatalog" and spark.conf.get("spark.sql.catalog.shop.url") == "mem"
        with pytest.raises(Exception, match="ShopCatalog|shop"):
            tables.use_catalog(spark, "shop", "x")
    finally:
        spark.conf.unset("spark.sql.catalog.shop")
        tables.use_catalog(spark, "spark_catalog", "default")
    assert spark.catalog.currentCatalog() == "spark_catalog"
    with pytest.raises(ValueError):
        tables.create_catalog(spark, "spark_catalog", "x")
