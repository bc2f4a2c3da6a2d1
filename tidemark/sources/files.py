"""In-memory rows, sequences, text lines and bucketed text output."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, groupby

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.scan import running, running_sum

BUCKET_FORMAT = "yyyy-MM-dd--HH"
ROLL_BYTES = 1 << 20
# As Spark names the folder of rows without a value.
NO_BUCKET = "__HIVE_DEFAULT_PARTITION__"


def elements(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small literal collection."""
    return spark.createDataFrame(list(rows), schema)


def sequence(spark: SparkSession, count: int, partitions: int | None = None, prefix: str = "Number:") -> DataFrame:
    """``count`` numbered strings from 0, the range split evenly over the partitions."""
    numbers = spark.range(0, count, 1, partitions) if partitions else spark.range(count)
    return numbers.select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("value"))


def sequence_stream(
    spark: SparkSession, rows_per_second: int = 1, partitions: int = 1, prefix: str = "Number:"
) -> DataFrame:
    """The open-ended sequence, so many rows per second."""
    rate = spark.readStream.format("rate").options(rowsPerSecond=rows_per_second, numPartitions=partitions).load()
    return rate.select(F.concat(F.lit(prefix), F.col("value").cast("string")).alias("value"))


def text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line."""
    return spark.read.text(path)


def text_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the files that appear below ``path``."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def line_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a text socket; for trials, as Spark cannot replay a socket."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def with_bucket(df: DataFrame, time: str, pattern: str = BUCKET_FORMAT) -> DataFrame:
    """Add the hourly bucket a row is filed under."""
    return df.withColumn("bucket", F.date_format(time, pattern))


def write_bucketed(
    df: DataFrame,
    path: str,
    time: str,
    value: str = "value",
    tasks: int | None = None,
    rows_per_file: int = 0,
    compression: str = "none",
) -> None:
    """Text files in one folder per bucket.

    Rows are first ranged by time, so a task writes few buckets, a bucket gets few
    files, and a bucket holding much of the data is still written by many tasks: as many
    as Spark finds by size, or ``tasks``.
    """
    rows = df.select(time, value)
    ranged = rows.repartitionByRange(tasks, time, value) if tasks else rows.repartitionByRange(time, value)
    out = with_bucket(ranged, time).select("bucket", value)
    writer = out.write.mode("append").partitionBy("bucket").option("compression", compression)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.text(path)


def bucketed_stream(
    df: DataFrame, path: str, checkpoint: str, time: str, value: str = "value", every: str = "10 seconds"
) -> DataStreamWriter:
    """The same as a stream: a new file set per trigger, visible once the trigger commits."""
    out = with_bucket(df, time).select("bucket", value)
    return (
        out.writeStream.partitionBy("bucket")
        .format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
    )


def rolled(df: DataFrame, time: str, order: str, value: str = "value", size: int = ROLL_BYTES) -> DataFrame:
    """Lines with their ``bucket`` and ``roll``: a new roll begins after each ``size`` bytes of a bucket along ``order``.

    A roll has less than ``size`` bytes besides its last line. Buckets of any size are summed in parallel.
    """
    rows = with_bucket(df.select(time, order, value), time)
    length = F.octet_length(F.col(value)).cast("bigint") + 1
    so_far = running(rows, ["bucket"], [order], {"__bytes": running_sum(length).excluding_current()})
    roll = F.floor(F.coalesce(F.col("__bytes"), F.lit(0)) / size)
    return so_far.select("bucket", roll.cast("bigint").alias("roll"), order, value)


def _put_rolls(folder: str) -> Callable[[Iterator], Iterator]:
    """For ``mapInArrow`` over (bucket, roll, line), sorted: writes each roll as a text file of its folder below ``folder``.

    A file is written aside and then given its name, which an attempt that is repeated gives again. The result is a
    batch with the number of files.
    """
    run, unnamed = uuid.uuid4(), NO_BUCKET

    def put(batches):
        import pyarrow as pa

        task = TaskContext.get()
        number, aside = task.partitionId(), f"{folder}/_attempts/{task.taskAttemptId()}"

        def lines(batch):
            buckets, rolls, values = batch.columns
            return zip(buckets.to_pylist(), rolls.to_pylist(), values.cast(pa.large_binary()).to_pylist())

        done, made = 0, None
        for (bucket, roll), held in groupby(chain.from_iterable(map(lines, batches)), key=lambda line: line[:2]):
            place = f"{folder}/bucket={unnamed if bucket is None else bucket}"
            if place != made:
                os.makedirs(place, exist_ok=True)
                made = place
            with open(aside, "wb") as out:
                for *_, value in held:
                    out.write((value or b"") + b"\n")
            os.makedirs(f"{place}/roll={roll}", exist_ok=True)
            os.replace(aside, f"{place}/roll={roll}/part-{number:05d}-{run}.c000.txt")
            done += 1
        yield pa.record_batch([pa.array([done], pa.int64())], names=["files"])

    return put


def write_rolled(df: DataFrame, path: str, time: str, order: str, value: str = "value", size: int = ROLL_BYTES) -> None:
    """Text files of about ``size`` bytes at most, in a folder per bucket and roll; visible when all are written.

    It is the number of files that takes the time, however few bytes they hold: all cores write them, and each task puts
    its own in place, in a folder beside ``path`` that Spark's readers pass over. That folder is then given its name.
    Files of the local file system (or one mounted by all executors) are written by Python, since Spark would start a
    process for each file and folder there, to set its mode; they have no checksum files.
    """
    spark = df.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rolls = rolled(df, time, order, value, size).repartition(tasks, "bucket", "roll").sortWithinPartitions("bucket", "roll", order)
    rolls = rolls.select("bucket", "roll", value)
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    staged = hadoop.Path(place.getParent(), f".{place.getName()}")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getUri().getScheme() == "file" and isinstance(rolls.schema[value].dataType, T.StringType):
        system.delete(staged, True)
        system.mkdirs(hadoop.Path(staged, "_attempts"))
        rolls.mapInArrow(_put_rolls(system.makeQualified(staged).toUri().getPath()), "files bigint").agg(F.sum("files")).collect()
        system.delete(hadoop.Path(staged, "_attempts"), True)
        system.create(hadoop.Path(staged, "_SUCCESS")).close()
    else:
        writer = rolls.write.mode("overwrite").partitionBy("bucket", "roll")
        writer.options(**{"compression": "none", "mapreduce.fileoutputcommitter.algorithm.version": "2"}).text(staged.toString())
    system.delete(place, True)
    if not system.rename(staged, place):
        raise OSError(f"{staged.toString()} could not be renamed to {path}")


def rolled_stream(
    df: DataFrame, path: str, checkpoint: str, time: str, order: str, value: str = "value", size: int = ROLL_BYTES, every: str | None = "10 seconds"
) -> DataStreamWriter:
    """Files that roll by size and by time: a micro-batch, begun every so often, rolls its own, in ``path/batch=n``.

    A micro-batch that is repeated after a failure replaces what it had written, so that each line is there once.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        write_rolled(batch, f"{path}/batch={batch_id}", time, order, value, size)

    writer = df.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer


def read_rolled(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their ``batch``, ``bucket`` and ``roll``, and the ``file`` that holds them with its ``size``.

    The folders' names are read row by row: as partitions Spark would compare them on the driver, in a time that grows
    with the square of their number. A file is read at once, which costs less than to read it line by line.
    """
    found = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="part-*").load(path)
    named = lambda part: F.regexp_extract("path", r"batch=(\d+)/bucket=([^/]*)/roll=(\d+)/[^/]*$", part)
    return found.select(
        F.explode(F.split(F.expr("substr(content, 1, length - 1)").cast("string"), "\n")).alias("value"),
        named(1).cast("bigint").alias("batch"),
        F.nullif(named(2), F.lit(NO_BUCKET)).alias("bucket"),
        named(3).cast("bigint").alias("roll"),
        F.col("path").alias("file"),
        F.col("length").alias("size"),
    )


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their bucket."""
    return spark.read.schema("value string, bucket string").text(path)
