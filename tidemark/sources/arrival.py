"""Streams of stored tables in arrival order, however their files came to be written.

A file stream takes files by modification time, which parallel writers do not control. Here the least and the greatest
arrival of each file decide: files that follow each other, in that order, are streamed where they are. Otherwise the table
is ranged by arrival once, into slices that do not overlap, and the slices are streamed one by one.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.session import scratch_path

# Rows of a slice, which is a micro-batch.
SLICE_ROWS = 1 << 20
# Modification times of slices, which the stream goes by, are so many milliseconds apart.
_APART_MS = 10


def file_spans(table: DataFrame, order: Column) -> DataFrame:
    """(file, written, first, last, nulls): when each file was written, the least and the greatest arrival in it, and whether
    it has rows without one."""
    rows = table.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("written"), order.alias("at"))
    return rows.groupBy("file", "written").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.bool_or(F.col("at").isNull()).alias("nulls"))


def follows(table: DataFrame, order: Column) -> bool:
    """Whether the files, by the time they were written, hold ascending arrivals that do not overlap.

    Reads one column. What meets in one task is a row for each file.
    """
    earlier = Window.orderBy("written", "file").rowsBetween(Window.unboundedPreceding, -1)
    spans = file_spans(table, order).withColumn("before", F.max("last").over(earlier))
    return spans.where((F.col("first") < F.col("before")) | (F.col("nulls") & F.col("before").isNotNull())).isEmpty()


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        raise FileNotFoundError(path)
    return system, place


def _part(name: str) -> tuple[int, str]:
    return int(re.match(r"part-(\d+)", name)[1]), name


def _stamp(spark: SparkSession, path: str) -> int:
    """Give the part files of a folder modification times in the order of their numbers; how many there are."""
    system, place = _file_system(spark, path)
    parts = sorted((s.getPath() for s in system.listStatus(place) if s.getPath().getName().startswith("part-")), key=lambda p: _part(p.getName()))
    start = int(time.time() * 1000) - _APART_MS * len(parts)
    for i, part in enumerate(parts):
        system.setTimes(part, start + _APART_MS * i, -1)
    seen = sorted((s.getModificationTime(), _part(s.getPath().getName())) for s in system.listStatus(place) if s.getPath().getName().startswith("part-"))
    if [p for _, p in seen] != [_part(p.getName()) for p in parts] or len({t for t, _ in seen}) < len(parts):
        raise RuntimeError(f"{path} does not keep modification times: stage the slices in a file system that does")
    return len(parts)


def sliced(table: DataFrame, order: Column, path: str, slices: int = 1, rows: int = SLICE_ROWS) -> int:
    """``table`` as files in ``path`` that hold ascending ranges of ``order`` (a null first), ``slices`` or more of them.

    One exchange by range, as for a sort. Modification times follow the ranges. The result says how many files make a
    slice: one, unless the session cuts an exchange into more partitions than it is asked for.
    """
    count = max(slices, -(-table.count() // rows))
    ranged = table.withColumn("__at", order).repartitionByRange(count, "__at").sortWithinPartitions("__at").drop("__at")
    ranged.write.parquet(path)
    return max(1, -(-_stamp(table.sparkSession, path) // count))


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, order: Column | None = None, files: int = 4, slices: int = 0
) -> DataFrame:
    """A stream of a Parquet table, be it a folder of part files or a single file.

    With ``order`` no row comes in a later micro-batch than one with a greater value: files that lie otherwise are staged
    in the scratch folder, as they are if at least ``slices`` micro-batches are asked for. Without it parts come by their
    modification times, ``files`` of them per micro-batch. A path that is not there raises.
    """
    system, place = _file_system(spark, path)
    reader = spark.readStream.format("parquet").schema(schema)
    if order is not None:
        table = spark.read.schema(schema).parquet(path)
        if slices > 1 or not follows(table, order):
            staged = scratch_path(spark, "arrivals")
            together = sliced(table, order, staged, max(1, slices))
            return reader.option("maxFilesPerTrigger", together).load(staged)
    if system.getFileStatus(place).isDirectory():
        return reader.option("maxFilesPerTrigger", files).load(path)
    return reader.option("pathGlobFilter", place.getName()).load(place.getParent().toString())
