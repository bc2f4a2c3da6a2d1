"""Database tables: incremental reads and batched writes. Connection details are the caller's."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.schema import cast_to_schema
from tidemark.functions.text import rows_from_json


def read_range(
    spark: SparkSession, options: dict[str, str], column: str, start: int, stop: int, partitions: int = 8
) -> DataFrame:
    """Rows with ``column`` in [start, stop), read in parallel ranges of that column."""
    reader = spark.read.format("jdbc").options(**options)
    reader = reader.options(
        partitionColumn=column, lowerBound=start, upperBound=max(stop, start + 1), numPartitions=partitions
    )
    return incremental_scan(reader.load(), column, start, stop)


def incremental_scan(table: DataFrame, column: str, start: int, stop: int) -> DataFrame:
    """The rows of one poll: ``column`` in [start, stop). The filter reaches the source.

    Half-open ranges that follow one another deliver each row exactly once.
    """
    return table.where((F.col(column) >= start) & (F.col(column) < stop))


def next_stop(table: DataFrame, column: str, start: int) -> int:
    """Where a poll that begins at ``start`` has to end now."""
    highest = table.where(F.col(column) >= start).agg(F.max(column)).first()[0]
    return start if highest is None else int(highest) + 1


def write_options(batch_rows: int = 100, **connection: str) -> dict[str, str]:
    """Writer options: rows per database batch, then url, dbtable, user and so on."""
    for needed in ("url", "dbtable"):
        if needed not in connection:
            raise ValueError(f"{needed} is required")
    return {**connection, "batchsize": str(batch_rows)}


def write_batch(
    options: dict[str, str], columns: Sequence[str] | None = None, format: str = "jdbc"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function appending to a table by column name.

    Leave a generated key out of ``columns`` and the database fills it. A repeated
    micro-batch is written again: keep a unique key in the table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns) if columns else batch
        rows.write.format(format).options(**options).mode("append").save()

    return write


def write_stream(
    df: DataFrame,
    options: dict[str, str],
    checkpoint: str,
    every: str = "3 seconds",
    columns: Sequence[str] | None = None,
    format: str = "jdbc",
):
    """A stream into a table, one database batch series per trigger."""
    return (
        df.writeStream.foreachBatch(write_batch(options, columns, format))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
    )


def json_rows(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON strings to the typed rows a table takes, matched by field name."""
    return cast_to_schema(rows_from_json(df, schema, value), schema)
