"""Streams into files of a table format."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.schema import cast_to_schema


def table_stream(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None
) -> DataStreamWriter:
    """Append a stream to a table, exactly once. ``fmt`` is any installed streaming format.

    Without ``every`` the stream takes what is there and ends.
    """
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def typed_table_stream(
    df: DataFrame, schema: T.StructType, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = "5 seconds"
) -> DataStreamWriter:
    """Rows cast to the table's schema, then appended."""
    return table_stream(cast_to_schema(df, schema), path, checkpoint, fmt, every)
