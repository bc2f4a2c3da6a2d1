"""Tables kept by a log of inserts, updates and deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter


def latest(log: DataFrame, keys: Sequence[str], seq: str, op: str = "op", delete: object = "delete") -> DataFrame:
    """The table after the whole log: newest change per key, deleted keys left out.

    ``seq`` must be unique per key. The newest change is an aggregate, so a key with
    very many changes is reduced before the exchange.
    """
    rest = [c for c in log.columns if c not in keys]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("__row"))
    table = newest.select(*(F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in log.columns))
    return table if delete is None else table.where(~F.col(op).eqNullSafe(F.lit(delete)))


def apply_stream(
    log: DataFrame, keys: Sequence[str], seq: str, path: str, checkpoint: str, op: str = "op", delete: object = "delete", every: int = 16
) -> DataStreamWriter:
    """Keeps in ``path`` the table that a stream of changes leads to; ``stored`` reads it.

    Each micro-batch writes the newest change of each key it holds, deletions as such, next to a base that is made anew
    every so many. Micro-batches must follow ``seq`` (``sources.arrival``); it must be unique per key.
    """
    from tidemark.sources.keyed_table import KeyedTable

    def take(batch: DataFrame, batch_id: int) -> None:
        table = KeyedTable(batch.sparkSession, path, keys, log.schema, every)
        table.begin(batch_id)
        newest = latest(batch, keys, seq, op, delete=None)
        table.write(batch_id, newest, F.col(op).eqNullSafe(F.lit(delete)))
        batch.sparkSession.createDataFrame([(batch_id,)], "batch bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/last")

    return log.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)


def stored(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, every: int = 16) -> DataFrame:
    """The table that ``apply_stream`` has kept in ``path`` so far."""
    from tidemark.sources.keyed_table import KeyedTable

    last = spark.read.schema("batch bigint").parquet(f"{path}/last").first()["batch"]
    return KeyedTable(spark, path, keys, schema, every).view(last)


def appended(log: DataFrame) -> DataFrame:
    """The raw log: every change is a row of its own."""
    return log


def dedupe(df: DataFrame, record_id: str, time: str | None = None, within: str | None = None) -> DataFrame:
    """One row per record id, for logs written at least once.

    Streams need ``time`` and ``within``: repeats further apart than that are not caught.
    """
    if df.isStreaming:
        if not (time and within):
            raise ValueError("a stream is deduplicated within a time span: give time and within")
        return df.withWatermark(time, within).dropDuplicatesWithinWatermark([record_id])
    return df.dropDuplicates([record_id])


def record_id(df: DataFrame, columns: Sequence[str], name: str = "record_id") -> DataFrame:
    """A deterministic id from the row's own content."""
    return df.withColumn(name, F.sha2(F.to_json(F.struct(*columns)), 256))
