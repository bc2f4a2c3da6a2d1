"""User-written aggregates over streams: pickled accumulators, one per key, merged with those of each micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.lateness import shifted
from tidemark.operators.rolling import accumulators, results
from tidemark.sources.keyed_table import KeyedTable
from tidemark.streaming.folds import HoldBack
from tidemark.streaming.runs import _drop, _put


def custom_fold_stream(
    df: DataFrame,
    keys: Sequence[str],
    create,
    add,
    merge,
    result,
    result_type: str,
    out: str,
    checkpoint: str,
    name: str = "result",
    closing: HoldBack | None = None,
    every: int = 16,
) -> DataStreamWriter:
    """``rolling.custom_fold`` over a stream, in ``out/rows``.

    Without ``closing`` each micro-batch gives the results of the keys that it holds, by ``batch``; the newest counts. With
    it a key (of which ``closing.due`` is one, the end of a window, say) gives its result once, when the highest event time
    has passed its due time by the delay, and its accumulator is let go; rows that come later are in ``out/late``.
    """
    keys = list(keys)
    if closing and closing.due not in keys:
        raise ValueError("closing.due is one of the keys")
    state = T.StructType([*(df.schema[k] for k in keys), T.StructField("accumulator", T.BinaryType())])
    clock = None if closing is None else T.StructType([T.StructField("high", df.schema[closing.time].dataType)])

    def mark(batch: DataFrame, batch_id: int):
        high = batch.sparkSession.read.schema(clock).parquet(f"{out}/clock/{batch_id}").scalar()
        return shifted(batch, high, closing.time, -closing.delay)

    def take(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            spark, rows, gone = batch.sparkSession, batch, None
            table = KeyedTable(spark, f"{out}/state", keys, state, every)
            table.begin(batch_id)
            if closing:
                newest, due = F.max(closing.time), F.col(closing.due)
                late = due.isNull()
                if batch_id:
                    late = late | F.coalesce(due <= mark(batch, batch_id - 1), F.lit(False))
                    gone = table.read(batch_id).where(due <= mark(batch, batch_id - 1))
                    newest = F.greatest(newest, spark.read.schema(clock).parquet(f"{out}/clock/{batch_id - 1}").scalar())
                _put(batch.where(late), f"{out}/late/batch={batch_id}")
                _put(batch.agg(newest.alias("high")), f"{out}/clock/{batch_id}")
                rows = batch.where(~late)
            held = table.read(batch_id, rows.select(*keys)) if batch_id else None
            fresh = accumulators(rows, keys, create, add, merge, held).withColumn("__done", F.lit(False))
            if gone is not None:
                fresh = fresh.unionByName(gone.withColumn("__done", F.lit(True)))
            table.write(batch_id, fresh, F.col("__done"))
            if closing:
                ready = table.view(batch_id).where(F.col(closing.due) <= mark(batch, batch_id))
            else:
                ready = spark.read.schema(table.stored).parquet(f"{table.path}/delta/{batch_id}")
            _put(results(ready, keys, result, result_type, name), f"{out}/rows/batch={batch_id}")
            _drop(spark, f"{out}/clock/{batch_id - 2}")
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
