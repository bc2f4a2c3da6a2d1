"""User functions over whole windows of any size: a window's rows stream through in parts, with carried state."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.rolling import _same
from tidemark.operators.scan import check_order
from tidemark.operators.windows import END, START


def with_window(df: DataFrame, time: str, size: str, slide: str | None = None) -> DataFrame:
    """Every row with the bounds of its window; with ``slide`` once for each window that it is in."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    rows = df.withColumn("__w", window)
    return rows.withColumns({START: F.col("__w.start"), END: F.col("__w.end")}).drop("__w")


def process_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    output: str,
    create: Callable[[], Any],
    add: Callable[[Any, pd.DataFrame], Any],
    close: Callable[[Any], list[tuple]],
) -> DataFrame:
    """User code over each key's windows (``window_start``, ``window_end`` of ``with_window``).

    ``add(state, part) -> state`` gets a window's rows in ``order``, part by part, as pandas frames of at most an Arrow
    batch; ``close(state)`` gives the window's rows of ``output`` columns. A task holds one part and one state, so that a
    window may be larger than memory; its rows pass through one task, as code that depends on their order must see them.
    Null keys are keys. Rows without a time have no window, and are left out.
    """
    keys, order = list(keys), check_order(df, order)
    bounds = [*keys, START, END]
    schema = T.StructType([*(df.schema[c] for c in bounds), *T._parse_datatype_string(output).fields])
    arrow = to_arrow_schema(schema)

    def rows_of(at: tuple, state: Any) -> list[dict]:
        return [dict(zip(arrow.names, (*at, *row))) for row in close(state)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            changed = np.zeros(batch.num_rows, dtype=bool)
            for c in bounds:
                codes = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy()
                changed[1:] |= codes[1:] != codes[:-1]
            starts = np.flatnonzero(changed)
            frame = batch.to_pandas()
            for low, high in zip([0, *starts], [*starts, batch.num_rows]):
                if low == high:
                    continue
                at = tuple(_same(batch.column(c)[int(low)].as_py()) for c in bounds)
                if at != now:
                    if now is not None:
                        done += rows_of(now, state)
                    now, state = at, create()
                state = add(state, frame.iloc[low:high])
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done = []
        if now is not None:
            done += rows_of(now, state)
        yield pa.RecordBatch.from_pylist(done, schema=arrow)

    rows = df.where(F.col(START).isNotNull()).repartition(*bounds).sortWithinPartitions(*bounds, *order)
    return rows.mapInArrow(run, schema)


def process_window_stream(
    df: DataFrame, keys, time: str, order, output: str, create, add, close, delay: float, out: str, checkpoint: str
) -> DataStreamWriter:
    """The same over a stream of ``with_window``, in ``out/rows``: a window is processed, once, when the highest event time is
    ``delay`` seconds past its end. Until then its rows wait next to the output; rows that come later are in ``out/late``."""
    from tidemark.streaming.folds import HoldBack, released
    from tidemark.streaming.runs import _drop, _put

    hold = HoldBack(time, delay, END)

    def take(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            ready = released(batch, batch_id, hold, out)
            _put(process_windows(ready, keys, order, output, create, add, close), f"{out}/rows/batch={batch_id}")
            for kind in ("clock", "held"):
                _drop(batch.sparkSession, f"{out}/{kind}/{batch_id - 2}")
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
