"""Keyed-state operators over streams: the same results as the batch forms, row by row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.operators.scan import check_order
from tidemark.streaming import processors as P

# Shares of the keys that hold rows back: a stream keeps their number as long as its checkpoint.
SHARES = 512


def _apply(
    df: DataFrame, keys: Sequence[str], processor, schema: T.StructType, time_mode: str = "none", initial: DataFrame | None = None
) -> DataFrame:
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="append",
        timeMode=time_mode,
        initialState=None if initial is None else initial.groupBy(*keys),
    )


def _plus(df: DataFrame, extra: str, columns: Sequence[str] | None = None) -> T.StructType:
    fields = df.schema.fields if columns is None else [df.schema[c] for c in columns]
    return T.StructType([*fields, *T._parse_datatype_string(extra).fields])


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def keyed_step(df: DataFrame, keys, order, state_schema: str, output: str, step, initial: DataFrame | None = None) -> DataFrame:
    """A user-written step over one state tuple per key: ``step(state, row) -> (state, extra)``.

    ``state`` is None for a key's first row; ``extra`` holds the ``output`` columns,
    or is None to emit nothing for the row. ``initial`` gives keys a state to begin with: one row per key, of the key and
    the state's columns, as ``restore.stored_state`` reads it from a stopped stream. It is read in the first micro-batch
    only, so that a stream that is resumed from its own checkpoint doesn't begin again.
    """
    order = check_order(df, order)
    names = T._parse_datatype_string(output).fieldNames()
    held = T._parse_datatype_string(state_schema)
    blocks = T.StructType([T.StructField("rows", T.ArrayType(_plus(df, output), False))])
    kind = to_arrow_type(blocks).field("rows").type
    processor = P.StepProcessor(order, df.columns, state_schema, names, step, held.fieldNames(), kind)
    if initial is not None:
        kinds = [*(df.schema[k] for k in keys), *held.fields]
        initial = initial.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds))
    return _apply(df, keys, processor, blocks, initial=initial).select(F.inline("rows"))


def process(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    state_schema: str,
    output: str,
    on_row: Callable,
    on_timer: Callable | None = None,
    clock: str = "none",
    hold: str | None = None,
    on_late: Callable | None = None,
) -> DataFrame:
    """User code per key, with one state tuple, timers and tagged outputs.

    ``on_row(context, state, row) -> state`` sees a key's rows in order, ``on_timer(context, state, at_ms) -> state`` each
    timer that is due; state is None until set. ``context.emit(tag, *values)`` gives a row of the key, ``tag`` and the
    ``output`` columns: the tags are the side outputs. ``context.register(ms)`` and ``context.cancel(ms)`` set timers by
    ``clock``: ``eventTime`` (the input needs a watermark) or ``processingTime``; ``context.now`` is that clock.

    ``hold`` names a column of epoch milliseconds: rows then wait in state until the watermark passes that time, and the
    user code sees rows and timers in the order of time (ties by ``order``, timers last), with ``context.now`` that time;
    rows that come when it has passed go to ``on_late(context, state, row) -> state`` instead. The clock is event time.
    """
    order = check_order(df, order)
    if clock not in ("none", "eventTime", "processingTime"):
        raise ValueError("clock is 'none', 'eventTime' or 'processingTime'")
    names = T._parse_datatype_string(output).fieldNames()
    schema = _plus(df, f"tag string, {output}", keys)
    if hold is None:
        processor = P.UserProcessor(order, keys, state_schema, names, on_row, on_timer, clock)
        return _apply(df, keys, processor, schema, clock)
    # A column with a watermark would have its late rows dropped before they come here.
    marked = [f.name for f in df.schema.fields if "spark.watermarkDelayMs" in (f.metadata or {})]
    df = df.withColumns({c: F.timestamp_micros(F.unix_micros(c)) for c in marked})
    columns = [f.name for f in df.schema.fields if f.name not in keys or f.name in order]
    fields = [(f"key{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    fields += [("due", T.ArrayType(T.LongType())), ("given", T.BooleanType())]
    fields += [(f"state{i}", f.dataType) for i, f in enumerate(T._parse_datatype_string(state_schema).fields)]
    kept = pa.schema([(name, to_arrow_type(kind, timestamp_utc=False)) for name, kind in fields])
    blocks = T.StructType([T.StructField("rows", T.ArrayType(schema, False))])
    kind = to_arrow_type(blocks).field("rows").type
    processor = P.ReorderProcessor(order, keys, columns, hold, on_late, kept, kind, state_schema, names, on_row, on_timer)
    shares = df.withColumn("__share", F.pmod(F.hash(*keys), F.lit(SHARES))).mapInArrow(P.packed("__share"), "share int, rows binary")
    return _apply(shares, ["share"], processor, blocks, "eventTime").select(F.inline("rows"))


def running_count(df, keys, order, name: str = "cnt", initial: DataFrame | None = None) -> DataFrame:
    """Every row with the key's row count so far; ``initial`` holds what a key has counted before, in ``n``."""

    def step(state, row):
        n = (state[0] if state else 0) + 1
        return (n,), (n,)

    return keyed_step(df, keys, order, "n bigint", f"{name} bigint", step, initial)


def _sum_type(df: DataFrame, column: str) -> str:
    """The type of a sum of the column, as in batches."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(38, kind.precision + 10), kind.scale).simpleString()
    return "bigint" if isinstance(kind, T.IntegralType) else "double"


def running_sum(df, keys, value: str, order, name: str = "total") -> DataFrame:
    """Every row with the key's sum so far, null until it has a value."""

    def step(state, row):
        total, v = state[0] if state else None, row[value]
        total = total if v is None else v if total is None else total + v
        return (total,), (total,)

    kind = _sum_type(df, value)
    return keyed_step(df, keys, order, f"total {kind}", f"{name} {kind}", step)


def running_avg(df, keys, value: str, order, name: str = "avg") -> DataFrame:
    """Every row with the key's mean so far."""

    def step(state, row):
        total, n = state if state else (None, 0)
        if row[value] is not None:
            total, n = row[value] if total is None else total + row[value], n + 1
        return (total, n), (float(total) / n if n else None,)

    return keyed_step(df, keys, order, f"total {_sum_type(df, value)}, n bigint", f"{name} double", step)


def rolling_reduce(df, keys, value: str, order) -> DataFrame:
    """Running sum in ``total``; every other field is that of the newest row."""
    return running_sum(df, keys, value, order)


def jump_alert(df, keys, value: str, order, threshold: float = 10) -> DataFrame:
    """Rows that differ from the key's previous value by more than ``threshold``."""
    kind = _type(df, value)

    def step(state, row):
        last = state[0] if state and state[0] is not None else 0
        v = row[value]
        return (v,), ((last,) if v is not None and abs(v - last) > threshold else None)

    return keyed_step(df, keys, order, f"last {kind}", f"last_vc {kind}", step)


def running_top_n(df, keys, value: str, order, n: int = 3) -> DataFrame:
    """Every row with the key's n highest values so far."""
    kind = _type(df, value)
    processor = P.TopProcessor(check_order(df, order), df.columns, value, kind, n)
    return _apply(df, keys, processor, _plus(df, f"top array<{kind}>"))


def running_value_counts(df, keys, value: str, order) -> DataFrame:
    """Every row with the count of its (key, value) so far."""
    processor = P.ValueCountProcessor(check_order(df, order), df.columns, value, _type(df, value))
    return _apply(df, keys, processor, _plus(df, "cnt bigint"))


def _count_window(df, keys, value, order, size, step, whole):
    kind = _type(df, value)
    processor = P.CountWindowProcessor(check_order(df, order), df.columns, keys, value, kind, size, step, whole)
    return _apply(df, keys, processor, _plus(df, f"firing bigint, elements array<{kind}>", keys))


def count_slide(df, keys, value: str, order, size: int, step: int) -> DataFrame:
    """The last ``size`` values of a key at every ``step``-th row."""
    return _count_window(df, keys, value, order, size, step, whole=False)


def count_tumble(df, keys, value: str, order, size: int) -> DataFrame:
    """Each ``size`` values of a key; an incomplete window never fires."""
    return _count_window(df, keys, value, order, size, size, whole=True)


def ttl_last_value(df, keys, value: str, order, ttl_ms: int = 5000) -> DataFrame:
    """The value state held before each row; it expires ``ttl_ms`` after its write, by the wall clock."""
    kind = _type(df, value)
    processor = P.TtlProcessor(check_order(df, order), df.columns, value, kind, ttl_ms, False, None)
    return _apply(df, keys, processor, _plus(df, f"last_vc {kind}"), "processingTime")


def ttl_read_refresh(df, keys, value: str, order, write: str, ttl_ms: int = 5000) -> DataFrame:
    """As ``ttl_last_value``, but a read prolongs the state and only rows with ``write`` replace it."""
    kind = _type(df, value)
    processor = P.TtlProcessor(check_order(df, order), df.columns, value, kind, ttl_ms, True, write)
    return _apply(df, keys, processor, _plus(df, f"last_vc {kind}"), "processingTime")


def event_timer(df, keys, time: str, at_ms: int, delay: str, refire: bool = False) -> DataFrame:
    """Firings of an event-time timer at ``at_ms`` that every row registers."""
    marked = df.select(*keys, time).withWatermark(time, delay)
    processor = P.TimerProcessor(keys, at_ms, refire)
    return _apply(marked, keys, processor, _plus(df, "fired_at_ms bigint, firing bigint", keys), "eventTime")
