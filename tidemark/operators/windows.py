"""Time, session, count and trigger windows over batches (time windows also over streams)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.time import format_time
from tidemark.operators.scan import check_order, running, running_count, running_max, running_sum, with_segment

START, END = "window_start", "window_end"

# Rows of a key that a sliding count window takes together.
BLOCK_ROWS = 1 << 16


def tumble(df: DataFrame, keys: Sequence[str], time: str, size: str, aggs: Mapping[str, Column]) -> DataFrame:
    """Aggregates per key and tumbling window. No keys: one window over all rows, still parallel."""
    return slide(df, keys, time, size, size, aggs)


def slide(
    df: DataFrame, keys: Sequence[str], time: str, size: str, step: str, aggs: Mapping[str, Column]
) -> DataFrame:
    """Aggregates per key and sliding window."""
    window = F.window(time, size, step)
    grouped = df.groupBy(*keys, window.alias("window")).agg(*(c.alias(n) for n, c in aggs.items()))
    return grouped.select(*keys, F.col("window.start").alias(START), F.col("window.end").alias(END), *aggs)


def tumble_proc(df: DataFrame, keys: Sequence[str], size: str, aggs: Mapping[str, Column]) -> DataFrame:
    """Tumbling windows over the time a stream's row is processed."""
    return slide_proc(df, keys, size, size, aggs)


def slide_proc(df: DataFrame, keys: Sequence[str], size: str, step: str, aggs: Mapping[str, Column]) -> DataFrame:
    """Sliding windows over the time a stream's row is processed."""
    return slide(df.withColumn("__now", F.current_timestamp()), keys, "__now", size, step, aggs)


def session_stream(df: DataFrame, keys: Sequence[str], time: str, gap, aggs: Mapping[str, Column]) -> DataFrame:
    """Session windows by Spark's own operator; the form for streams.

    ``gap`` is an interval string, or a column of interval strings for a gap per row.
    """
    window = F.session_window(time, gap)
    grouped = df.groupBy(*keys, window.alias("window")).agg(*(c.alias(n) for n, c in aggs.items()))
    return grouped.select(*keys, F.col("window.start").alias(START), F.col("window.end").alias(END), *aggs)


# How partial values of a session aggregate combine.
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_PARTIAL = {"count": lambda c: F.count(c), "sum": F.sum, "min": F.min, "max": F.max}


def session(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    gap: Column,
    aggs: Mapping[str, tuple[str, Column]],
    segment: Column | None = None,
) -> DataFrame:
    """Session windows per key for batches; ``gap`` is an interval, constant or per row.

    A row joins the session whose end (highest time + gap so far) it does not
    exceed. ``aggs`` maps a name to (``count|sum|min|max``, column).

    Sessions are closed inside each segment of a key. Only the fragments that touch
    a segment border, at most two per segment, are merged per key.
    """
    keys = list(keys)
    rows = df.withColumn("__end", F.col(time) + gap)
    reach = running_max(F.col("__end")).excluding_current()
    rows = running(rows, keys, [time], {"__reach": reach}, segment, keep_segment="__seg")
    opens = F.when(F.col("__reach").isNull() | (F.col(time) > F.col("__reach")), 1).otherwise(0)
    along = Window.partitionBy(*keys, "__seg").orderBy("__seg_row", time)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_all = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("__opens", opens)
    rows = rows.withColumns({"__no": F.sum("__opens").over(so_far), "__last": F.sum("__opens").over(in_all)})
    fragments = rows.groupBy(*keys, "__seg", "__no", "__last").agg(
        F.min(time).alias(START),
        F.max("__end").alias(END),
        *(_PARTIAL[kind](c).alias(n) for n, (kind, c) in aggs.items()),
    )
    # A fragment inside its segment is a group of its own; those at the borders of a
    # key's segments form one group, numbered along the order.
    inner = (F.col("__no") > 0) & (F.col("__no") < F.col("__last"))
    fragments = fragments.withColumn("__own_seg", F.when(inner, F.col("__seg"))).withColumn(
        "__own_no", F.when(inner, F.col("__no"))
    )
    group = [*keys, "__own_seg", "__own_no"]
    across = Window.partitionBy(*group).orderBy("__seg", "__no")
    opened = F.sum((F.col("__no") > 0).cast("bigint")).over(
        across.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = fragments.withColumn("__session", opened).groupBy(*group, "__session")
    return merged.agg(
        F.min(START).alias(START),
        F.max(END).alias(END),
        *(_MERGE[kind](n).alias(n) for n, (kind, _) in aggs.items()),
    ).select(*keys, START, END, *aggs)


def count_tumble(
    df, keys: Sequence[str], order: Sequence[str], size: int, aggs: Mapping[str, Column], segment: Column | None = None
) -> DataFrame:
    """Aggregates per key over each ``size`` rows; an incomplete last window never fires."""
    numbered = running(df, keys, order, {"__rn": running_count()}, segment)
    grouped = numbered.groupBy(*keys, F.floor((F.col("__rn") - 1) / size).alias("window_no")).agg(
        F.count(F.lit(1)).alias("__n"), *(c.alias(n) for n, c in aggs.items())
    )
    return grouped.where(F.col("__n") == size).drop("__n")


def count_slide(
    df,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    step: int,
    aggs: Mapping[str, Column],
    segment: Column | None = None,
) -> DataFrame:
    """Aggregates over the last ``size`` rows of a key, at every ``step``-th row.

    Firing k is at the key's row k*step, so the first firings hold fewer rows. Plain
    aggregate functions are computed over a frame of rows, within blocks of a key's rows
    that borrow the last ``size - 1`` rows of the block before: a row is copied once at
    most, and a hot key is spread over its blocks. Other expressions of aggregates can't
    be framed; for them each row is copied to the firings it takes part in.
    """
    numbered = running(df, keys, order, {"__rn": running_count()}, segment)
    rn = F.col("__rn")
    block = max(size, BLOCK_ROWS)
    own = F.floor((rn - 1) / block)
    lent = F.when(rn > (own + 1) * block - (size - 1), F.array(own, own + 1)).otherwise(F.array(own))
    blocks = numbered.withColumn("__block", F.explode(lent))
    frame = Window.partitionBy(*keys, "__block").orderBy("__rn").rowsBetween(1 - size, 0)
    try:
        framed = blocks.select(*keys, "__block", "__rn", *(c.over(frame).alias(n) for n, c in aggs.items()))
    except AnalysisException:
        return _copied_slide(numbered, keys, size, step, aggs)
    fired = framed.where((rn % step == 0) & (F.col("__block") == own))
    return fired.select(*keys, F.floor(rn / step).alias("firing"), *aggs)


def _copied_slide(numbered: DataFrame, keys: Sequence[str], size: int, step: int, aggs: Mapping[str, Column]) -> DataFrame:
    rn = F.col("__rn")
    fires = F.sequence(F.ceil(rn / step), F.floor((rn + size - 1) / step))
    copies = numbered.where(F.ceil(rn / step) <= F.floor((rn + size - 1) / step))
    copies = copies.withColumn("firing", F.explode(fires))
    grouped = copies.groupBy(*keys, "firing").agg(
        F.max("__rn").alias("__newest"), *(c.alias(n) for n, c in aggs.items())
    )
    return grouped.where(F.col("__newest") == F.col("firing") * step).drop("__newest")


def global_trigger(
    df,
    keys: Sequence[str],
    order: Sequence[str],
    fires: Column,
    aggs: Mapping[str, Column],
    segment: Column | None = None,
) -> DataFrame:
    """Rows of a key up to and including each row where ``fires`` holds; what follows the
    last such row never fires."""
    marked = df.withColumn("__fires", F.coalesce(fires, F.lit(False)).cast("bigint"))
    numbered = running(marked, keys, order, {"__no": running_sum(F.col("__fires")).excluding_current()}, segment)
    numbered = numbered.withColumn("window_no", F.coalesce("__no", F.lit(0).cast("bigint")))
    grouped = numbered.groupBy(*keys, "window_no").agg(
        F.max("__fires").alias("__fired"), *(c.alias(n) for n, c in aggs.items())
    )
    return grouped.where(F.col("__fired") == 1).drop("__fired")


def window_reduce(df: DataFrame, keys: Sequence[str], time: str, size: str, value: str, order: str) -> DataFrame:
    """Sum of ``value`` and the newest event time per key and window."""
    aggs = {time: F.max_by(time, order), value: F.sum(value)}
    grouped = df.groupBy(*keys, F.window(time, size).alias("window")).agg(
        *(c.alias(f"__{n}") for n, c in aggs.items())
    )
    return grouped.select(
        *keys,
        F.col("window.start").alias(START),
        F.col("window.end").alias(END),
        *(F.col(f"__{n}").alias(n) for n in aggs),
    )


def window_aggregate(df: DataFrame, keys: Sequence[str], time: str, size: str, value: str) -> DataFrame:
    """Sum per key and window, as text."""
    return tumble(df, keys, time, size, {"result": F.sum(value).cast("string")})


def window_agg_meta(df: DataFrame, keys: Sequence[str], time: str, size: str, value: str) -> DataFrame:
    """Sum as text per key and window, with formatted bounds and the number of rows."""
    plain = tumble(df, keys, time, size, {"result": F.sum(value).cast("string"), "cnt": F.count(F.lit(1))})
    return window_format(plain)


def window_format(df: DataFrame) -> DataFrame:
    """Window bounds as text with milliseconds."""
    return df.withColumn(START, format_time(F.col(START))).withColumn(END, format_time(F.col(END)))


def window_process(
    df,
    keys: Sequence[str],
    time: str,
    size: str,
    order: Sequence[str],
    element: Column,
    chunk: int = 1000,
    segment: Column | None = None,
) -> DataFrame:
    """All elements of each key and window, in order, with the window's row count.

    Elements come in lists of at most ``chunk``, numbered from 0, so a window of any
    size passes through without one task holding it; small windows have one list.
    """
    order = check_order(df, order)
    window = F.window(time, size)
    rows = df.withColumn("__w", window).select(
        "*", F.col("__w.start").alias(START), F.col("__w.end").alias(END)
    ).drop("__w")
    rows = rows.withColumn("__element", element)
    bounds = [*keys, START, END]
    number = F.floor((F.col("__rn") - 1) / chunk)
    _, cut = with_segment(rows, bounds, order, segment)
    if cut is None:
        # No window is so large that it is cut: the count comes with the numbers.
        within = Window.partitionBy(*bounds)
        every = rows.withColumns({"__rn": F.row_number().over(within.orderBy(*order)), "cnt": F.count(F.lit(1)).over(within)})
        grouped = every.groupBy(*bounds, number.alias("chunk"), "cnt")
        found = grouped.agg(F.sort_array(F.collect_list(F.struct("__rn", "__element"))).alias("__list"))
        return found.select(*bounds, "chunk", "cnt", F.transform("__list", lambda e: e["__element"]).alias("elements"))
    counted = running(rows, bounds, order, {"__rn": running_count()}, segment)
    lists = counted.groupBy(*bounds, number.alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("__rn", "__element"))).alias("__list")
    )
    # The row count reaches every list by (bounds, chunk), so a window with many
    # lists stays spread out.
    counts = rows.groupBy(*bounds).agg(F.count(F.lit(1)).alias("cnt"))
    per_chunk = counts.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("cnt") - 1) / chunk)))
    )
    at = [F.col(f"l.{c}").eqNullSafe(F.col(f"n.{c}")) if c in keys else F.col(f"l.{c}") == F.col(f"n.{c}")
          for c in [*bounds, "chunk"]]
    elements = F.transform("l.__list", lambda e: e["__element"]).alias("elements")
    joined = lists.alias("l").join(per_chunk.alias("n"), at)
    return joined.select(*(f"l.{c}" for c in bounds), "l.chunk", "n.cnt", elements)
