"""Watermarks per row, late-data classes and window firings, exact in arrival order.

The watermark a row meets is the one left by the rows before it: the highest event
time so far, less the allowed delay, less 1 ms. All of these are prefix maxima over
the whole table, computed by segments of the arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.time import seconds
from tidemark.operators.scan import check_order, running, running_count, running_max, running_sum
from tidemark.operators.windows import END, START

ON_TIME, LATE_ACCEPTED, DROPPED = "on_time", "late_accepted", "dropped"


def shifted(df: DataFrame, column: Column, like: str, span: float) -> Column:
    """``column`` moved by ``span`` seconds, for a time type as that of column ``like``."""
    kind = df.schema[like].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return column + seconds(span)
    return column + F.lit(span)


def watermarks(
    df, time: str, order: Sequence[str], delay: float = 0, name: str = "watermark", segment: Column | None = None
) -> DataFrame:
    """Every row with the watermark before it (null before the first row)."""
    seen = running(df, [], order, {"__max": running_max(F.col(time)).excluding_current()}, segment)
    return seen.withColumn(name, shifted(df, F.col("__max"), time, -(delay + 0.001))).drop("__max")


def late_classify(
    df,
    time: str,
    order: Sequence[str],
    size: str,
    delay: float = 0,
    lateness: float = 0,
    segment: Column | None = None,
    known: Column | None = None,
) -> DataFrame:
    """Every row with its tumbling window and ``late_class``.

    ``on_time``: the window was still open. ``late_accepted``: closed, but within the
    allowed lateness. ``dropped``: beyond it. ``known`` is the highest event time before
    the first row, if there was one.
    """
    seen = running(df, [], order, {"__max": running_max(F.col(time)).excluding_current()}, segment)
    if known is not None:
        seen = seen.withColumn("__max", F.greatest("__max", known))
    seen = seen.withColumn("__w", F.window(time, size))
    seen = seen.select(*df.columns, "__max", F.col("__w.start").alias(START), F.col("__w.end").alias(END))
    # Both sides of "end - 1 ms <= max - delay - 1 ms" lose their millisecond.
    closed = F.col(END) <= shifted(df, F.col("__max"), time, -delay)
    gone = F.col(END) <= shifted(df, F.col("__max"), time, -(delay + lateness))
    late = F.when(gone, F.lit(DROPPED)).when(closed, F.lit(LATE_ACCEPTED)).otherwise(F.lit(ON_TIME))
    return seen.withColumn("late_class", late).drop("__max")


def late_side_output(df, time, order, size, delay=0, lateness=0, segment: Column | None = None) -> DataFrame:
    """The rows a window would drop."""
    classed = late_classify(df, time, order, size, delay, lateness, segment)
    return classed.where(F.col("late_class") == DROPPED).drop("late_class")


def window_firings(
    df,
    keys: Sequence[str],
    time: str,
    order: Sequence[str],
    size: str,
    value: str,
    delay: float = 0,
    lateness: float = 0,
    segment: Column | None = None,
) -> DataFrame:
    """One row per firing of each key's window: row count and sum of ``value`` so far.

    A window first fires when the watermark passes its end, and again for every row
    accepted late. Windows the watermark never passes do not fire.
    """
    order = check_order(df, order)
    bounds = [*keys, START, END]
    narrow = df.select(*dict.fromkeys([*keys, time, *order, value]))
    classed = late_classify(narrow, time, order, size, delay, lateness, segment)
    passed = df.select(F.max(time).alias(time)).select(shifted(df, F.col(time), time, -delay).alias("v")).scalar()
    # A window's rows in time all come before its late ones: the first firing is a plain aggregate, and only late rows,
    # of which there are few, are folded one after another on top of it.
    in_time = classed.where(F.col("late_class") == ON_TIME).groupBy(*bounds).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__total")
    )
    first = in_time.where(F.col(END) <= passed)
    first = first.select(*bounds, F.lit(1).cast("bigint").alias("firing"), F.col("__n").alias("cnt"), F.col("__total").alias("total"))
    late = classed.where(F.col("late_class") == LATE_ACCEPTED)
    so_far = running(late, bounds, order, {"__late": running_count(), "__more": running_sum(F.col(value))}, segment)
    named = in_time.select(*(F.col(c).alias(f"__{c}") for c in bounds), "__n", "__total")
    met = so_far.join(named, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in bounds], "left")
    n = F.coalesce("__n", F.lit(0))
    again = met.select(
        *bounds,
        ((n > 0).cast("bigint") + F.col("__late")).alias("firing"),
        (n + F.col("__late")).alias("cnt"),
        F.coalesce(F.col("__total") + F.col("__more"), "__total", "__more").alias("total"),
    )
    return first.unionByName(again)
