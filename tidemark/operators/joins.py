"""Unions, joins and co-processing of two inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.time import epoch_seconds
from tidemark.operators.lateness import shifted
from tidemark.operators.scan import last_known, running, running_max
from tidemark.session import scratch_root


def union_all(*inputs: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates included."""
    result = inputs[0]
    for other in inputs[1:]:
        result = result.unionByName(other)
    return result


def connect_map(
    left: DataFrame, right: DataFrame, left_map: Mapping[str, Column], right_map: Mapping[str, Column]
) -> DataFrame:
    """Two differently typed inputs, each mapped by its own expressions to one output type."""
    return left.select(*(c.alias(n) for n, c in left_map.items())).unionByName(
        right.select(*(c.alias(n) for n, c in right_map.items()))
    )


def _distinct_names(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    shared = (set(left.columns) & set(right.columns)) - set(on)
    if shared:
        raise ValueError(f"rename columns present on both sides: {sorted(shared)}")


def equi_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on equal keys, every match once. Spark picks the strategy; AQE splits skewed keys."""
    _distinct_names(left, right, on)
    return left.join(right, list(on), "inner")


def window_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, size: str
) -> DataFrame:
    """Inner join of rows with equal keys in the same tumbling window."""
    _distinct_names(left, right, on)
    l = left.withColumn("__window", F.window(left_time, size))
    r = right.withColumn("__window", F.window(right_time, size))
    if left.isStreaming or right.isStreaming:
        # A joined stream may have one event-time column: the window. Recomputed from
        # its microseconds, the row's own time is an ordinary column.
        l = l.withColumn(left_time, F.timestamp_micros(F.unix_micros(left_time)))
        r = r.withColumn(right_time, F.timestamp_micros(F.unix_micros(right_time)))
    joined = l.join(r, [*on, "__window"], "inner")
    return joined.select(
        *on,
        F.col("__window.start").alias("window_start"),
        F.col("__window.end").alias("window_end"),
        *(c for c in left.columns if c not in on),
        *(c for c in right.columns if c not in on),
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    lower: float,
    upper: float,
) -> DataFrame:
    """Pairs with equal keys and ``right_time`` within [left_time + lower, left_time + upper] seconds.

    Both bounds are inclusive. On batches, time is cut into buckets as wide as the
    interval and a left row meets only the buckets its interval touches, so a hot
    key is spread over time instead of being compared with its whole history. On
    streams this is Spark's interval join; watermark both inputs.
    """
    _distinct_names(left, right, on)
    inside = F.col(right_time).between(
        shifted(left, F.col(left_time), left_time, lower), shifted(left, F.col(left_time), left_time, upper)
    )
    columns = [*on, *(c for c in left.columns if c not in on), *(c for c in right.columns if c not in on)]
    if left.isStreaming or right.isStreaming:
        keyed = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on]
        joined = left.alias("l").join(right.alias("r"), [*keyed, inside], "inner")
        return joined.select(*(F.col(f"l.{c}") if c in on else F.col(c) for c in columns))
    width = max(1, int(upper - lower) + 1)
    low = F.floor((epoch_seconds(left, left_time) + F.floor(F.lit(lower))) / width)
    # One second more: fractions of a second are cut off by epoch_seconds.
    high = F.floor((epoch_seconds(left, left_time) + F.ceil(F.lit(upper)) + 1) / width)
    l = left.withColumn("__bucket", F.explode(F.sequence(low, high)))
    r = right.withColumn("__bucket", F.floor(epoch_seconds(right, right_time) / width))
    return l.join(r, [*on, "__bucket"], "inner").where(inside).select(*columns)


def tag_sides(
    left: DataFrame, right: DataFrame, left_time: str, right_time: str, order: Sequence[str], segment: Column | None = None
) -> DataFrame:
    """Both inputs as one: the order columns, ``side`` (``l`` or ``r``), ``time``, and each row whole in ``l`` or ``r``;
    with a ``segment`` of their order columns, that as ``cut``."""

    def row(df: DataFrame) -> Column:
        return F.struct(*df.columns)

    kinds = {name: df.select(row(df).alias("row")).schema["row"].dataType for name, df in (("l", left), ("r", right))}

    def side(df: DataFrame, name: str, time: str) -> DataFrame:
        rows = {n: row(df) if n == name else F.lit(None).cast(kind) for n, kind in kinds.items()}
        places = [F.col(c).alias(f"order_{i}") for i, c in enumerate(order)]
        if segment is not None:
            places.append(segment.alias("cut"))
        return df.select(*places, F.lit(name).alias("side"), F.col(time).alias("time"), *(c.alias(n) for n, c in rows.items()))

    return side(left, "l", left_time).unionByName(side(right, "r", right_time))


def judge_sides(tagged: DataFrame, delay: float, segment: Column | None = None, known: DataFrame | None = None) -> DataFrame:
    """``tagged`` with ``late``: whether a row's time is below the watermark it meets, that of the slower side.

    Until both sides have delivered there is no watermark. ``known`` (one row: ``high_l``, ``high_r``) has the highest
    times before the first row, if there were any. Both sides are folded at once, in the order of arrival.
    """
    order = [c for c in tagged.columns if c.startswith("order_")]
    folds = {
        f"__{side}": running_max(F.when(F.col("side") == side, F.col("time"))).excluding_current() for side in "lr"
    }
    seen = running(tagged, [], order, folds, segment)
    highs = [F.col("__l"), F.col("__r")]
    if known is not None:
        # Of two maxima the other counts where one is null.
        highs = [F.greatest(h, known.select(f"high_{side}").scalar()) for h, side in zip(highs, "lr")]
    mark = shifted(tagged, F.least(*highs), "time", -(delay + 0.001))
    late = F.coalesce(highs[0].isNotNull() & highs[1].isNotNull() & (F.col("time") < mark), F.lit(False))
    return seen.withColumn("late", late).select(*tagged.columns, "late")


def interval_join_late(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    order: Sequence[str],
    lower: float,
    upper: float,
    delay: float = 0,
    segment: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Interval join that turns late rows away: (joined, late left rows, late right rows).

    ``order`` are columns of both inputs giving their common arrival order. The
    watermark is that of the slower side; a row is late when its time is below the
    watermark it meets. Until both sides have delivered there is no watermark.

    Both inputs are judged together, once: the judged rows are written to the checkpoint
    folder, and all three outputs read them there.
    """
    order = list(order)
    scratch_root(left.sparkSession)
    tagged = tag_sides(left, right, left_time, right_time, order, segment)
    judged = judge_sides(tagged, delay, None if segment is None else F.col("cut")).checkpoint()
    l, r = (judged.where(F.col("side") == n).select("late", f"{n}.*") for n in "lr")
    in_time = [d.where(~F.col("late")).drop("late") for d in (l, r)]
    # The arrival columns stay with the late rows; in the pairs they would clash.
    right_kept = in_time[1].drop(*(c for c in order if c not in on))
    joined = interval_join(in_time[0], right_kept, on, left_time, right_time, lower, upper)
    return joined, l.where("late").drop("late"), r.where("late").drop("late")


def broadcast_threshold(
    rows: DataFrame,
    rules: DataFrame,
    order: Sequence[str],
    threshold: str,
    default: object = 0,
    name: str = "threshold",
    segment: Column | None = None,
) -> DataFrame:
    """Every row with the newest rule value that had arrived before it.

    ``order`` are columns of both inputs giving their common arrival order. No rule is
    replicated: rows and rules are folded together along the arrival order.
    """
    value = F.col("__rule")
    both = rows.withColumn("__is_row", F.lit(True)).unionByName(
        rules.select(*order, F.col(threshold).alias("__rule"), F.lit(False).alias("__is_row")),
        allowMissingColumns=True,
    )
    seen = running(both, [], order, {"__newest": last_known(value).excluding_current()}, segment)
    return (
        seen.where("__is_row")
        .withColumn(name, F.coalesce(F.col("__newest"), F.lit(default)))
        .select(*rows.columns, name)
    )
