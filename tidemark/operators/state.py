"""Batch forms of the keyed-state operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.time import seconds
from tidemark.operators.scan import (
    check_order,
    last_known,
    previous,
    running,
    running_count,
    running_max,
    running_sum,
    with_segment,
)


def jump_alert(
    df, keys: Sequence[str], value: str, order: Sequence[str], threshold: float = 10, segment: Column | None = None
) -> DataFrame:
    """Rows whose value differs from the key's previous one by more than ``threshold``.

    The value before a key's first row is 0. Adds ``last_vc``.
    """
    before = running(df, keys, order, {"last_vc": previous(F.col(value))}, segment)
    before = before.withColumn("last_vc", F.coalesce("last_vc", F.lit(0)))
    return before.where(F.abs(F.col(value) - F.col("last_vc")) > threshold)


def running_sum_of(
    df, keys: Sequence[str], value: str, order: Sequence[str], name: str = "total", segment: Column | None = None
) -> DataFrame:
    """Every row with the key's sum so far."""
    return running(df, keys, order, {name: running_sum(F.col(value))}, segment)


def running_value_counts(
    df, keys: Sequence[str], value: str, order: Sequence[str], segment: Column | None = None
) -> DataFrame:
    """Every row with the count of its (key, value) so far: the map entry it changed."""
    return running(df, [*keys, value], order, {"cnt": running_count()}, segment)


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Final count per (key, value)."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt"))


def value_count_map(df: DataFrame, keys: Sequence[str], value: str, name: str = "counts") -> DataFrame:
    """Final map value -> count per key. A map is as large as the key has distinct values;
    where that is not small, use ``value_counts``."""
    entries = F.array_sort(F.collect_list(F.struct(value, "cnt")))
    return value_counts(df, keys, value).groupBy(*keys).agg(F.map_from_entries(entries).alias(name))


def value_count_parts(df: DataFrame, keys: Sequence[str], value: str, size: int = 1000, name: str = "counts") -> DataFrame:
    """The same map in numbered parts of ``size`` entries at most, in the order of values, so that a key may have any number.

    A null value is not in it.
    """
    counted = value_counts(df.where(F.col(value).isNotNull()), keys, value)
    numbered = running(counted, keys, [value], {"__no": running_count()})
    part = F.floor((F.col("__no") - 1) / size).alias("part")
    entries = F.array_sort(F.collect_list(F.struct(value, "cnt")))
    return numbered.groupBy(*keys, part).agg(F.map_from_entries(entries).alias(name))


def top_n_per_key(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], n: int = 3) -> DataFrame:
    """The ``n`` highest rows per key. Spark keeps n rows per key and task before the exchange."""
    order = check_order(df, order)
    best = Window.partitionBy(*keys).orderBy(F.col(value).desc(), *order)
    return df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def _insert(df: DataFrame, spec, value: Column, names: list[str]) -> DataFrame:
    """Add the running highest values of ``value`` in the order of ``spec``, one per name.

    The first place holds the running maximum. Whatever a row displaces from a place,
    the smaller of the new value and the one held, competes for the next place.
    """
    before = spec.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("__in", value)
    for name in names:
        df = df.withColumn("__held", F.max("__in").over(before))
        displaced = F.when(F.col("__held").isNotNull() & F.col("__in").isNotNull(), F.least("__held", "__in"))
        df = df.withColumns({name: F.greatest("__held", "__in"), "__in": displaced})
    return df.drop("__in", "__held")


def running_top_n(
    df, keys: Sequence[str], value: str, order: Sequence[str], n: int = 3, segment: Column | None = None
) -> DataFrame:
    """Every row with the key's ``n`` highest values so far, highest first, in ``top``.

    Segmented like ``scan.running``: the n highest of all earlier segments enter a
    segment as n seed rows.
    """
    keys, order = list(keys), check_order(df, order)
    names = [f"__top{i}" for i in range(n)]
    segmented, cut = with_segment(df, keys, order, segment)
    within = Window.partitionBy(*keys, "__segment").orderBy("__row", *order)
    if cut is None:
        folded = _insert(segmented.withColumn("__row", F.lit(True)), within, F.col(value), names)
        return folded.select(*df.columns, F.array_compact(F.array(*names)).alias("top"))
    rows = segmented.select(*df.columns, "__segment", cut.alias("__cut"), F.col(value).alias("__value"))

    # Equal values are counted together first; n copies of one are enough. Nulls sort
    # last, and keep a segment without values in the sequence.
    strongest = Window.partitionBy(*keys, "__segment").orderBy(F.col("__value").desc())
    counted = rows.where("__cut").groupBy(*keys, "__segment", "__value").agg(F.least(F.count(F.lit(1)), F.lit(n)).alias("__n"))
    copies = counted.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n"))))
    partials = copies.select(*keys, "__segment", "__value", F.row_number().over(strongest).alias("__r"))
    partials = partials.where(F.col("__r") <= n)
    along = Window.partitionBy(*keys).orderBy("__segment", "__r")
    prefix = _insert(partials, along, F.col("__value"), names)
    before = [F.lag(name).over(along).alias(name) for name in names]
    seeds = (
        prefix.select(*keys, "__segment", "__r", *before)
        .where(F.col("__r") == 1)
        .select(*keys, "__segment", F.explode(F.array(*names)).alias("__value"))
        .where(F.col("__value").isNotNull())
    )

    both = rows.drop("__cut").withColumn("__row", F.lit(True)).unionByName(
        seeds.withColumn("__row", F.lit(False)), allowMissingColumns=True
    )
    folded = _insert(both, within, F.col("__value"), names).where("__row")
    return folded.select(*df.columns, F.array_compact(F.array(*names)).alias("top"))


def ttl_last_value(
    df,
    keys: Sequence[str],
    value: str,
    time: str,
    order: Sequence[str],
    ttl: float = 5,
    segment: Column | None = None,
) -> DataFrame:
    """Every row with the value state held before it, null once older than ``ttl`` seconds.

    The clock is ``time``; a write refreshes the state.
    """
    folds = {"__value": previous(F.col(value)), "__time": previous(F.col(time))}
    seen = running(df, keys, order, folds, segment)
    alive = F.col(time) < _later(df, "__time", time, ttl)
    return seen.withColumn("last_vc", F.when(alive, F.col("__value"))).drop("__value", "__time")


def _later(df: DataFrame, column: str, like: str, span: float) -> Column:
    """``column`` plus ``span`` seconds, in the type of column ``like``."""
    if "timestamp" in df.schema[like].dataType.simpleString():
        return F.col(column) + seconds(span)
    return F.col(column) + F.lit(span)


def ttl_read_refresh(
    df,
    keys: Sequence[str],
    value: str,
    time: str,
    order: Sequence[str],
    write_when: Column,
    ttl: float = 5,
    segment: Column | None = None,
) -> DataFrame:
    """As ``ttl_last_value``, but every row's read refreshes the state too and only rows
    meeting ``write_when`` write it.

    The state lives as long as no gap between two rows of the key reaches ``ttl``.
    """
    gaps = running(df, keys, order, {"__last": previous(F.col(time))}, segment)
    broke = F.col(time) >= _later(df, "__last", time, ttl)
    gaps = gaps.withColumn("__broke", F.when(broke, F.col(time)))
    written = F.when(write_when, F.struct(F.col(value).alias("value"), F.col(time).alias("time")))
    folds = {
        "__chain": running_max(F.col("__broke")),
        "__write": last_known(written).excluding_current(),
    }
    seen = running(gaps, keys, order, folds, segment)
    alive = F.col("__chain").isNull() | (F.col("__write")["time"] >= F.col("__chain"))
    return seen.withColumn("last_vc", F.when(alive, F.col("__write")["value"])).select(*df.columns, "last_vc")


def partition_running_count(
    df, partition: Sequence[str], order: Sequence[str], segment: Column | None = None
) -> DataFrame:
    """Every row with the number of rows its source partition has delivered so far."""
    return running(df, partition, order, {"cnt": running_count()}, segment)


def event_timer(
    df, keys: Sequence[str], time: str, order: Sequence[str], at: Column, delay: float = 0
) -> DataFrame:
    """The keys whose timer at the fixed event time ``at`` fires, with the arrival (``order[0]``) of their first row.

    Every row registers its key's timer. The watermark is the highest event time so far less ``delay`` seconds and 1 ms;
    a timer fires with the first advance of the watermark, after its registration, that reaches ``at``. Keys first seen
    after the last advance don't fire, nor do any if the last one doesn't reach ``at``.
    """
    order = check_order(df, order)
    place = F.struct(*order)
    # The last advance is the first row that holds the highest event time: one row per event time, then the highest.
    advances = df.where(F.col(time).isNotNull()).groupBy(time).agg(F.min(place).alias("__place"))
    last = advances.agg(F.max(F.struct(F.col(time).alias("__max"), "__place")).alias("l"))
    reached = last.select((_later(df, "l.__max", time, -(delay + 0.001)) >= at)).scalar()
    first = df.groupBy(*keys).agg(F.min(place).alias("__first"))
    fired = first.where(reached & (F.col("__first") <= last.select("l.__place").scalar()))
    return fired.select(*keys, F.col("__first")[order[0]].alias("registered"))
