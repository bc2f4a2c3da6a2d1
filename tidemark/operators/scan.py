"""Running folds in a total order, split into segments.

``Window.partitionBy(key)`` sorts a whole key in one task, so one key holding a
third of the rows is one task holding a third of the rows. Here a key is cut into
segments along its order. Each segment is folded on its own; the fold of all
earlier segments of the same key enters it as one *seed* row that sorts before
the segment's rows. Only one small row per (key, segment) is ever ordered per key.

Plan: scan -> partial aggregate per (key, segment) -> window over those few rows
-> union with the scan -> one exchange on (key, segment) -> one sort and window.
Only keys with more rows than a task should sort are cut; a count per key finds them
when the plan is made, and where there are none the plan is a plain window. The other
keys are a segment each and have no partials. Without keys the same plan gives prefix
folds over the whole table; there the segments are folded in two levels, so that no
task sees all of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.time import epoch_seconds

# A segment of a unique integer order holds at most this many rows, as does a key that is not cut.
SEGMENT_ROWS = 1 << 20

# Keys that are cut are broadcast up to this many and so many bytes of them; more are joined.
MOST_CUT = 10_000
MOST_CUT_BYTES = 1 << 24
MOST_SPLITTERS = 1 << 22

# Without keys, so many segments are folded together before all of those are.
_GROUP_BITS = 10

_SEG, _ROW = "__segment", "__row"


@dataclass(frozen=True)
class Fold:
    """One running value. ``before`` leaves the current row out of it."""

    kind: str
    value: Column
    before: bool = False

    def excluding_current(self) -> Fold:
        return replace(self, before=True)


def running_sum(value: Column) -> Fold:
    return Fold("sum", value)


def running_count() -> Fold:
    return Fold("sum", F.lit(1).cast("bigint"))


def running_min(value: Column) -> Fold:
    return Fold("min", value)


def running_max(value: Column) -> Fold:
    return Fold("max", value)


def first_value(value: Column) -> Fold:
    """Value of the first row, null or not."""
    return Fold("first", value)


def last_value(value: Column) -> Fold:
    """Value of the newest row, null or not."""
    return Fold("last", value)


def last_known(value: Column) -> Fold:
    """Newest non-null value."""
    return Fold("last_known", value)


def previous(value: Column) -> Fold:
    """Value of the row just before this one."""
    return last_value(value).excluding_current()


def check_order(df: DataFrame, order: Sequence[str]) -> list[str]:
    if isinstance(order, str):
        order = [order]
    order = list(order)
    if not order:
        raise ValueError("this operator depends on arrival order: name the order columns")
    missing = [c for c in order if c not in df.columns]
    if missing:
        raise ValueError(f"order columns not in the input: {missing}")
    return order


def segment_of(df: DataFrame, column: str, rows: int = SEGMENT_ROWS) -> Column:
    """The default segment number; it never decreases along ``column``.

    Integers are cut every ``rows`` values and dates per day. Timestamps are cut by
    ``balanced_segment``.
    """
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.IntegralType):
        return F.floor(c / F.lit(rows)) if rows & (rows - 1) else F.shiftright(c.cast("bigint"), rows.bit_length() - 1)
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return balanced_segment(df, column)
    raise ValueError(f"give a segment column for an order of type {kind.simpleString()}")


def balanced_segment(df: DataFrame, column: str, rows: int = 4 * SEGMENT_ROWS) -> Column:
    """Segments of equal width in time (or integer value) with ``rows`` rows on average.

    Reads ``column`` once more, for its count and range, when the query runs. Use it also
    for sparse integer orders, where a fixed width would make too many segments.
    """
    place = epoch_seconds(df, column)
    stats = df.agg(F.count(place).alias("n"), F.min(place).alias("low"), F.max(place).alias("high"))
    width = F.greatest(F.lit(1), F.floor((F.col("high") - F.col("low") + 1) * rows / F.col("n")))
    cut = stats.select(F.struct("low", width.alias("width"))).scalar()
    return F.coalesce(F.floor((place - cut["low"]) / cut["width"]), F.lit(0).cast("bigint"))


def with_segment(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Column | None, name: str = _SEG
) -> tuple[DataFrame, Column | None]:
    """``df`` with its segment number, and the condition under which a row's key was cut (None: no key is).

    By default only keys with more than ``SEGMENT_ROWS`` rows are cut, at quantiles of the whole order. They are counted
    here and now, and a sketch finds the quantiles; the driver gets no more than ``MOST_CUT`` keys with ``MOST_SPLITTERS``
    quantiles in all (beyond, ``segment_of`` cuts). A ``segment`` given by the caller cuts every key.
    """
    if segment is not None or not keys:
        segment = segment_of(df, order[0]) if segment is None else segment
        return df.withColumn(name, segment), F.lit(True)
    counts = df.groupBy(*(F.col(k).alias(f"__cut_{i}") for i, k in enumerate(keys))).agg(F.count(F.lit(1)).alias("__n"))
    cut = counts.where(F.col("__n") > SEGMENT_ROWS)
    found = cut.limit(MOST_CUT + 1).collect()
    if not found:
        return df.withColumn(name, F.lit(0).cast("bigint")), None
    same = [F.col(k).eqNullSafe(F.col(f"__cut_{i}")) for i, k in enumerate(keys)]
    own, where = df, None
    if len(found) <= MOST_CUT and sum(len(str(tuple(r))) for r in found) <= MOST_CUT_BYTES:
        cut = F.broadcast(df.sparkSession.createDataFrame(found, cut.schema))
        own, where, cut = _splitters(df, order, same, cut, found)
    if where is None:
        own, where = df, segment_of(df, order[0])
    cut = cut.drop("__n").withColumn("__cut", F.lit(True))
    marked = own.join(cut, same, "left")
    marked = marked.withColumn(name, F.when(F.col("__cut"), where).otherwise(F.lit(0).cast("bigint")))
    return marked.select(*df.columns, name, "__cut"), F.coalesce(F.col("__cut"), F.lit(False))


def _place_code(df: DataFrame, order: Sequence[str], hot: DataFrame) -> Column | None:
    """A number that never decreases along the order: of all its columns, or of as many as 62 bits hold; nulls are first."""
    columns = []
    for c in order:
        kind = df.schema[c].dataType
        if isinstance(kind, T.IntegralType):
            columns.append(F.col(c).cast("bigint"))
        elif isinstance(kind, T.DateType):
            columns.append(F.unix_date(c).cast("bigint"))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            columns.append(F.unix_micros(F.col(c).cast("timestamp")))
        else:
            break
    if not columns:
        return None
    ends = hot.agg(*(f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("low", F.min), ("high", F.max)))).first()
    code, reach = None, 1
    for i, c in enumerate(columns):
        low, high = ends[f"low{i}"], ends[f"high{i}"]
        width = 1 if low is None else high - low + 2
        if reach * width >= 1 << 62:
            break
        step = F.coalesce(c - F.lit(low).cast("bigint") + 1, F.lit(0).cast("bigint")) if low is not None else F.lit(0).cast("bigint")
        code, reach = step if code is None else code * F.lit(width).cast("bigint") + step, reach * width
    return code


def _splitters(df: DataFrame, order: Sequence[str], same: list[Column], cut: DataFrame, found: list) -> tuple[DataFrame, Column | None, DataFrame]:
    """Where the keys of ``cut`` are split: ``df`` with a number for its order, the segment of a row, and ``cut`` with the splitters.

    The splitters of a key are quantiles, by Spark's mergeable sketch, of the rows' numbers, so that neither ties in the
    first column of the order nor a burst in time gather in one segment. A row finds its segment in two steps of about
    the square root of the splitters each.
    """
    most = max(r["__n"] for r in found)
    parts = -(-most // SEGMENT_ROWS)
    if parts * len(found) > MOST_SPLITTERS:
        return df, None, cut
    hot = df.join(cut, same)
    code = _place_code(df, order, hot)
    if code is None:
        return df, None, cut
    names = [c for c in cut.columns if c != "__n"]
    quantiles = F.percentile_approx(code, [k / parts for k in range(1, parts)], max(10_000, 8 * parts))
    sketched = hot.groupBy(*names, "__n").agg(quantiles.alias("__q"))
    rows = []
    for r in sketched.collect():
        own = -(-r["__n"] // SEGMENT_ROWS)
        picked = {r["__q"][min(len(r["__q"]) - 1, k * parts // own - 1)] for k in range(1, own)}
        points = sorted(picked)
        group = max(1, isqrt(len(points)))
        rows.append((*(r[c] for c in names), r["__n"], points, points[group - 1 :: group], group))
    schema = T.StructType(
        [*cut.schema.fields, T.StructField("__points", T.ArrayType(T.LongType())), T.StructField("__tops", T.ArrayType(T.LongType())), T.StructField("__group", T.IntegerType())]
    )
    split = F.broadcast(df.sparkSession.createDataFrame(rows, schema))
    place = F.col("__code")
    passed = F.size(F.filter("__tops", lambda p: p < place))
    within = F.slice("__points", passed * F.col("__group") + 1, F.col("__group"))
    where = (passed * F.col("__group") + F.size(F.filter(within, lambda p: p < place))).cast("bigint")
    return df.withColumn("__code", code), where, split


def _combine(fold: Fold, column: Column) -> Column:
    """The aggregate that folds lifted values (or partial folds) given in order."""
    if fold.kind == "last_known":
        return F.last(column, ignorenulls=True)
    return {"sum": F.sum, "min": F.min, "max": F.max, "first": F.first, "last": F.last}[fold.kind](column)


def _partial(fold: Fold, column: Column, order: Column) -> Column:
    """The same fold as an unordered aggregate, for the per-segment partials."""
    if fold.kind == "first":
        return F.min_by(column, order)
    if fold.kind == "last":
        return F.max_by(column, order)
    if fold.kind == "last_known":
        return F.max_by(column, F.when(column.isNotNull(), order))
    return _combine(fold, column)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: Mapping[str, Fold],
    segment: Column | None = None,
    keep_segment: str | None = None,
    nullable_order: bool = False,
) -> DataFrame:
    """``df`` with one more column per fold, the fold of the key's rows so far.

    ``order`` must be a total order within a key. ``segment`` may replace the
    default cut; it must never decrease along ``order`` and should hold no more
    rows of one key than a task can sort. ``keep_segment`` names an output column
    for it, and adds a constant column ``<name>_row``: the result is partitioned by
    (keys, segment) and sorted by those, ``<name>_row`` and ``order``, so further
    windows and groupings along them need neither an exchange nor a sort. ``nullable_order``
    lets rows without an order come first.
    """
    if df.isStreaming:
        raise ValueError("running folds take a batch; streams use tidemark.streaming")
    keys, order = list(keys), check_order(df, order)
    segmented, cut = with_segment(df, keys, order, segment)

    lifted_names = {name: f"__fold_{i}" for i, name in enumerate(folds)}
    lifted = segmented.select(
        *df.columns,
        _SEG,
        (F.lit(False) if cut is None else cut).alias("__cut"),
        *(fold.value.alias(lifted_names[name]) for name, fold in folds.items()),
    )

    if cut is None:
        return _folded(df, keys, order, folds, lifted_names, lifted.drop("__cut").withColumn(_ROW, F.lit(True)), keep_segment)

    # A single order column of a plain type keeps the partials in hash aggregation.
    order_key = F.col(order[0]) if len(order) == 1 and not nullable_order else F.struct(*order)
    partials = lifted.where("__cut").groupBy(*keys, _SEG).agg(
        *(_partial(f, F.col(lifted_names[n]), order_key).alias(lifted_names[n]) for n, f in folds.items())
    )
    lifted = lifted.drop("__cut")

    def before(rows: DataFrame, within: Sequence[str], along: Sequence[str]) -> DataFrame:
        """The fold of the rows ahead of each row, and the number of those."""
        earlier = Window.partitionBy(*within).orderBy(*along).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select(
            *(c for c in rows.columns if c not in lifted_names.values()),
            *(_combine(f, F.col(lifted_names[n])).over(earlier).alias(lifted_names[n]) for n, f in folds.items()),
            F.count(F.lit(1)).over(earlier).alias("__earlier"),
        )

    if not keys and isinstance(segmented.schema[_SEG].dataType, T.IntegralType):
        grouped = partials.withColumn("__group", F.shiftright(F.col(_SEG).cast("bigint"), _GROUP_BITS))
        tops = grouped.groupBy("__group").agg(
            *(_partial(f, F.col(lifted_names[n]), F.col(_SEG)).alias(lifted_names[n]) for n, f in folds.items())
        )
        first = before(tops, [], ["__group"]).where(F.col("__earlier") > 0).drop("__earlier")
        stacked = grouped.withColumn(_ROW, F.lit(True)).unionByName(first.withColumn(_ROW, F.lit(False)), allowMissingColumns=True)
        seeds = before(stacked, ["__group"], [_ROW, _SEG]).where(_ROW).drop("__group", _ROW)
    else:
        seeds = before(partials, keys, [_SEG])
    seeds = seeds.where(F.col("__earlier") > 0)

    both = lifted.withColumn(_ROW, F.lit(True)).unionByName(
        seeds.drop("__earlier").withColumn(_ROW, F.lit(False)), allowMissingColumns=True
    )
    return _folded(df, keys, order, folds, lifted_names, both, keep_segment)


def _folded(df, keys, order, folds: Mapping[str, Fold], lifted_names, both: DataFrame, keep_segment: str | None) -> DataFrame:
    """The folds of each segment's rows, which a seed row may precede."""
    within = Window.partitionBy(*keys, _SEG).orderBy(_ROW, *order)
    inclusive = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exclusive = within.rowsBetween(Window.unboundedPreceding, -1)

    kept = [c for c in df.columns if c not in folds]
    carried = [_SEG] if keep_segment else []
    markers = [F.col(_SEG).alias(keep_segment), F.col(_ROW).alias(f"{keep_segment}_row")] if keep_segment else []
    folded = both.select(
        *kept, *carried, _ROW, *(
            _combine(f, F.col(lifted_names[n])).over(exclusive if f.before else inclusive).alias(lifted_names[n])
            for n, f in folds.items()
        ),
    ).where(F.col(_ROW))

    return folded.select(
        *kept,
        *markers,
        *(F.col(lifted_names[n]).alias(n) for n in folds),
    )
