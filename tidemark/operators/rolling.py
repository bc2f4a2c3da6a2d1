"""Keyed aggregates: one output row per input row (rolling) or per key (final)."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.scan import (
    Fold,
    check_order,
    first_value,
    running,
    running_count,
    running_max,
    running_min,
    running_sum,
)


def group_sum(df: DataFrame, keys: Sequence[str], value: Column, name: str = "total") -> DataFrame:
    """Final sum per key."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def word_count(words: DataFrame, word: str = "word") -> DataFrame:
    """Final count per word."""
    return words.groupBy(word).agg(F.count(F.lit(1)).alias("cnt"))


def running_word_count(
    words: DataFrame, order: Sequence[str], word: str = "word", segment: Column | None = None
) -> DataFrame:
    """Each word occurrence with the count of the word so far."""
    return running(words, [word], order, {"cnt": running_count()}, segment)


def _others(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> list[str]:
    return [c for c in df.columns if c not in keys and c not in order and c != value]


def _rolling(df: DataFrame, keys, value: str, order, fold: Fold, segment) -> DataFrame:
    order = check_order(df, order)
    folds = {c: first_value(F.col(c)) for c in _others(df, keys, order, value)}
    return running(df, keys, order, {**folds, value: fold}, segment).select(*df.columns)


def rolling_sum(df, keys: Sequence[str], value: str, order: Sequence[str], segment: Column | None = None) -> DataFrame:
    """Running sum; the other fields keep the values of the key's first row.

    Key and order columns stay those of the current row, here and below.
    """
    return _rolling(df, keys, value, order, running_sum(F.col(value)), segment)


def rolling_min(df, keys: Sequence[str], value: str, order: Sequence[str], segment: Column | None = None) -> DataFrame:
    """Running minimum; the other fields keep the values of the key's first row."""
    return _rolling(df, keys, value, order, running_min(F.col(value)), segment)


def rolling_max(df, keys: Sequence[str], value: str, order: Sequence[str], segment: Column | None = None) -> DataFrame:
    """Running maximum; the other fields keep the values of the key's first row."""
    return _rolling(df, keys, value, order, running_max(F.col(value)), segment)


def _descending(df: DataFrame, column: str) -> Column:
    """A value that falls as ``column`` rises, for use inside a struct."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.IntegralType):
        return F.bitwise_not(c)  # the smallest integer has no negative
    if isinstance(kind, T.NumericType):
        return -c
    if isinstance(kind, T.DateType):
        return -F.unix_date(c)
    if isinstance(kind, T.TimestampType):
        return -F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return -(c - F.lit("1970-01-01").cast("timestamp_ntz"))
    raise ValueError(f"column {column} must be a number, date or timestamp")


def _rolling_row(df, keys, value, order, segment, largest: bool) -> DataFrame:
    order = check_order(df, order)
    rest = [c for c in df.columns if c not in keys and c not in order and c != value]
    # Ties go to the earliest row: it must be the largest (or smallest) struct.
    place = [_descending(df, c) if largest else F.col(c) for c in order]
    row = F.struct(
        F.col(value).alias("value"),
        *(p.alias(f"place{i}") for i, p in enumerate(place)),
        *(F.col(c).alias(f"rest{i}") for i, c in enumerate(rest)),
    )
    # A row without a value is no candidate.
    row = F.when(F.col(value).isNotNull(), row)
    best = running(df, keys, order, {"__best": Fold("max" if largest else "min", row)}, segment)
    picked = {value: F.col("__best")["value"]}
    picked |= {c: F.col("__best")[f"rest{i}"] for i, c in enumerate(rest)}
    return best.select(*(picked[c].alias(c) if c in picked else F.col(c) for c in df.columns))


def rolling_max_by(df, keys: Sequence[str], value: str, order: Sequence[str], segment: Column | None = None):
    """The whole row holding the running maximum; the earliest row wins a tie."""
    return _rolling_row(df, keys, value, order, segment, largest=True)


def rolling_min_by(df, keys: Sequence[str], value: str, order: Sequence[str], segment: Column | None = None):
    """The whole row holding the running minimum; the earliest row wins a tie."""
    return _rolling_row(df, keys, value, order, segment, largest=False)


def rolling_reduce(df, keys: Sequence[str], value: str, order: Sequence[str], segment: Column | None = None):
    """Running sum of ``value``; every other field is that of the newest row."""
    return running(df, keys, order, {value: running_sum(F.col(value))}, segment).select(*df.columns)


def running_avg(
    df, keys: Sequence[str], value: str, order: Sequence[str], name: str = "avg", segment: Column | None = None
) -> DataFrame:
    """Running mean as a double."""
    present = F.col(value).isNotNull().cast("bigint")
    folds = {"__sum": running_sum(F.col(value)), "__n": running_sum(present)}
    both = running(df, keys, order, folds, segment)
    mean = F.when(F.col("__n") > 0, F.col("__sum").cast("double") / F.col("__n"))
    return both.withColumn(name, mean).drop("__sum", "__n")


def group_aggregate(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """The final value of every rolling aggregate, one row per key.

    ``first_max`` and ``first_min`` are the order values of the earliest row that
    holds the extreme.
    """
    order = check_order(df, order)
    v = F.col(value)
    place = F.struct(*order)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum(v).alias("total"),
        F.min(v).alias("smallest"),
        F.max(v).alias("largest"),
        F.avg(v).alias("mean"),
        # A row without a value holds no extreme: its place in the order is null and passed over.
        F.min_by(place, F.when(v.isNotNull(), F.struct(_descending(df, value).alias("v"), *order)))[order[0]].alias("first_max"),
        F.min_by(place, F.when(v.isNotNull(), F.struct(v.alias("v"), *order)))[order[0]].alias("first_min"),
    )


_NAN = float("nan")
# A key with so many rows among those gathered is folded where they are.
_MANY = 32


def _same(value: Any) -> Any:
    """``value``, with one object for all NaNs: as a key it then equals itself."""
    return _NAN if isinstance(value, float) and value != value else value


def custom_fold(
    df: DataFrame,
    keys: Sequence[str],
    create: Callable[[], Any],
    add: Callable[[Any, pd.DataFrame], Any],
    merge: Callable[[Any, Any], Any],
    result: Callable[[Any], Any],
    result_type: str,
    name: str = "result",
    fan_in: int = 64,
    max_held: int = 20_000,
    carried: DataFrame | None = None,
) -> DataFrame:
    """A user-written aggregate: create, add a batch, merge two accumulators, result.

    Where a key has many rows close together, its accumulators are built next to the data (a task holds at most about
    ``max_held`` and then hands them on); the rows of other keys meet by key first, so that ``add`` is called about once
    for each and not once for each row. Accumulators are merged in ``fan_in`` groups per key, and only then per key, so no
    task sees all rows or all partial accumulators of a hot key. ``add`` and ``merge`` must be associative and may not
    depend on row order. ``carried`` (the keys and ``accumulator``) joins in accumulators of other rows; ``accumulators``
    makes such.
    """
    keys = list(keys)
    key_fields = [df.schema[k] for k in keys]
    state = T.StructType([*key_fields, T.StructField("__acc", T.BinaryType())])
    final = T.StructType([*key_fields, *T._parse_datatype_string(f"`{name}` {result_type}").fields])
    mixed = T.StructType([*(T.StructField(f.name, f.dataType) for f in df.schema.fields), state["__acc"]])
    state_arrow, final_arrow = to_arrow_schema(state), to_arrow_schema(final)
    columns = df.columns

    def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows], schema=schema)

    def gathered_rows(batches: Iterator[pa.RecordBatch], enough: int = 100_000) -> Iterator[pa.Table]:
        """Several batches at a time, so that ``add`` is called with more rows and less often."""
        some: list[pa.RecordBatch] = []
        for batch in batches:
            some.append(batch)
            if sum(b.num_rows for b in some) >= enough:
                yield pa.Table.from_batches(some)
                some = []
        if some:
            yield pa.Table.from_batches(some)

    def keys_of(rows: pa.Table) -> list[tuple]:
        """As Python values: pandas would turn integers beside nulls into floats."""
        return [tuple(map(_same, key)) for key in zip(*(rows.column(k).to_pylist() for k in keys))]

    def grouped(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """The places of the rows, group by group, and the groups' sizes."""
        group = np.zeros(rows.num_rows, dtype=np.int64)
        for k in keys:
            codes = rows.column(k).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            # Numbered anew for each column, so that the products stay small.
            group = np.unique(group * (codes.max(initial=0) + 1) + codes, return_inverse=True)[1]
        return np.argsort(group, kind="stable"), np.bincount(group)

    def add_groups(held: dict[tuple, Any], rows: pa.Table, sizes: np.ndarray) -> None:
        """Add ``rows``, which lie group by group, to the accumulators of their keys."""
        if not rows.num_rows:
            return
        ends = np.cumsum(sizes)
        starts = ends - sizes
        # Several groups may be one key, as those of 0.0 and -0.0.
        number, frame = keys_of(rows.select(keys).take(pa.array(starts))), rows.to_pandas()
        for key, start, end in zip(number, starts, ends):
            held[key] = add(held[key] if key in held else create(), frame.iloc[start:end])

    def dumped(held: dict[tuple, Any], emptied: pa.Schema | None = None) -> pa.RecordBatch:
        batch = batch_of([(*key, pickle.dumps(acc)) for key, acc in held.items()], state_arrow)
        held.clear()
        if emptied is None:
            return batch
        found = {n: batch.column(i) for i, n in enumerate(state_arrow.names)}
        arrays = [found[f.name].cast(f.type) if f.name in found else pa.nulls(batch.num_rows, f.type) for f in emptied]
        return pa.RecordBatch.from_arrays(arrays, schema=emptied)

    def add_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The accumulators of the keys with many rows; the rows of the others, as they are."""
        held: dict[tuple, Any] = {}
        out = None
        for rows in gathered_rows(batches):
            out = pa.schema([*(pa.field(f.name, f.type) for f in rows.schema), pa.field("__acc", pa.binary())])
            order, sizes = grouped(rows)
            many = sizes >= _MANY
            often = np.repeat(many, sizes)
            add_groups(held, rows.take(pa.array(order[often])), sizes[many])
            if not often.all():
                rest = rows.take(pa.array(order[~often]))
                rest = pa.Table.from_arrays([*rest.columns, pa.chunked_array([pa.nulls(rest.num_rows, pa.binary())])], schema=out)
                yield from rest.to_batches(max_chunksize=10_000)
            if len(held) >= max_held:
                yield dumped(held, out)
        if held:
            yield dumped(held, out)

    def add_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """An accumulator per key, of rows and accumulators that are sorted by key: one that goes on is held."""
        held: dict[tuple, Any] = {}
        for some in gathered_rows(batches):
            done = some.column("__acc").is_valid()
            rows = some.filter(pc.invert(done)).select(columns)
            order, sizes = grouped(rows)
            add_groups(held, rows.take(pa.array(order)), sizes)
            ready = some.filter(done)
            for key, blob in zip(keys_of(ready), ready.column("__acc").to_pylist()):
                held[key] = merge(held[key] if key in held else create(), pickle.loads(blob))
            (last,) = keys_of(some.slice(some.num_rows - 1))
            rest = {last: held.pop(last)}
            if held:
                yield dumped(held)
            held = rest
        if held:
            yield dumped(held)

    def merge_sorted(schema: pa.Schema, finish: Callable[[Any], Any]):
        """Merge runs of equal keys; the input is sorted, so one accumulator is held at a time."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, acc, done = None, None, []
            for batch in batches:
                *key_columns, blobs = (batch.column(batch.schema.get_field_index(c)) for c in state_arrow.names)
                for key, blob in zip(zip(*(map(_same, c.to_pylist()) for c in key_columns)), blobs.to_pylist()):
                    if key != at:
                        if at is not None:
                            done.append((*at, finish(acc)))
                        at, acc = key, create()
                    acc = merge(acc, pickle.loads(blob))
                if len(done) >= 10_000:
                    yield batch_of(done, schema)
                    done = []
            if at is not None:
                yield batch_of([*done, (*at, finish(acc))], schema)

        return run

    partials = df.mapInArrow(add_batches, mixed)
    # Rows of a key meet; accumulators are salted by input task, so that those of one key spread over the groups.
    salt = F.when(F.col("__acc").isNull(), F.lit(0)).otherwise(F.pmod(F.spark_partition_id(), F.lit(fan_in)))
    salted = partials.withColumn("__salt", salt)
    salted = salted.repartition(*keys, "__salt").sortWithinPartitions(*keys).select(*mixed.names)
    fewer = salted.mapInArrow(add_sorted, state)
    if carried is not None:
        fewer = fewer.unionByName(carried.select(*keys, F.col("accumulator").alias("__acc")))
    gathered = fewer.repartition(*keys).sortWithinPartitions(*keys)
    return gathered.mapInArrow(merge_sorted(final_arrow, result), final)


def accumulators(df: DataFrame, keys: Sequence[str], create, add, merge, carried: DataFrame | None = None) -> DataFrame:
    """The keys of ``custom_fold`` with their ``accumulator``, pickled, instead of its result."""
    return custom_fold(df, keys, create, add, merge, pickle.dumps, "binary", "accumulator", carried=carried)


def results(accumulated: DataFrame, keys: Sequence[str], result: Callable[[Any], Any], result_type: str, name: str = "result") -> DataFrame:
    """What ``accumulators`` come to."""
    keys = list(keys)
    schema = T.StructType([*(accumulated.schema[k] for k in keys), *T._parse_datatype_string(f"`{name}` {result_type}").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [result(pickle.loads(blob)) for blob in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(found, arrow.field(name).type)], schema=arrow)

    return accumulated.select(*keys, "accumulator").mapInArrow(run, schema)
