"""Running folds of streams, a micro-batch at a time in Spark functions.

A micro-batch is folded as a batch is (``operators.scan``: hot keys cut into segments). What a key has folded so far comes
in as a row ahead of the key's own, from a table with one row per key, and goes out to it. No Python sees a row.

Rows may also be held back until the highest event time has passed theirs by a delay, and are then folded in the order of
time: results follow the order of events, not that of arrival, for all rows that are no later than the delay.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators import scan, state
from tidemark.operators.lateness import shifted
from tidemark.operators.scan import Fold, check_order, running
from tidemark.sources.keyed_table import KeyedTable
from tidemark.streaming.restore import last_batch
from tidemark.streaming.runs import _drop, _put, drain

_SEED = "__carried"


@dataclass(frozen=True)
class HoldBack:
    """Rows wait until the highest event time is ``delay`` seconds past theirs, or past their ``due`` time."""

    time: str
    delay: float
    due: str | None = None


def _reader(batch: DataFrame, schema: T.StructType, path: str) -> DataFrame:
    return batch.sparkSession.read.schema(schema).parquet(path)


def released(batch: DataFrame, batch_id: int, hold: HoldBack, out: str) -> DataFrame:
    """The rows of this and earlier micro-batches whose time has come, each once.

    Kept per batch below ``out``: ``held`` (rows that wait), ``clock`` (the highest time), ``late`` (rows that came when
    rows of their time had been released). A repeated batch reads and writes the same; rows without a time are late.
    """
    clock = T.StructType([T.StructField("high", batch.schema[hold.time].dataType)])
    due, newest = F.col(hold.due or hold.time), F.max(hold.time)
    late, held = due.isNull(), None
    if batch_id:
        high = _reader(batch, clock, f"{out}/clock/{batch_id - 1}").scalar()
        late = late | F.coalesce(due <= shifted(batch, high, hold.time, -hold.delay), F.lit(False))
        newest = F.greatest(newest, high)
        held = _reader(batch, batch.schema, f"{out}/held/{batch_id - 1}")
    _put(batch.where(late), f"{out}/late/batch={batch_id}")
    _put(batch.agg(newest.alias("high")), f"{out}/clock/{batch_id}")
    pool = batch.where(~late) if held is None else batch.where(~late).unionByName(held)
    mark = shifted(batch, _reader(batch, clock, f"{out}/clock/{batch_id}").scalar(), hold.time, -hold.delay)
    _put(pool.where(F.coalesce(due > mark, F.lit(True))), f"{out}/held/{batch_id}")
    return pool.where(due <= mark)


class _Run:
    """What is done with each micro-batch: rows ready, those carried in, results and those carried out."""

    def __init__(self, df: DataFrame, keys, order, out: str, hold: HoldBack | None, every: int):
        self.df, self.keys, self.out, self.hold, self.every = df, list(keys), out, hold, every
        self.order = check_order(df, order)
        if hold:
            self.order = [hold.time, *(c for c in self.order if c != hold.time)]

    def begun(self, batch: DataFrame) -> DataFrame | None:
        """What the first micro-batch is ahead of: nothing."""

    def writer(self, checkpoint: str) -> DataStreamWriter:
        return self.df.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint)

    def take(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            rows = batch
            if self.hold:
                _put(released(batch, batch_id, self.hold, self.out), f"{self.out}/ready/{batch_id}")
                rows = _reader(batch, batch.schema, f"{self.out}/ready/{batch_id}")
            table = KeyedTable(spark, f"{self.out}/state", self.keys, self.state_schema(batch), self.every)
            table.begin(batch_id)
            carried = table.read(batch_id, rows.select(*self.keys)) if batch_id else self.begun(batch)
            both = self.stacked(rows, carried).persist()
            try:
                _put(self.results(both), f"{self.out}/rows/batch={batch_id}")
                table.write(batch_id, self.carried(both))
            finally:
                both.unpersist()
            for kind in ("clock", "held", "ready"):
                _drop(spark, f"{self.out}/{kind}/{batch_id - 2}")
        finally:
            batch.unpersist()


class _Folds(_Run):
    def __init__(self, df, keys, order, folds: Mapping[str, Fold], out, hold, every, after, segment, initial=None):
        super().__init__(df, keys, order, out, hold, every)
        self.folds, self.after, self.segment, self.initial = dict(folds), after, segment, initial
        self.lifts = {n: f"__lift_{i}" for i, n in enumerate(folds)}

    def _aggregates(self) -> list[Column]:
        place = F.struct(*self.order)
        return [scan._partial(f, F.col(self.lifts[n]), place).alias(self.lifts[n]) for n, f in self.folds.items()]

    def _lifted(self, rows: DataFrame) -> DataFrame:
        return rows.select(*rows.columns, *(f.value.alias(self.lifts[n]) for n, f in self.folds.items()))

    def begun(self, batch: DataFrame) -> DataFrame | None:
        """The state to begin with. All its keys come in, so that those without rows yet are kept too."""
        if self.initial is None:
            return None
        names = [*self.keys, *self.folds]
        kinds = self.state_schema(batch).fields
        return self.initial.select(*(F.col(n).cast(f.dataType).alias(f.name) for n, f in zip(names, kinds)))

    def held(self, batch_id: int) -> DataFrame:
        """The state as micro-batch ``batch_id`` left it."""
        table = KeyedTable(self.df.sparkSession, f"{self.out}/state", self.keys, self.state_schema(self.df), self.every)
        return table.view(batch_id).select(*self.keys, *(F.col(c).alias(n) for n, c in self.lifts.items()))

    def state_schema(self, batch: DataFrame) -> T.StructType:
        return self._lifted(batch.limit(0)).groupBy(*self.keys).agg(*self._aggregates()).schema

    def stacked(self, rows: DataFrame, carried: DataFrame | None) -> DataFrame:
        kinds = self.state_schema(rows)
        lifted = self._lifted(rows).withColumns({c: F.col(c).cast(kinds[c].dataType) for c in self.lifts.values()})
        lifted = lifted.withColumn(_SEED, F.lit(False))
        if carried is None:
            return lifted
        return lifted.unionByName(carried.withColumn(_SEED, F.lit(True)), allowMissingColumns=True)

    def results(self, both: DataFrame) -> DataFrame:
        folds = {n: replace(f, value=F.col(self.lifts[n])) for n, f in self.folds.items()}
        # A carried row has no place in the order: nulls come first.
        folded = running(both, self.keys, self.order, folds, self.segment, nullable_order=True)
        found = folded.where(~F.col(_SEED)).select(*self.df.columns, *self.folds)
        return self.after(found) if self.after else found

    def carried(self, both: DataFrame) -> DataFrame:
        return both.groupBy(*self.keys).agg(*self._aggregates())


class _Tops(_Run):
    def __init__(self, df, keys, value: str, order, n: int, out, hold, every, segment):
        super().__init__(df, keys, order, out, hold, every)
        self.value, self.n, self.segment = value, n, segment

    def state_schema(self, batch: DataFrame) -> T.StructType:
        best = T.StructField("best", T.ArrayType(batch.schema[self.value].dataType))
        return T.StructType([*(batch.schema[k] for k in self.keys), best])

    def stacked(self, rows: DataFrame, carried: DataFrame | None) -> DataFrame:
        rows = rows.withColumn(_SEED, F.lit(False))
        if carried is None:
            return rows
        seeds = carried.select(*self.keys, F.explode("best").alias(self.value), F.lit(True).alias(_SEED))
        return rows.unionByName(seeds, allowMissingColumns=True)

    def results(self, both: DataFrame) -> DataFrame:
        top = state.running_top_n(both, self.keys, self.value, self.order, self.n, self.segment)
        return top.where(~F.col(_SEED)).select(*self.df.columns, "top")

    def carried(self, both: DataFrame) -> DataFrame:
        best = Window.partitionBy(*self.keys).orderBy(F.col(self.value).desc())
        kept = both.where(F.col(self.value).isNotNull()).withColumn("__rank", F.row_number().over(best)).where(F.col("__rank") <= self.n)
        return kept.groupBy(*self.keys).agg(F.sort_array(F.collect_list(self.value), asc=False).alias("best"))


def fold_stream(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: Mapping[str, Fold],
    out: str,
    checkpoint: str,
    hold: HoldBack | None = None,
    after: Callable[[DataFrame], DataFrame] | None = None,
    every: int = 16,
    segment: Column | None = None,
    initial: DataFrame | None = None,
) -> DataStreamWriter:
    """Every row of a stream with the folds of its key's rows so far, in ``out/rows``; ``after`` is applied to these.

    Micro-batches must follow the order of arrival (``sources.arrival``) unless rows are held back; then the order is that
    of ``hold.time``, rows that come too late are in ``out/late``, and rows still held at the end have no result.
    A key's state is a row in ``out/state``. ``order`` must be a total order within a key, and must not be null.
    ``initial`` holds what keys have folded before, a row per key with a column per fold, as ``stored_folds`` gives it.
    """
    return _Folds(df, keys, order, folds, out, hold, every, after, segment, initial).writer(checkpoint)


def stored_folds(df: DataFrame, keys, order, folds: Mapping[str, Fold], out: str, checkpoint: str, every: int = 16) -> DataFrame:
    """What a stopped ``fold_stream`` (with the same arguments) holds: a row per key, with a column per fold."""
    last = last_batch(df.sparkSession, checkpoint)
    if last is None:
        raise ValueError(f"no micro-batch has ended in {checkpoint}")
    spark, rows = df.sparkSession, df
    if df.isStreaming:
        rows = spark.createDataFrame([], df.schema)
    return _Folds(rows, keys, order, folds, out, None, every, None, None).held(last)


def running_sum(df, keys, value: str, order, out: str, checkpoint: str, name: str = "total", **options) -> DataStreamWriter:
    """Every row with the key's sum so far, null until it has a value."""
    return fold_stream(df, keys, order, {name: scan.running_sum(F.col(value))}, out, checkpoint, **options)


def running_count(df, keys, order, out: str, checkpoint: str, name: str = "cnt", **options) -> DataStreamWriter:
    """Every row with the key's row count so far."""
    return fold_stream(df, keys, order, {name: scan.running_count()}, out, checkpoint, **options)


def running_value_counts(df, keys, value: str, order, out: str, checkpoint: str, **options) -> DataStreamWriter:
    """Every row with the count of its (key, value) so far."""
    return running_count(df, [*keys, value], order, out, checkpoint, **options)


def running_avg(df, keys, value: str, order, out: str, checkpoint: str, name: str = "avg", **options) -> DataStreamWriter:
    """Every row with the key's mean so far, null until it has a value."""
    parts = {"__total": scan.running_sum(F.col(value)), "__n": scan.running_sum(F.col(value).isNotNull().cast("bigint"))}

    def mean(rows: DataFrame) -> DataFrame:
        n = F.when(F.col("__n") > 0, F.col("__n"))
        return rows.withColumn(name, F.col("__total").cast("double") / n).drop("__total", "__n")

    return fold_stream(df, keys, order, parts, out, checkpoint, after=mean, **options)


def jump_alert(df, keys, value: str, order, out: str, checkpoint: str, threshold: float = 10, **options) -> DataStreamWriter:
    """Rows that differ from the key's previous value by more than ``threshold``; before the first it is 0."""

    def alerts(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("last_vc", F.coalesce("last_vc", F.lit(0)))
        return rows.where(F.abs(F.col(value) - F.col("last_vc")) > threshold)

    return fold_stream(df, keys, order, {"last_vc": scan.previous(F.col(value))}, out, checkpoint, after=alerts, **options)


def running_top_n(
    df, keys, value: str, order, out: str, checkpoint: str, n: int = 3, hold: HoldBack | None = None, every: int = 16, segment: Column | None = None
) -> DataStreamWriter:
    """Every row with the key's n highest values so far, highest first, in ``top``."""
    return _Tops(df, keys, value, order, n, out, hold, every, segment).writer(checkpoint)


def drained(spark: SparkSession, run: Callable[[str, str], DataStreamWriter], root: str, schema: str, kind: str = "rows") -> DataFrame:
    """Run a fold (``run(out, checkpoint)``) over what is there now, below ``root``; what it wrote as a batch."""
    drain(run(f"{root}/out", f"{root}/checkpoint"))
    found = spark.read.schema(schema).parquet(f"{root}/out/{kind}")
    return found.drop("batch")
