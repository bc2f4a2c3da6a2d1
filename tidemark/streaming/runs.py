"""Running streams: fan-out, rule enrichment, and draining a stream into a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.joins import broadcast_threshold, interval_join, judge_sides
from tidemark.operators.lateness import DROPPED, LATE_ACCEPTED, late_classify, shifted
from tidemark.operators.scan import running, running_count, running_sum
from tidemark.operators.windows import END, START
from tidemark.session import scratch_path
from tidemark.sources.arrival import table_stream  # noqa: F401  (streams of tables)


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files: int = 0, glob: str | None = None
) -> DataFrame:
    """A stream of the files in folder ``path`` (those named like ``glob``), at most
    ``files`` of them per trigger (0: no limit)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.load(path)


def drain(writer: DataStreamWriter) -> None:
    """Take everything there is, then end."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


@contextmanager
def _fewer_partitions(spark: SparkSession, most: int | None) -> Iterator[None]:
    """A stream that is started here for the first time keeps its state in ``most`` partitions at most, all its life."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if most and most < int(before):
        spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _put(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _drop(spark: SparkSession, path: str) -> None:
    """Delete a folder that no later micro-batch, nor a repeated one, reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _done(spark: SparkSession, root: str, path: str | None) -> None:
    """A drain into a scratch folder is not resumed: its state and progress can go."""
    if path is None:
        _drop(spark, f"{root}/checkpoint")


def drain_to_table(df: DataFrame, label: str, mode: str = "append", path: str | None = None, partitions: int | None = None) -> DataFrame:
    """Run an append-mode stream over what is there now; its output read back as a batch.

    Each state partition costs a task its time in every micro-batch, rows or none. Where micro-batches are bounded they need
    no more of them for a larger table: ``partitions`` is the most there are, if the session does not ask for fewer.
    """
    spark = df.sparkSession
    root = path or scratch_path(spark, label)
    writer = df.writeStream.outputMode(mode).format("parquet")
    writer = writer.option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    with _fewer_partitions(spark, partitions):
        query = writer.start()
    query.awaitTermination()
    _done(spark, root, path)
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def drain_batches(
    df: DataFrame, label: str, step: Callable[[DataFrame], DataFrame], path: str | None = None
) -> DataFrame:
    """Run an append-mode stream over what is there now, each micro-batch through ``step``; all results read back."""
    spark = df.sparkSession
    root = path or scratch_path(spark, label)

    def write(batch: DataFrame, batch_id: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    drain(df.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint"))
    _done(spark, root, path)
    shape = step(spark.createDataFrame([], df.schema)).schema
    return spark.read.schema(shape).parquet(f"{root}/out").select(*shape.names)


def drain_updates(df: DataFrame, label: str, keys: Sequence[str], path: str | None = None) -> DataFrame:
    """Run an update-mode stream over what is there now; the newest row per key read back."""
    spark = df.sparkSession
    root = path or scratch_path(spark, label)

    def write(batch: DataFrame, batch_id: int) -> None:
        # One folder per micro-batch: a repeated batch replaces its own output.
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    writer = df.writeStream.outputMode("update").foreachBatch(write)
    drain(writer.option("checkpointLocation", f"{root}/checkpoint"))
    _done(spark, root, path)
    schema = T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])
    updates = spark.read.schema(schema).parquet(f"{root}/out")
    rest = [c for c in df.columns if c not in keys]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("__row"))
    return newest.select(*keys, "__row.*").select(*df.columns)


def fan_out(
    df: DataFrame, tag: str, sinks: Mapping[str, Callable[[DataFrame, int], None]], checkpoint: str
) -> DataStreamWriter:
    """One stream into several outputs: each micro-batch is computed once and written per tag."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, sink in sinks.items():
                sink(batch.where(F.col(tag) == name).drop(tag), batch_id)
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def threshold_stream(
    tagged: DataFrame, order: Sequence[str], rule: str, columns: Sequence[str], out: str, checkpoint: str
) -> DataStreamWriter:
    """Rule enrichment over a stream holding rows and rules (rows with ``rule`` set).

    Each micro-batch starts from the newest rule of the batches before it, kept as
    one row per batch next to the output; a repeated batch reads and writes the same.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            enrich(batch, batch_id)
        finally:
            batch.unpersist()

    def enrich(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = 0
        if batch_id > 0:
            known = spark.read.parquet(f"{out}/rule/{batch_id - 1}").first()["threshold"]
        rows = batch.where(F.col(rule).isNull()).select(*columns, *(c for c in order if c not in columns))
        rules = batch.where(F.col(rule).isNotNull())
        enriched = broadcast_threshold(rows, rules, order, rule, default=known)
        enriched.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")
        place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
        newest = rules.agg(F.coalesce(F.max_by(rule, place), F.lit(known)).alias("threshold"))
        newest.write.mode("overwrite").parquet(f"{out}/rule/{batch_id}")
        _drop(spark, f"{out}/rule/{batch_id - 2}")

    return tagged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def late_stream(
    df: DataFrame, time: str, order: Sequence[str], size: str, delay: float, lateness: float, out: str, checkpoint: str
) -> DataStreamWriter:
    """Every row of a stream with its window and ``late_class``, on the clock of the whole stream, in ``out/rows``.

    Micro-batches must follow the arrival order. Each is classed as a batch is, starting from the highest event time of
    those before it, which is kept as one row per batch next to the output; a repeated batch reads and writes the same.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            spark, known, before = batch.sparkSession, None, f"{out}/clock/{batch_id - 1}"
            if batch_id > 0:
                known = spark.read.schema(T.StructType([batch.schema[time]])).parquet(before).scalar()
            classed = late_classify(batch, time, order, size, delay, lateness, known=known)
            _put(classed, f"{out}/rows/batch={batch_id}")
            high = F.max(time) if known is None else F.greatest(F.max(time), known)
            _put(batch.agg(high.alias(time)), f"{out}/clock/{batch_id}")
            _drop(spark, f"{out}/clock/{batch_id - 2}")
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def _both(a: Column, b: Column) -> Column:
    """The sum of two values, or that of them which is not null."""
    return F.coalesce(a + b, a, b)


def firings_stream(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    order: Sequence[str],
    size: str,
    value: str,
    delay: float,
    lateness: float,
    out: str,
    checkpoint: str,
) -> DataStreamWriter:
    """The firings of ``lateness.window_firings`` over a stream, on the clock of the whole stream, in ``out/rows``.

    Micro-batches must follow the arrival order. Next to the output are kept, per batch, the highest event time and one
    row for each window that rows may still come to: its counts and sums in time and late, and whether it has fired.
    """
    bounds = [*keys, START, END]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            spark, known = batch.sparkSession, None
            if batch_id > 0:
                known = spark.read.schema(T.StructType([batch.schema[time]])).parquet(f"{out}/clock/{batch_id - 1}").scalar()
            classed = late_classify(batch, time, order, size, delay, lateness, known=known)
            accepted = classed.where(F.col("late_class") != DROPPED).select(
                *bounds, *order, value, (F.col("late_class") == LATE_ACCEPTED).alias("late")
            )
            in_time, late = ~F.col("late"), F.col("late")
            fresh = accepted.groupBy(*bounds).agg(
                F.count_if(in_time).alias("n"),
                F.sum(F.when(in_time, F.col(value))).alias("total"),
                F.count_if(late).alias("late_n"),
                F.sum(F.when(late, F.col(value))).alias("late_total"),
                F.lit(False).alias("fired"),
            )
            held = fresh.limit(0)
            if batch_id > 0:
                held = spark.read.schema(fresh.schema).parquet(f"{out}/windows/{batch_id - 1}")
            state = held.unionByName(fresh).groupBy(*bounds).agg(
                *(F.sum(c).alias(c) for c in ("n", "total", "late_n", "late_total")), F.max("fired").alias("fired")
            )
            high = F.max(time) if known is None else F.greatest(F.max(time), known)
            _put(batch.agg(high.alias(time)), f"{out}/clock/{batch_id}")
            now = spark.read.schema(T.StructType([batch.schema[time]])).parquet(f"{out}/clock/{batch_id}").scalar()
            due = (F.col("n") > 0) & ~F.col("fired") & (F.col(END) <= shifted(batch, now, time, -delay))
            first = state.where(due).select(*bounds, F.lit(1).cast("bigint").alias("firing"), F.col("n").alias("cnt"), "total")
            folds = {"__n": running_count(), "__total": running_sum(F.col(value)), "__late": running_sum(late.cast("bigint"))}
            so_far = running(accepted, bounds, order, folds).where(late)
            old = held.select(
                *(F.col(c).alias(f"__{c}") for c in bounds),
                (F.col("n") + F.col("late_n")).alias("__old"),
                _both(F.col("total"), F.col("late_total")).alias("__old_total"),
                F.col("late_n").alias("__old_late"),
            )
            met = so_far.join(old, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in bounds], "left")
            count = F.col("__n") + F.coalesce("__old", F.lit(0))
            lates = F.col("__late") + F.coalesce("__old_late", F.lit(0))
            again = met.select(
                *bounds,
                ((count > lates).cast("bigint") + lates).alias("firing"),
                count.alias("cnt"),
                _both(F.col("__total"), F.col("__old_total")).alias("total"),
            )
            _put(first.unionByName(again), f"{out}/rows/batch={batch_id}")
            open_ = state.withColumn("fired", F.col("fired") | due)
            _put(open_.where(F.col(END) > shifted(batch, now, time, -(delay + lateness))), f"{out}/windows/{batch_id}")
            for kind in ("clock", "windows"):
                _drop(spark, f"{out}/{kind}/{batch_id - 2}")
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def interval_join_late_stream(
    tagged: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    lower: float,
    upper: float,
    delay: float,
    out: str,
    checkpoint: str,
) -> DataStreamWriter:
    """Interval join of a stream of ``joins.tag_sides`` with late rows turned away, on the clock of both whole inputs.

    Writes ``out/pairs``, and the late rows as they came to ``out/late``. Micro-batches must follow the arrival order.
    Rows that later ones may still meet, and the highest times, are kept per batch next to the output; what no row to
    come can reach is let go.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, known, held = batch.sparkSession, None, None
        clock = T.StructType([T.StructField(f"high_{n}", batch.schema["time"].dataType) for n in "lr"])
        if batch_id > 0:
            known = spark.read.schema(clock).parquet(f"{out}/clock/{batch_id - 1}")
            held = spark.read.schema(batch.schema).parquet(f"{out}/held/{batch_id - 1}")
        judged = judge_sides(batch, delay, known=known).persist()
        try:
            new = judged.where(~F.col("late")).drop("late")
            _put(judged.where("late").drop("late"), f"{out}/late/batch={batch_id}")

            def side(rows: DataFrame, name: str) -> DataFrame:
                found = rows.where(F.col("side") == name).select(f"{name}.*")
                return found if name == "l" else found.drop(*(c for c in batch.schema["l"].dataType.names if c not in on))

            whole = new if held is None else new.unionByName(held)
            pairs = interval_join(side(new, "l"), side(whole, "r"), on, left_time, right_time, lower, upper)
            if held is not None:
                earlier = interval_join(side(held, "l"), side(new, "r"), on, left_time, right_time, lower, upper)
                pairs = pairs.unionByName(earlier)
            _put(pairs, f"{out}/pairs/batch={batch_id}")
            highs = [F.max(F.when(F.col("side") == n, F.col("time"))) for n in "lr"]
            if known is not None:
                highs = [F.greatest(h, known.select(f"high_{n}").scalar()) for h, n in zip(highs, "lr")]
            _put(judged.agg(*(h.alias(f"high_{n}") for h, n in zip(highs, "lr"))), f"{out}/clock/{batch_id}")
            now = spark.read.schema(clock).parquet(f"{out}/clock/{batch_id}")
            mark = now.select(shifted(batch, F.when(F.col("high_l").isNotNull() & F.col("high_r").isNotNull(), F.least("high_l", "high_r")), "time", -(delay + 0.001)).alias("m")).scalar()
            reach = F.when(F.col("side") == "l", shifted(batch, F.col("time"), "time", upper)).otherwise(shifted(batch, F.col("time"), "time", -lower))
            _put(whole.where(mark.isNull() | (reach >= mark)), f"{out}/held/{batch_id}")
            for kind in ("clock", "held"):
                _drop(spark, f"{out}/{kind}/{batch_id - 2}")
        finally:
            judged.unpersist()

    return tagged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
