"""Most frequent values per time window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.windows import END, START


def window_counts(df: DataFrame, time: str, value: str, size: str, step: str) -> DataFrame:
    """How often each value occurs in each sliding window. On a watermarked stream, in append mode, all counts of a
    window come in the micro-batch that closes it."""
    counts = df.groupBy(F.window(time, size, step).alias("w"), F.col(value)).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select(F.col("w.start").alias(START), F.col("w.end").alias(END), value, "cnt")


def best_counts(counts: DataFrame, value: str, n: int = 2) -> DataFrame:
    """The ``n`` highest counts of each window; ties go to the smaller value. Only n candidates per window and task
    reach the ranking."""
    best = Window.partitionBy(START, END).orderBy(F.col("cnt").desc(), F.col(value))
    return counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def window_top_n(df: DataFrame, time: str, value: str, size: str, step: str, n: int = 2) -> DataFrame:
    """The ``n`` most frequent values of each sliding window; ties go to the smaller value.

    Counts are combined before the exchange. Over a stream, drain ``window_counts`` with ``best_counts`` as the step of
    each micro-batch: a window closes within one, so its counts are ranked there as in a batch.
    """
    return best_counts(window_counts(df, time, value, size, step), value, n)
