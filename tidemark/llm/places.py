"""Places of rows in a total order within groups, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.shared import settled


def placed(rows: DataFrame, group: str, order: Sequence, place: str = "pos", total: str = "n") -> DataFrame:
    """``rows`` with their ``place`` (from 0) along ``order`` within ``group`` and the ``total`` rows of that.

    The rows are ranged over partitions by group and order; a place is a partition's own count added to that of the
    partitions before it, so that no group is sorted in one task and what is summed is a row for each partition and group.
    Rows that tie follow each other in any order, fixed once. ``group`` must not be null. ``rows`` must be cheap to read
    again (a settled table): Spark samples them for the ranges. The result is settled; "__" begins names that are taken.
    """
    tied = settled(rows.withColumn("__row", F.monotonically_increasing_id()))
    along = [group, *order, "__row"]
    ranged = settled(
        tied.repartitionByRange(*along)
        .sortWithinPartitions(*along)
        .withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
        .drop("__row")
    )
    spans = ranged.groupBy("__part", group).agg(F.count("*").alias("__own"), F.min("__at").alias("__first"))
    every = Window.partitionBy(group)
    spans = spans.select(
        F.col("__part").alias("__p"),
        F.col(group).alias("__g"),
        "__first",
        F.sum("__own").over(every).alias(total),
        F.coalesce(F.sum("__own").over(every.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
    )
    met = ranged.join(settled(spans), (F.col("__part") == F.col("__p")) & (F.col(group) == F.col("__g")))
    return settled(met.select(*rows.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias(place), total))
