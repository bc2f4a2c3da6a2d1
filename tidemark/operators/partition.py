"""Physical placement of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def by_key(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Every row of a key in the same partition."""
    return df.repartition(n, *keys)


def shuffled(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Rows placed by a seeded random number."""
    return df.repartition(n, F.rand(seed))


def rebalanced(df: DataFrame, n: int) -> DataFrame:
    """Round robin, to even out a skewed source."""
    return df.repartition(n)


def rescaled(df: DataFrame, n: int) -> DataFrame:
    """Merge neighbouring partitions down to ``n`` without an exchange."""
    return df.coalesce(n)


def custom(df: DataFrame, n: int, key: Column) -> DataFrame:
    """Row to partition ``key mod n``; negative keys wrap around."""
    return df.repartitionById(n, F.pmod(key, F.lit(n)).cast("int"))


def with_partition(df: DataFrame, name: str = "partition") -> DataFrame:
    """Add the number of the partition each row is in."""
    return df.withColumn(name, F.spark_partition_id())
