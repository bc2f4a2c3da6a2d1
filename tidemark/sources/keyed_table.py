"""A table with one row per key, kept by micro-batches: deltas with deletions over a base, merged on reading.

Batch n writes the rows it changed to ``delta/n``. Every so many batches a base takes up what came before. A batch that is
repeated reads what it read before and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_BATCH, _GONE = "__batch", "__gone"


class KeyedTable:
    """``schema`` holds the ``keys`` and the other columns; a base is made every ``every`` batches."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, every: int = 16):
        self.spark, self.path, self.keys, self.schema, self.every = spark, path, list(keys), schema, every
        extra = [T.StructField(_BATCH, T.LongType()), T.StructField(_GONE, T.BooleanType())]
        self.stored = T.StructType([*schema.fields, *extra])

    def _stacked(self, batch: int, base: int) -> DataFrame:
        paths = [f"{self.path}/base/{base}"] if base else []
        paths += [f"{self.path}/delta/{n}" for n in range(base, batch)]
        if not paths:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(*paths)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """The newest row of each key, with its batch."""
        rest = [c for c in self.stored.names if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), _BATCH).alias("__row"))
        newest = newest.select(*self.keys, "__row.*").select(*self.stored.names)
        return newest.where(~F.col(_GONE))

    def read(self, batch: int, only: DataFrame | None = None) -> DataFrame:
        """The table as the batches before ``batch``, which has begun, left it; ``only`` those keys of it (null-safe)."""
        rows = self._stacked(batch, batch // self.every * self.every)
        if only is not None:
            named = only.select(*(F.col(k).alias(f"__{k}") for k in self.keys)).distinct()
            rows = rows.join(named, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys], "left_semi")
        return self._merged(rows).select(*self.schema.names)

    def view(self, last: int) -> DataFrame:
        """The table as ``last``, the newest batch, has left it."""
        return self._merged(self._stacked(last + 1, last // self.every * self.every)).select(*self.schema.names)

    def begin(self, batch: int) -> None:
        """Make a base where one is due, and let go of what no batch to come, nor a repeated one, reads."""
        if batch and batch % self.every == 0:
            merged = self._merged(self._stacked(batch, batch - self.every))
            merged.write.mode("overwrite").parquet(f"{self.path}/base/{batch}")
            for n in range(batch - 2 * self.every, batch - self.every):
                if n >= 0:
                    self._drop(f"delta/{n}")
            self._drop(f"base/{batch - 2 * self.every}")

    def write(self, batch: int, rows: DataFrame, gone: Column | None = None) -> None:
        """The rows that ``batch`` sets, one per key; those where ``gone`` holds are deleted."""
        marks = {_BATCH: F.lit(batch).cast("long"), _GONE: F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)}
        rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema.fields), *(c.alias(n) for n, c in marks.items())).write.mode(
            "overwrite"
        ).parquet(f"{self.path}/delta/{batch}")

    def _drop(self, name: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
