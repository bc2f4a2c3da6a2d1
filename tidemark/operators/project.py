"""Row-wise operators: map, filter, flat-map, routing."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import tokens


def map_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """One output row per input row."""
    return df.select(*(c.alias(n) for n, c in columns.items()))


def filter_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose ``column`` equals ``value``; a null never matches."""
    return df.where(F.col(column) == F.lit(value))


def flat_map(df: DataFrame, values: Column, name: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """One output row per element of the array expression."""
    return df.select(*keep, F.explode(values).alias(name))


def flat_map_case(df: DataFrame, key: str, cases: Mapping[object, list[Column]], keep: Iterable[str] = ()) -> DataFrame:
    """Per key value, the listed columns as strings; other keys give no row."""
    branch = F.array().cast("array<string>")
    for match, columns in cases.items():
        branch = F.when(F.col(key) == F.lit(match), F.array(*(c.cast("string") for c in columns))).otherwise(branch)
    return flat_map(df, branch, keep=keep)


def tokenize(df: DataFrame, line: str = "value", keep: Iterable[str] = (), position: str | None = None) -> DataFrame:
    """Lines to ``word`` rows, optionally with the word's place in its line."""
    words = tokens(F.col(line))
    if position:
        return df.select(*keep, F.posexplode(words).alias(position, "word"))
    return df.select(*keep, F.explode(words).alias("word"))


def even_rows(df: DataFrame, value: Column) -> DataFrame:
    """Remainder 0 by 2."""
    return df.where(value % 2 == 0)


def odd_rows(df: DataFrame, value: Column) -> DataFrame:
    """Remainder 1 by 2. The remainder has the sign of the dividend, so -3 is in neither half."""
    return df.where(value % 2 == 1)


def route(df: DataFrame, tags: Mapping[str, Column], main: str = "main") -> DataFrame:
    """Tag each row with the first condition it meets, else ``main``: one pass over the input."""
    tag = F.lit(main)
    for name, condition in reversed(list(tags.items())):
        tag = F.when(condition, F.lit(name)).otherwise(tag)
    return df.withColumn("tag", tag)


def output(routed: DataFrame, tag: str) -> DataFrame:
    """One named output of ``route``."""
    return routed.where(F.col("tag") == tag).drop("tag")


def side_alert(df: DataFrame, condition: Column, message: Column, main: str = "main", side: str = "warn") -> DataFrame:
    """Every row under ``main``, and a row with ``message`` under ``side`` where the condition holds."""
    tags = F.when(condition, F.array(F.lit(main), F.lit(side))).otherwise(F.array(F.lit(main)))
    return df.withColumn("tag", F.explode(tags)).withColumn("message", F.when(F.col("tag") == side, message))


@dataclass(frozen=True)
class Task:
    """A running task: its number among the stage's tasks from 0, its attempt from 0, and a name from both."""

    number: int
    attempt: int

    @property
    def name(self) -> str:
        return f"task {self.number} (#{self.attempt})"

    @staticmethod
    def current() -> Task:
        context = TaskContext.get()
        return Task(context.partitionId(), context.attemptNumber())


def rich_map(
    df: DataFrame,
    schema: str,
    function: Callable[[object, pd.DataFrame], pd.DataFrame],
    open: Callable[..., object] = lambda: None,
    close: Callable[[object], None] = lambda resource: None,
) -> DataFrame:
    """Map batches with a resource opened once per task and closed even when the task is cancelled.

    An ``open`` that takes an argument gets the ``Task`` it runs in.
    """
    wants_task = len(inspect.signature(open).parameters) > 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open(Task.current()) if wants_task else open()
        try:
            for batch in batches:
                yield function(resource, batch)
        finally:
            close(resource)

    return df.mapInPandas(run, schema)
