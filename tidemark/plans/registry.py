"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import apply_defaults

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` gives the same rows over the same tables."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(apply_defaults(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return function

    return register
