"""Catalog tables: create, copy, read as batch or stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.schema import table_schema


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def create_table(
    spark: SparkSession, name: str, columns: Mapping[str, str], location: str | None = None, fmt: str = "parquet"
) -> None:
    """A table from column name -> database type."""
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(dict(columns)).fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING {fmt}{where}")


def create_like(
    spark: SparkSession, name: str, model: str, location: str | None = None, fmt: str = "parquet"
) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} LIKE {model} USING {fmt}{where}")


def insert_rows(spark: SparkSession, name: str, rows: Sequence[tuple]) -> None:
    """Insert literal rows."""
    schema = spark.table(name).schema
    spark.createDataFrame(list(rows), schema).write.insertInto(name)


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    spark.sql(f"INSERT INTO {target} SELECT * FROM {source}")


def read_table(spark: SparkSession, name: str, streaming: bool = False) -> DataFrame:
    """A table as a batch, or as a stream of what is and will be in it."""
    return spark.readStream.table(name) if streaming else spark.table(name)


def create_catalog(spark: SparkSession, name: str, implementation: str, **options: str) -> None:
    """Register a catalog by the class that implements it; Spark loads it when it is first used."""
    if name == "spark_catalog":
        raise ValueError("spark_catalog is the session's own")
    spark.conf.set(f"spark.sql.catalog.{name}", implementation)
    for key, value in options.items():
        spark.conf.set(f"spark.sql.catalog.{name}.{key}", value)


def use_catalog(spark: SparkSession, name: str, database: str | None = None) -> None:
    """Resolve names in this catalog (and database) from now on."""
    spark.catalog.setCurrentCatalog(name)
    if database:
        spark.catalog.setCurrentDatabase(database)
