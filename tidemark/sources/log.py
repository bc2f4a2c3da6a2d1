"""Log topics (the ``kafka`` format): options, decoding, encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

STARTS = ("earliest", "latest")


def read_options(
    servers: str,
    topic: str,
    start: str = "latest",
    group: str | None = None,
    read_committed: bool = False,
) -> dict[str, str]:
    """Reader options. A query's checkpoint overrides ``start`` once it exists."""
    if start not in STARTS:
        raise ValueError(f"start is one of {STARTS}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if group:
        options["kafka.group.id"] = group
    if read_committed:
        options["kafka.isolation.level"] = "read_committed"
    return options


def write_options(servers: str, topic: str, **producer: str) -> dict[str, str]:
    """Writer options; keyword names use ``_`` for dots, as in ``transaction_timeout_ms``."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    options.update({f"kafka.{name.replace('_', '.')}": str(value) for name, value in producer.items()})
    return options


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return decode(spark.readStream.format("kafka").options(**options).load())


def write_stream(df: DataFrame, options: dict[str, str], checkpoint: str):
    """At least once; give rows a ``record_id`` and drop repeats downstream."""
    return df.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)


def decode(records: DataFrame, value: str = "value") -> DataFrame:
    """The value bytes as text; other record fields are left out."""
    return records.select(F.decode(F.col(value), "UTF-8").alias("value"))


def encode(df: DataFrame, value: Column) -> DataFrame:
    """Value-only records."""
    return df.select(F.encode(value, "UTF-8").alias("value"))


def encode_keyed(df: DataFrame, line: str = "value", sep: str = ",") -> DataFrame:
    """Records keyed by the first field of a delimited line."""
    first = F.split(F.col(line), f"[{sep}]")[0]
    return df.select(F.encode(first, "UTF-8").alias("key"), F.encode(F.col(line), "UTF-8").alias("value"))
