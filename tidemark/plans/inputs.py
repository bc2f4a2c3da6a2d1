"""How the standard tables play the parts of sensor rows, lines and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as sensor rows. ``event_id`` is the order of events; ``arr`` is an arrival
    order in which some rows come up to twelve places late."""
    late = (F.col("event_id") * 7919) % 13
    return table(spark, sf_dir, "events").select(
        "event_id",
        ((F.col("event_id") + late) * 13 + 12 - late).alias("arr"),
        F.col("user_id").alias("id"),
        "ts",
        F.col("value").cast("int").alias("vc"),
        "event_type",
        "props",
    )


# The same as SQL, for the start of a statement.
SENSORS = """WITH s AS (
  SELECT event_id, (event_id + (event_id * 7919) % 13) * 13 + 12 - (event_id * 7919) % 13 AS arr,
         user_id AS id, ts, CAST(trunc(value) AS INTEGER) AS vc, event_type, props
  FROM events)
"""


def bucket(size: str, column: str = "ts") -> str:
    """SQL for the start of the epoch-aligned window of ``size``."""
    return f"time_bucket(INTERVAL {size}, {column}, TIMESTAMP '1970-01-01')"
