"""The state of a stopped stream, dealt to another number of shares, for a new stream to begin with.

A stream that resumes from its own checkpoint keeps its number of state partitions. To go on with another number of shares
(parallel parts of the input, each with a state of its own) read what the stopped stream held, deal it anew, and give it
to a stream with a fresh checkpoint, over the rows that the stopped one has not seen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def last_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The number of the last micro-batch that a stream has ended, None if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return None
    names = (found.getPath().getName() for found in system.listStatus(place))
    return max((int(n) for n in names if n.isdigit()), default=None)


def stored_state(
    spark: SparkSession, checkpoint: str, variable: str = "state", operator: int = 0, batch: int | None = None
) -> DataFrame:
    """A value state as its last micro-batch (or ``batch``) left it: a row per key, of the key's columns and the state's.

    Read by Spark's source for state, a task per state partition. ``variable`` is the name under which a processor holds
    it, ``operator`` the place of the operator in the query. A key whose state was cleared has no row.
    """
    reader = spark.read.format("statestore").option("operatorId", operator).option("stateVarName", variable)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint).select("key.*", "value.*")


def dealt(held: DataFrame, share: str, shares: int, merge: Mapping[str, Column]) -> DataFrame:
    """Each share's state goes to one new share, in turn (number modulo ``shares``), which merges what it is given.

    ``merge`` names the state's columns, each an aggregate over those of the old shares (``F.sum("n")``). New shares that
    are given none have no row and begin afresh. Share numbers begin at 0; no state at all gives no rows.
    """
    if shares < 1:
        raise ValueError("there must be a share")
    merged = [c.cast(held.schema[n].dataType).alias(n) for n, c in merge.items()]
    return held.groupBy(F.pmod(share, F.lit(shares)).cast(held.schema[share].dataType).alias(share)).agg(*merged)


def dealt_whole(held: DataFrame, share: str, shares: int, merge: Mapping[str, Column]) -> DataFrame:
    """The states of all shares, merged, go to every new share: a row for each of ``shares``; none without any state."""
    if shares < 1:
        raise ValueError("there must be a share")
    merged = [c.cast(held.schema[n].dataType).alias(n) for n, c in merge.items()]
    whole = held.agg(F.count(F.lit(1)).alias("__n"), *merged).where("__n > 0")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(shares - 1)).cast(f"array<{held.schema[share].dataType.simpleString()}>"))
    return whole.select(numbers.alias(share), *merge)
