"""Event time and window bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

WINDOW_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def event_time(df: DataFrame, column: str = "ts", unit: str = "seconds", name: str = "event_time") -> DataFrame:
    """Add the event time held in ``column`` as epoch seconds or milliseconds, or as a timestamp."""
    c = F.col(column)
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        value = c
    elif isinstance(kind, T.TimestampNTZType):
        value = c.cast("timestamp")
    elif unit == "seconds":
        value = F.timestamp_seconds(c)
    elif unit == "milliseconds":
        value = F.timestamp_millis(c)
    else:
        raise ValueError("unit is 'seconds' or 'milliseconds'")
    return df.withColumn(name, value)


def seconds(n: float) -> Column:
    """A day-time interval of ``n`` seconds."""
    return F.make_dt_interval(secs=F.lit(n).cast("decimal(18,6)"))


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds since the epoch, for either timestamp type or an integer column."""
    c = F.col(column)
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(c)
    if isinstance(kind, T.TimestampNTZType):
        # Wall-clock arithmetic, so the session time zone plays no part.
        days = F.unix_date(F.to_date(c)).cast("bigint")
        return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint")
    raise ValueError(f"{column} is neither a timestamp nor an integer")


def tumbling(df: DataFrame, column: str, size: float) -> tuple[Column, Column]:
    """Start and end of the epoch-aligned window of whole ``size`` seconds a row falls in."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        start = F.floor(F.col(column) / size) * int(size)
        return start.cast(kind), (start + int(size)).cast(kind)
    w = F.window(column, f"{size} seconds")
    return w["start"], w["end"]


def format_time(column: Column, pattern: str = WINDOW_FORMAT) -> Column:
    return F.date_format(column, pattern)
