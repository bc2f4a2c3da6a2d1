"""Row types and the database-type mapping."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

SENSOR = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("ts", T.LongType()), T.StructField("vc", T.IntegerType())]
)
EVENT = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("money", T.LongType()),
    ]
)
EVENT_TABLE = T.StructType([T.StructField("id", T.LongType()), *EVENT.fields])
ADDRESS_TABLE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("update_time", T.StringType()),
    ]
)

# Database type name -> Spark type. TIME is the millisecond of the day.
DATABASE_TYPES = {
    "NULL": T.NullType(),
    "BOOLEAN": T.BooleanType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "INTERVAL_YEAR_MONTH": T.YearMonthIntervalType(),
    "INTERVAL_DAY_TIME": T.DayTimeIntervalType(),
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DATE": T.DateType(),
    "TIME": T.IntegerType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMP_WITH_TIME_ZONE": T.TimestampType(),
    "CHAR": T.StringType(),
    "VARCHAR": T.StringType(),
    "BINARY": T.BinaryType(),
    "VARBINARY": T.BinaryType(),
}


def _split_top(text: str) -> list[str]:
    """``text`` at the commas that stand in no brackets."""
    parts, depth, start = [], 0, 0
    for i, sign in enumerate(text):
        depth += (sign in "<(") - (sign in ">)")
        if sign == "," and depth == 0:
            parts.append(text[start:i])
            start = i + 1
    return [p.strip() for p in [*parts, text[start:]]]


def spark_type(name: str) -> T.DataType:
    """Spark type of a database type such as ``BIGINT``, ``DECIMAL(10,2)``, ``ARRAY<INTEGER>``, ``MAP<VARCHAR, DOUBLE>``
    or ``ROW<a INTEGER, b ARRAY<DATE>>``."""
    text = name.strip()
    nested = re.fullmatch(r"(?is)(ARRAY|MULTISET|MAP|ROW)\s*<(.*)>", text)
    if nested:
        kind, inner = nested[1].upper(), _split_top(nested[2])
        if kind in ("ARRAY", "MULTISET") and len(inner) == 1:
            return T.ArrayType(spark_type(inner[0]))
        if kind == "MAP" and len(inner) == 2:
            return T.MapType(spark_type(inner[0]), spark_type(inner[1]))
        if kind == "ROW" and all(" " in x for x in inner):
            return T.StructType([T.StructField(*_field(x)) for x in inner])
        raise ValueError(f"no Spark type for {name!r}")
    text = text.upper()
    decimal = re.fullmatch(r"DECIMAL\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)", text)
    if decimal:
        return T.DecimalType(int(decimal[1]), int(decimal[2]))
    if text in DATABASE_TYPES:
        return DATABASE_TYPES[text]
    bare = re.sub(r"\(.*\)", "", text).strip()
    if bare in ("CHAR", "VARCHAR", "BINARY", "VARBINARY", "TIMESTAMP"):
        return DATABASE_TYPES[bare]
    raise ValueError(f"no Spark type for {name!r}")


def _field(field: str) -> tuple[str, T.DataType]:
    """Name and type of a field such as ``a INTEGER``."""
    name, kind = field.split(None, 1)
    return name.strip("`"), spark_type(kind)


def table_schema(columns: dict[str, str]) -> T.StructType:
    """Schema from column name -> database type."""
    return T.StructType([T.StructField(n, spark_type(t)) for n, t in columns.items()])


_NARROW = {T.ByteType(): 8, T.ShortType(): 16}
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    bits = _NARROW.get(target)
    if bits and isinstance(source, _WHOLE):
        # Narrowed as the JDBC converter does it (``shortValue()``): a number that does not fit keeps its low bits.
        value = F.shiftright(F.shiftleft(value.cast("bigint"), 64 - bits), 64 - bits)
    return value.cast(target)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, cast to its types; an absent column is null.

    Whole numbers too large for a TINYINT or SMALLINT keep their low bits, where SQL would end the job; other values that
    don't fit raise.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *(
            _cast(F.col(f.name) if f.name in present else F.lit(None), present.get(f.name), f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
