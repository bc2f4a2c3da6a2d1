"""Parsing lines and JSON into typed columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.schema import SENSOR


def tokens(line: Column) -> Column:
    """Words between single spaces: empty tokens stay, except at the end of the line."""
    trimmed = F.rtrim(line)  # blanks only, not tabs or line ends
    return F.when((line != "") & (trimmed == ""), F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


# What a whole field must look like; the cast alone would accept blanks around it.
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_PATTERNS = [
    (T.IntegralType, _WHOLE),
    (T.DecimalType, _NUMBER),
    (T.FractionalType, rf"{_NUMBER}|^[+-]?(Infinity|NaN)$"),
    (T.BooleanType, r"^(?i)(true|false)$"),
    (T.DateType, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ((T.TimestampType, T.TimestampNTZType), r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?(Z|[+-][0-9]{2}:[0-9]{2})?$"),
]


def _parsed(raw: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return raw
    for types, pattern in _PATTERNS:
        if isinstance(kind, types):
            return F.when(raw.rlike(pattern), raw.try_cast(kind))
    raise ValueError(f"a field of type {kind.simpleString()} can't be read from text")


def parse_delimited(
    df: DataFrame, schema: T.StructType = SENSOR, line: str = "value", sep: str = ",", mode: str = "strict"
) -> DataFrame:
    """Lines of fields between ``sep`` (any string) to the columns of ``schema``.

    ``strict`` fails the job on the first malformed line. ``permissive`` keeps it:
    its fields are null where unreadable, and ``malformed`` is true.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError("mode is 'strict' or 'permissive'")
    pieces = F.split(F.col(line), re.escape(sep))
    raw = [F.get(pieces, F.lit(i)) for i in range(len(schema.fields))]
    values = [_parsed(r, f.dataType) for r, f in zip(raw, schema.fields)]
    bad = F.lit(False)
    for value in values:
        bad = bad | value.isNull()
    if mode == "permissive":
        return df.select(
            *(v.alias(f.name) for v, f in zip(values, schema.fields)), bad.alias("malformed"), F.col(line)
        )
    complaint = F.raise_error(F.concat(F.lit("malformed line: "), F.coalesce(F.col(line), F.lit("null"))))
    return df.select(
        *(
            F.when(bad, complaint.cast(f.dataType)).otherwise(v).alias(f.name)
            for v, f in zip(values, schema.fields)
        )
    )


def rows_from_json(
    df: DataFrame, schema: T.StructType, column: str = "value", keep: Sequence[str] = (), mode: str = "strict"
) -> DataFrame:
    """A JSON string column to typed columns, by field name; an absent field is null, and a null string a row of nulls.

    ``strict`` fails the job on malformed JSON. ``permissive`` keeps the row: its fields are null where unreadable, and
    ``malformed`` is true.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError("mode is 'strict' or 'permissive'")
    if mode == "strict":
        parsed = F.from_json(column, schema, {"mode": "FAILFAST"})
        return df.select(*keep, parsed.alias("__json")).select(*keep, "__json.*")
    broken = "__malformed"
    wide = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    parsed = F.from_json(column, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken})
    fields = [F.col("__json")[f.name].alias(f.name) for f in schema.fields]
    return df.select(*keep, parsed.alias("__json")).select(
        *keep, *fields, F.coalesce(F.col("__json")[broken].isNotNull(), F.lit(False)).alias("malformed")
    )


def rows_to_json(df: DataFrame, columns: Sequence[str] | None = None, value: str = "value") -> DataFrame:
    """Every row as one JSON string."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias(value))
