"""Value-level expressions shared by the operators.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A string only counts as a timestamp when it starts with a four-digit year.
# Spark also parses time-only text ('12:30', 'T12') by attaching *today's* date,
# which would make profiles and trends depend on the day the job runs.
YEAR_PREFIX = r"^\s*[0-9]{4}"

NUMERIC_TYPES = (T.NumericType,)
DATETIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
NESTED_TYPES = (T.ArrayType, T.MapType, T.StructType)


def parse_timestamp(c: Column) -> Column:
    """NULL-safe string → timestamp (``try_to_timestamp``; ANSI mode never raises)."""
    return F.when(c.rlike(YEAR_PREFIX), F.try_to_timestamp(c))


def as_date(c: Column, data_type: T.DataType) -> Column:
    """Calendar day of a datetime-role column of any supported type."""
    if isinstance(data_type, T.StringType):
        return F.to_date(parse_timestamp(c))
    if isinstance(data_type, T.DateType):
        return c
    return F.to_date(c)


def as_text(c: Column, data_type: T.DataType) -> Column:
    """Text form of a value used for frequency keys and the processed layer.

    Numbers are normalised first (``c + 0`` turns -0.0 into 0.0, so both are one
    group, as they are when grouping the number itself). Nested values use JSON
    (the engines' native text forms of maps/structs disagree).
    """
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return (c + F.lit(0.0)).cast("string")
    if isinstance(data_type, NESTED_TYPES):
        return F.to_json(c)
    if isinstance(data_type, T.BinaryType):
        return F.base64(c)
    return c.cast("string")
