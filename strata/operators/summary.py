"""Numeric summary (A1, A2): count, mean, min, max, stddev_pop per column.

One aggregate for all columns (partial aggregation map-side, a single-row final
aggregate), turned into a long form by exploding an array of structs. No
shuffle beyond the one-row final exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.naming import col

DEFAULT_CHUNK = 100

SUMMARY_SCHEMA = (
    "position INT, column_name STRING, count BIGINT, mean DOUBLE, min DOUBLE, max DOUBLE, "
    "stddev_pop DOUBLE"
)


def row_count(df: DataFrame) -> DataFrame:
    """A1 as a one-row DataFrame ``(row_count BIGINT)``."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def _summary_chunk(df: DataFrame, columns: list[str], first_position: int) -> DataFrame:
    aggs = []
    for i, c in enumerate(columns):
        x = col(c)
        aggs += [
            F.count(x).alias(f"c{i}"),
            F.avg(x).cast("double").alias(f"a{i}"),
            F.min(x).cast("double").alias(f"lo{i}"),
            F.max(x).cast("double").alias(f"hi{i}"),
            F.stddev_pop(x).cast("double").alias(f"sd{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(first_position + i).alias("position"),
                F.lit(c).alias("column_name"),
                F.col(f"c{i}").alias("count"),
                F.col(f"a{i}").alias("mean"),
                F.col(f"lo{i}").alias("min"),
                F.col(f"hi{i}").alias("max"),
                F.col(f"sd{i}").alias("stddev_pop"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def numeric_summary(df: DataFrame, columns: list[str], chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """A2 long form ``(position, column_name, count, mean, min, max, stddev_pop)``.

    Min and max are reported as DOUBLE (as the reference's float output). Up to
    ``chunk`` columns share one aggregate (wider inputs: one aggregate per chunk,
    so generated code stays within the JVM's method-size limits).
    """
    if not columns:
        return df.sparkSession.createDataFrame([], SUMMARY_SCHEMA)
    parts = [
        _summary_chunk(df, columns[i : i + chunk], i + 1) for i in range(0, len(columns), chunk)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
