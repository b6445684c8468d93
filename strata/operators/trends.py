"""Datetime trends (A4-A6, L2): row counts per day, month and year.

One shuffle to day level for all datetime columns at once (unpivot to
``(column, day)``, partial counts map-side). Months and years are rolled up
from the day counts, which are tiny (at most one row per column and calendar
day), so the three grains share the day-level exchange (Spark reuses the
identical exchange inside one plan).

A NULL or unparsable value is kept as a NULL bucket at every grain and sorts
last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.naming import col
from strata.functions.values import as_date

DAY, MONTH, YEAR = "day", "month", "year"
GRAIN_ORDER = {DAY: 1, MONTH: 2, YEAR: 3}

TREND_SCHEMA = "position INT, column_name STRING, grain STRING, period DATE, count BIGINT"


def day_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """A4: ``(position, column, day DATE, count)``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(c).alias("column_name"),
            as_date(col(c), types[c]).alias("day"),
        )
        for i, c in enumerate(columns)
    ]
    return (
        df.select(F.inline(F.array(*entries)))
        .groupBy("position", "column_name", "day")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def month_counts(days: DataFrame) -> DataFrame:
    """A5 rolled up from day counts: ``(position, column, month DATE, count)``."""
    return days.groupBy("position", "column_name", F.trunc("day", "month").alias("month")).agg(
        F.sum("count").alias("count")
    )


def year_counts(days: DataFrame) -> DataFrame:
    """A6 rolled up from day counts: ``(position, column, year INT, count)``."""
    return days.groupBy("position", "column_name", F.year("day").alias("year")).agg(
        F.sum("count").alias("count")
    )


def trends(df: DataFrame, columns: list[str]) -> DataFrame:
    """All three grains in one long form ``(position, column, grain, period, count)``.

    ``period`` is the day, the first day of the month, or January 1st of the year.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], TREND_SCHEMA)
    days = day_counts(df, columns)
    by_day = days.select(
        "position", "column_name", F.lit(DAY).alias("grain"), F.col("day").alias("period"), "count"
    )
    by_month = month_counts(days).select(
        "position", "column_name", F.lit(MONTH).alias("grain"), F.col("month").alias("period"), "count"
    )
    by_year = year_counts(days).select(
        "position",
        "column_name",
        F.lit(YEAR).alias("grain"),
        F.make_date(F.col("year"), F.lit(1), F.lit(1)).alias("period"),
        "count",
    )
    return by_day.unionByName(by_month).unionByName(by_year)


def ordered(trend_frame: DataFrame) -> DataFrame:
    """L2: ascending time within column and grain, NULL bucket last."""
    grain_rank = F.create_map(*[F.lit(x) for kv in GRAIN_ORDER.items() for x in kv])[F.col("grain")]
    return trend_frame.orderBy("position", grain_rank, F.col("period").asc_nulls_last())
