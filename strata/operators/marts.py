"""Analytics marts over the processed layer.

The group key is the first string column of the processed layer (so the first
non-numeric column of the raw data). Metrics: ``row_count``, then ``sum_<c>``
for every numeric column, then ``avg_<c>``. Without numerics the mart is a
single ``row_count`` — even when a string column exists (A9). Without a string
column it is one global row (A8).

``groupBy(key)`` aggregates map-side first, so a key that holds a third of all
rows costs one partial row per mapper, not a third of the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import col

SLICE_KEY = "slice_key"
ROW_COUNT = "row_count"


@dataclass(frozen=True)
class MartShape:
    key: str | None
    numeric: list[str]

    @property
    def kind(self) -> str:
        if self.key and self.numeric:
            return "grouped"
        if self.numeric:
            return "global"
        return "count_only"

    def metric_names(self) -> list[str]:
        return [f"sum_{c}" for c in self.numeric] + [f"avg_{c}" for c in self.numeric]


def mart_shape(processed_df: DataFrame) -> MartShape:
    """Group key and numeric columns of a processed frame (from its schema)."""
    strings = [f.name for f in processed_df.schema.fields if isinstance(f.dataType, T.StringType)]
    numeric = [f.name for f in processed_df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return MartShape(strings[0] if strings else None, numeric)


def metric_columns(shape: MartShape) -> list:
    return (
        [F.count(F.lit(1)).alias(ROW_COUNT)]
        + [F.sum(col(c)).alias(f"sum_{c}") for c in shape.numeric]
        + [F.avg(col(c)).alias(f"avg_{c}") for c in shape.numeric]
    )


def grouped_metrics(processed_df: DataFrame, shape: MartShape) -> DataFrame:
    """``(slice_key, row_count, sum_*, avg_*)`` by the key, whatever the mart kind.

    The star schema needs this even for a count-only mart.
    """
    return processed_df.groupBy(col(shape.key).alias(SLICE_KEY)).agg(*metric_columns(shape))


def mart(processed_df: DataFrame, shape: MartShape | None = None) -> DataFrame:
    """A7 (grouped), A8 (global) or A9 (count only) depending on the columns."""
    shape = shape or mart_shape(processed_df)
    if shape.kind == "grouped":
        return grouped_metrics(processed_df, shape)
    if shape.kind == "global":
        return processed_df.agg(*metric_columns(shape))
    return processed_df.agg(F.count(F.lit(1)).alias(ROW_COUNT))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column."""
    return df.select(col(column)).distinct()
