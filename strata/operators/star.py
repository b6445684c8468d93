"""Star schema: dimension (W1) and fact (A10) tables; fact-to-dimension join.

Eager aggregation: the fact is the mart by key joined to the dimension —
aggregating *before* the join shuffles one row per key instead of every row.
Because the dimension is exactly the distinct keys of the same processed
table, ``star_schema`` assigns the surrogate ids to the mart rows directly and
splits them into the two tables, so the 1:1 join disappears altogether.
``join_fact`` is the general J1 for a dimension that already exists (a
conformed dimension reused across runs): a shuffle join that AQE converts at run
time where the measured bytes are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.keys import dense_ids
from strata.operators.marts import ROW_COUNT, SLICE_KEY, MartShape

DIM_ID = "dim_id"
CATEGORY_VALUE = "category_value"


def star_schema(grouped: DataFrame, shape: MartShape, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(dimension, fact)`` from the grouped metrics ``(slice_key, row_count, ...)``.

    dimension: ``(dim_id, category_value)``; fact: ``(dim_id, row_count, sum_*, avg_*)``.
    """
    ided = dense_ids(grouped, SLICE_KEY, DIM_ID, partitions)
    dim = ided.select(DIM_ID, F.col(SLICE_KEY).alias(CATEGORY_VALUE))
    fact = ided.select(DIM_ID, ROW_COUNT, *shape.metric_names())
    return dim, fact


def dimension(keys: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """W1 over any frame: distinct values of ``key`` with dense ids."""
    distinct = keys.select(F.col(key).alias(CATEGORY_VALUE)).distinct()
    return dense_ids(distinct, CATEGORY_VALUE, DIM_ID, partitions).select(DIM_ID, CATEGORY_VALUE)


def join_fact(grouped: DataFrame, dim: DataFrame, shape: MartShape) -> DataFrame:
    """J1 + A10: inner equi-join of the per-key metrics to the dimension.

    No hint: Spark decides by the measured bytes of both sides at run time.
    """
    joined = grouped.join(dim, grouped[SLICE_KEY] == dim[CATEGORY_VALUE], "inner")
    return joined.select(DIM_ID, ROW_COUNT, *shape.metric_names())
