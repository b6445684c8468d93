"""Frequency counts and top-k values (A3, L1) for many columns in one shuffle.

Plan: unpivot every categorical column into ``(column, value)`` (an ``Expand``
in the same codegen stage as the scan) -> ``groupBy(column, value).count()``
with map-side partial counts -> ``row_number`` per column with ``<= k``.
Catalyst inserts a *partial* ``WindowGroupLimit`` before the per-column
exchange, so only k rows per column and partition cross the second shuffle.
A hot value (a third of all rows) is collapsed by the partial count on each
mapper, and the first shuffle is keyed on ``(column, value)`` — never on the
column alone.

Ties are broken by value (ascending, NULL last), so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.naming import col
from strata.functions.values import as_text

DEFAULT_TOP_K = 10  # fixed default (reference's top-k)

TOP_SCHEMA = "position INT, column_name STRING, rank INT, value STRING, count BIGINT"


def unpivot_text(df: DataFrame, columns: list[str], positions: list[int] | None = None) -> DataFrame:
    """``(position, column, value)`` rows: each listed column's value as text.

    ``positions`` (1-based) default to the order of ``columns``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    positions = positions or list(range(1, len(columns) + 1))
    entries = [
        F.struct(
            F.lit(p).alias("position"),
            F.lit(c).alias("column_name"),
            as_text(col(c), types[c]).alias("value"),
        )
        for p, c in zip(positions, columns)
    ]
    return df.select(F.inline(F.array(*entries)))


def value_counts(df: DataFrame, columns: list[str], positions: list[int] | None = None) -> DataFrame:
    """A3: ``(position, column, value, count)`` for every distinct value, NULL included."""
    return (
        unpivot_text(df, columns, positions)
        .groupBy("position", "column_name", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def top_k(counts: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """L1 over value counts: the k most frequent values per column."""
    w = Window.partitionBy("position", "column_name").orderBy(
        F.col("count").desc(), F.col("value").asc_nulls_last()
    )
    return (
        counts.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("position", "column_name", "rank", "value", "count")
    )


# Average value length (characters) from which ``method="auto"`` counts a
# column hash-first.
LONG_TEXT = 512


def top_values(
    df: DataFrame,
    columns: list[str],
    k: int = DEFAULT_TOP_K,
    method: str = "auto",
    text_lengths: dict[str, float] | None = None,
) -> DataFrame:
    """A3 + L1: ``(position, column, rank, value, count)``.

    ``method="hashed"`` counts hashes first and fetches exact counts only for
    the values that can reach the top k (``operators.hashed_topk``): same
    result, far less shuffle for long, nearly unique texts. ``method="auto"``
    does that only for columns whose sampled average length (``text_lengths``,
    from the profile probe) is at least ``LONG_TEXT``.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], TOP_SCHEMA)
    if method not in ("exact", "hashed", "auto"):
        raise ValueError(f"unknown top-k method: {method}")
    positions = list(range(1, len(columns) + 1))
    if method == "exact":
        return top_k(value_counts(df, columns), k)
    lengths = text_lengths or {}
    long_cols = [
        (p, c) for p, c in zip(positions, columns) if method == "hashed" or lengths.get(c, 0) >= LONG_TEXT
    ]
    short_cols = [(p, c) for p, c in zip(positions, columns) if (p, c) not in long_cols]
    from strata.operators.hashed_topk import hashed_top_values

    parts = []
    if long_cols:
        parts.append(hashed_top_values(df, [c for _, c in long_cols], k, positions=[p for p, _ in long_cols]))
    if short_cols:
        parts.append(top_k(value_counts(df, [c for _, c in short_cols], [p for p, _ in short_cols]), k))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
