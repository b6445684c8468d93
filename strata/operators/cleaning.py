"""Processed layer (T1-T4, A11): standard names, typed NULL fill, full-row DISTINCT.

* strings             -> ``coalesce(value, '(missing)')``
* numbers             -> ``coalesce(double(value), 0.0)``
* everything else     -> text form (booleans, dates, timestamps; JSON for nested)
                         with ``'(missing)'`` for NULL

The DISTINCT runs *after* the fill, so a NULL and a 0 (or ``'(missing)'``) row
merge, which is what defines the processed layer. Spark plans it as a hash
aggregate on all columns with a map-side partial step: a group of copies that
holds a third of all rows is collapsed on every mapper before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import col, standardize_names
from strata.functions.values import as_text
from strata.operators.distinct import LONG_ROW, bytes_a_row, distinct_rows

# Fixed value (reference's placeholder for missing text).
MISSING = "(missing)"


def fill_expression(c: Column, data_type: T.DataType) -> tuple[Column, T.DataType]:
    """T2-T4 for one column; returns the expression and its processed type."""
    if isinstance(data_type, T.StringType):
        return F.coalesce(c, F.lit(MISSING)), T.StringType()
    if isinstance(data_type, T.NumericType):
        return F.coalesce(c.cast("double"), F.lit(0.0)), T.DoubleType()
    return F.coalesce(as_text(c, data_type), F.lit(MISSING)), T.StringType()


def standardized(df: DataFrame) -> DataFrame:
    """The same rows with standard, collision-free column names."""
    return df.toDF(*standardize_names(df.columns))


def processed_columns(df: DataFrame) -> list[Column]:
    names = standardize_names(df.columns)
    out = []
    for f, new in zip(df.schema.fields, names):
        expr, _ = fill_expression(col(f.name), f.dataType)
        out.append(expr.alias(new))
    return out


def processed(df: DataFrame, distinct: bool = True, rows: int | None = None) -> DataFrame:
    """T1-T4 + A11: the processed layer of a raw frame.

    ``rows``: the number of rows, if known; then rows that are long on average
    are told apart by fingerprints (``operators.distinct``), with the same result.
    """
    if not df.columns:
        raise ValueError("Raw table has no columns.")
    out = df.select(*processed_columns(df))
    if not distinct:
        return out
    return distinct_rows(out) if rows and bytes_a_row(df, rows) >= LONG_ROW else out.distinct()
