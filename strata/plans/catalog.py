"""Catalog views of the warehouse (C1-C3) and previews.

All answers are DataFrames. Column and table listings are catalog metadata
(one row per column or table); samples are ``limit`` scans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.naming import col
from strata.plans.warehouse import LAYERS, Warehouse

COLUMNS_SCHEMA = "ordinal INT, column_name STRING, data_type STRING"


def columns(spark: SparkSession, table: str) -> DataFrame:
    """``(ordinal, column_name, data_type)`` of a table, in schema order."""
    rows = [
        (i + 1, f.name, f.dataType.simpleString())
        for i, f in enumerate(spark.table(table).schema.fields)
    ]
    return spark.createDataFrame(rows, COLUMNS_SCHEMA)


def structure(wh: Warehouse) -> DataFrame:
    """``(layer, table_name)`` for every layer database, sorted by name."""
    rows = [(layer, t) for layer in LAYERS for t in wh.tables(layer)]
    return wh.spark.createDataFrame(rows, "layer STRING, table_name STRING").orderBy(
        "layer", "table_name"
    )


def preview(spark: SparkSession, table: str, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """L4: first ``n`` rows; ordered first when ``order_by`` is given (top-n sort)."""
    df = spark.table(table)
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


INSPECT_SCHEMA = "layer STRING, table_name STRING, columns STRING, sample ARRAY<STRING>, error STRING"


def inspect(wh: Warehouse, sample_rows: int = 5, layer: str | None = None, slug: str | None = None) -> DataFrame:
    """One row per table: ``(layer, table_name, columns, sample, error)``.

    ``columns`` is ``name: type`` text in schema order; ``sample`` holds up to
    ``sample_rows`` rows as JSON. All samples are read by one job; if it fails,
    each table is read on its own, so one that cannot be read reports its error
    and the others their rows. ``layer`` and ``slug`` choose the tables before
    anything is read.
    """
    rows, readers = [], {}
    for name in [layer] if layer else LAYERS:
        for t in wh.tables(name, slug):
            row = {"layer": name, "table_name": t, "columns": None, "sample": [], "error": None}
            try:
                df = wh.spark.table(f"{wh.db(name)}.{t}")
                row["columns"] = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in df.schema.fields)
                texts = F.to_json(F.struct(*[col(c) for c in df.columns])).alias("text")
                readers[len(rows)] = df.limit(sample_rows).select(F.lit(len(rows)).alias("at"), texts)
            except Exception as exc:  # per-table failure is part of the report
                row["error"] = str(exc)
            rows.append(row)
    for at, text, error in _samples(readers):
        if error:
            rows[at]["error"] = error
        else:
            rows[at]["sample"].append(text)
    return wh.spark.createDataFrame([tuple(r.values()) for r in rows], INSPECT_SCHEMA)


def _samples(readers: dict[int, DataFrame]) -> list[tuple[int, str | None, str | None]]:
    """(table, row as text, error) of all samples, at most ``sample_rows`` a table."""
    if not readers:
        return []
    try:
        return [(r["at"], r["text"], None) for r in reduce(DataFrame.union, readers.values()).collect()]
    except Exception as exc:
        if len(readers) == 1:
            return [(next(iter(readers)), None, str(exc))]
        return [found for at, df in readers.items() for found in _samples({at: df})]
