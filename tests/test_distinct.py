"""DISTINCT by fingerprints gives the rows of DISTINCT, and shuffles texts only where they repeat."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from strata.operators import distinct
from strata.operators.cleaning import processed
from tests.conftest import SF001


def _rows(frame):
    return sorted(map(str, frame.collect()))


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_equals_distinct(spark, bound):
    rows = [(i % 7, None if i % 3 else "", (0.0, -0.0, float("nan"))[i % 3], "x" * (i % 5), i % 2 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "`a.b` INT, `c d` STRING, d DOUBLE, e STRING, f BOOLEAN").repartition(5)
    assert _rows(distinct.distinct_rows(df, bound)) == _rows(df.distinct())
    docs = spark.read.parquet(f"{SF001}/documents.parquet").drop("doc_id")
    hot = docs.unionByName(docs.limit(1).crossJoin(spark.range(500)).drop("id"))
    got = distinct.distinct_rows(hot, bound)
    assert got.count() == hot.distinct().count() == got.distinct().count()


def test_nulls_are_no_empty_values(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("", ""), (None, "a")], "x STRING, y STRING")
    assert distinct.distinct_rows(df).count() == 4
    assert distinct.distinct_rows(df.filter("false")).count() == 0


def test_collisions_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(distinct, "_fingerprint", lambda df: [F.lit(1).cast("long").alias("_f1"), F.lit(2).cast("long").alias("_f2")])
    df = spark.range(50).select((F.col("id") % 9).alias("x"))
    assert _rows(distinct.distinct_rows(df)) == _rows(df.distinct())


def test_texts_are_shuffled_only_where_they_repeat(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")  # ids differ: no row repeats
    plan = distinct.distinct_rows(docs)._jdf.queryExecution().executedPlan().toString()
    anti = re.search(r"LeftAnti[^\n]*", plan)
    assert "BroadcastHashJoin" in plan and anti and plan.count("Exchange hashpartitioning") == 1  # of the repeated rows


def test_processed_chooses_by_the_length_of_a_row(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    assert distinct.bytes_a_row(docs, docs.count()) >= distinct.LONG_ROW > distinct.bytes_a_row(orders, orders.count())
    long = processed(docs, rows=docs.count())
    assert "LeftAnti" in long._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in processed(orders, rows=orders.count())._jdf.queryExecution().executedPlan().toString()
    assert _rows(long) == _rows(processed(docs))
