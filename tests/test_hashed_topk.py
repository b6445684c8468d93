"""The hash-first top-k strategy returns exactly the plain plan's rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.operators.frequency import top_values
from strata.operators.hashed_topk import hashed_top_values
from tests.conftest import SF0001, SF001


def _rows(df):
    return sorted(tuple(r) for r in df.select("position", "column_name", "rank", "value", "count").collect())


def _check(df, columns, **kwargs):
    expected = _rows(top_values(df, columns, 10))
    got = _rows(hashed_top_values(df, columns, 10, **kwargs))
    assert got == expected


@pytest.mark.parametrize(
    "table, columns",
    [
        ("documents", ["text", "lang", "source"]),
        ("pages", ["url", "html"]),
        ("conversations", ["role", "text"]),
        ("orders", ["o_orderstatus", "o_orderpriority"]),
    ],
)
def test_bounded_path_matches(spark, table, columns):
    _check(spark.read.parquet(f"{SF001}/{table}.parquet"), columns)


def test_unique_tail_path_matches(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    # a tiny bound forces the unique-tail path for the near-unique text column
    _check(docs, ["text", "lang"], candidate_bound=5)
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    _check(pages, ["url", "html"], candidate_bound=1)


def test_fallback_on_ties_and_collisions(spark):
    df = spark.createDataFrame(
        [(f"v{i % 37}", None if i % 11 == 0 else f"w{i % 5}") for i in range(400)], "a STRING, b STRING"
    )
    _check(df, ["a", "b"], candidate_bound=0)  # ties above the bound -> plain plan
    _check(df, ["a", "b"], hash_fn=lambda c: F.lit(7).cast("bigint"))  # every value collides


def test_nulls_and_small_columns(spark):
    df = spark.createDataFrame([(None, "x"), (None, "y"), ("a", None)], "a STRING, b STRING")
    _check(df, ["a", "b"])
    _check(df, ["a", "b"], candidate_bound=0)


def test_method_option(spark):
    df = spark.read.parquet(f"{SF0001}/orders.parquet")
    assert _rows(top_values(df, ["o_orderstatus"], 10, method="hashed")) == _rows(top_values(df, ["o_orderstatus"], 10))
    with pytest.raises(ValueError):
        top_values(df, ["o_orderstatus"], 10, method="nope")


def test_auto_method_mixes_strategies(spark):
    from strata.plans.analytics import analyze

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    res = analyze(docs, topk_method="auto")
    assert res.profile.text_lengths["text"] >= 512 and res.profile.text_lengths["lang"] < 512
    assert _rows(res.top_values) == _rows(analyze(docs).top_values)
