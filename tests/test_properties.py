"""Invariants on randomised frames (NULLs, duplicates, mixed types)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.cleaning import processed
from strata.operators.marts import grouped_metrics, mart, mart_shape
from strata.operators.star import star_schema
from strata.plans.analytics import analyze

row = st.tuples(
    st.one_of(st.none(), st.integers(-5, 5)),
    st.one_of(st.none(), st.sampled_from(["a", "b", "c", "long text value", ""])),
    st.one_of(st.none(), st.floats(-3, 3, allow_nan=False).map(lambda x: round(x, 1))),
    st.one_of(st.none(), st.dates(dt.date(2023, 12, 20), dt.date(2024, 2, 10))),
)
frames = st.lists(row, min_size=1, max_size=40).map(lambda rows: rows + rows[: len(rows) // 3])

SCHEMA = "n INT, s STRING, x DOUBLE, d DATE"


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(frames)
def test_analytics_invariants(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    res = analyze(df, categorical_max_distinct=3)
    n = len(rows)
    assert res.row_count == n
    for r in res.top_values.groupBy("column_name").agg(F.sum("count").alias("s"), F.max("rank").alias("k")).collect():
        assert r["s"] <= n and r["k"] <= 10
    sums = {r["grain"]: r["s"] for r in res.trends.groupBy("grain").agg(F.sum("count").alias("s")).collect()}
    assert sums == {"day": n, "month": n, "year": n}
    counts = {r["column_name"]: r["count"] for r in res.numeric_stats.collect()}
    for c in res.profile.numeric:
        assert counts[c] == sum(1 for r in rows if r[["n", "s", "x", "d"].index(c)] is not None)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(frames)
def test_warehouse_invariants(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    p = processed(df)
    assert p.count() <= df.count()
    shape = mart_shape(p)
    m = mart(p, shape)
    assert m.agg(F.sum("row_count")).first()[0] == p.count()
    g = grouped_metrics(p, shape)

    def rounded(frame):  # partial sums merge in arrival order: compare at 1e-6
        return frame.select(*[F.round(c, 6).alias(c) if c.startswith(("sum_", "avg_")) else c for c in frame.columns])

    for limit in (1, 5):  # ranges
        dim, fact = star_schema(g, shape, partitions=limit)
        ids = sorted(r["dim_id"] for r in dim.collect())
        assert ids == list(range(1, len(ids) + 1))
        joined = rounded(fact.join(dim, "dim_id").select(F.col("category_value").alias("slice_key"), *fact.columns[1:]))
        assert joined.exceptAll(rounded(m)).count() == 0 and rounded(m).exceptAll(joined).count() == 0
