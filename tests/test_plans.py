"""Plan properties: job count independent of column count, pruning, partial aggregation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators.profile import build_profile
from strata.plans.analytics import analyze


def _jobs(spark, fn) -> int:
    sc = spark.sparkContext
    group = uuid.uuid4().hex
    sc.setJobGroup(group, "count jobs")
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def _frame(spark, width):
    base = spark.range(0, 2000)
    cols = []
    for i in range(width):
        if i % 3 == 0:
            cols.append((F.col("id") * (i + 1)).alias(f"num{i}"))
        elif i % 3 == 1:
            cols.append((F.col("id") % 7).cast("string").alias(f"cat{i}"))
        else:
            cols.append(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias(f"day{i}"))
    return base.select(*cols)


def _analysis_jobs(spark, width):
    df = _frame(spark, width)

    def run():
        res = analyze(df)
        res.top_values.collect()
        res.trends.collect()
        res.numeric_stats.collect()

    return _jobs(spark, run)


def test_job_count_does_not_grow_with_columns(spark):
    narrow = _analysis_jobs(spark, 6)
    wide = _analysis_jobs(spark, 60)
    assert wide == narrow, (narrow, wide)


def test_profile_scan_prunes_columns(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    res = analyze(df)
    plan = res.trends._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan
    top_plan = res.top_values._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in top_plan.split("ReadSchema:")[1].split("\n")[0]


def test_frequency_has_partial_aggregation_and_group_limit(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    res = analyze(df)
    plan = res.top_values._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert "WindowGroupLimit" in plan


def test_lookup_is_partition_pruned_and_filter_pushed(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").filter(F.col("o_orderkey") == 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,5)]" in plan


def test_profile_reclassification_skips_high_cardinality_exact_pass(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    prof = build_profile(df)
    # keys with thousands of values never reach the exact count_distinct pass
    assert prof.columns[0].distinct_count is None
    assert {c.name for c in prof.columns if c.distinct_count is not None} >= {"l_linenumber", "l_quantity"}


def _hot(spark, n=30_000):
    """A third of all rows are copies of one row (one hot key / value / group)."""
    hot = spark.range(0, n // 3).select(F.lit("hot").alias("k"), F.lit(1.0).alias("v"))
    rest = spark.range(0, n - n // 3).select(
        F.concat(F.lit("k"), (F.col("id") % 1000).cast("string")).alias("k"), F.col("id").cast("double").alias("v")
    )
    return hot.unionByName(rest)


def test_hot_group_of_copies_is_collapsed_before_the_shuffle(spark):
    from strata.operators.cleaning import processed
    from strata.operators.marts import mart

    df = _hot(spark)
    p = processed(df)
    plan = p._jdf.queryExecution().executedPlan().toString()
    # partial aggregation (map side) precedes the exchange of the DISTINCT
    assert plan.index("Exchange hashpartitioning") < plan.rindex("HashAggregate")
    assert p.filter(F.col("k") == "hot").count() == 1
    m = {r["slice_key"]: r["row_count"] for r in mart(p).collect()}
    assert m["hot"] == 1 and sum(m.values()) == p.count()


def test_hot_value_in_frequency_and_trends(spark):
    df = _hot(spark).withColumn("d", F.when(F.col("k") == "hot", F.lit("2024-01-01").cast("date")).otherwise(F.lit("2024-02-01").cast("date")))
    res = analyze(df)
    top = res.top_values.filter((F.col("column_name") == "k") & (F.col("rank") == 1)).first()
    assert (top["value"], top["count"]) == ("hot", 10_000)
    plan = res.top_values._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    days = {r["period"]: r["count"] for r in res.trends.filter("grain = 'day'").collect()}
    assert days[__import__("datetime").date(2024, 1, 1)] == 10_000


def test_wide_summary_is_chunked(spark):
    from strata.operators.summary import numeric_summary

    df = spark.range(0, 100).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(7)])
    rows = numeric_summary(df, df.columns, chunk=3).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(1, 8))
    assert [r["mean"] for r in rows] == [49.5 + i for i in range(7)]


def test_narrow_inputs_are_spread_before_the_raw_write(spark):
    from strata.plans.warehouse import spread_if_narrow

    narrow = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").coalesce(1)
    plan = spread_if_narrow(narrow)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in plan
    wide = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert "RoundRobinPartitioning" not in spread_if_narrow(wide)._jdf.queryExecution().executedPlan().toString()
