"""Profiling (P1-P5) and adaptive analytics (A1-A6, L1, F1) on hand-made fixtures."""

from __future__ import annotations

import datetime as dt
import statistics
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.profile import build_profile, capped_distinct, date_evidence, holds_dates, validate_minimum_schema
from strata.plans.analytics import analyze


def test_readings_profile(readings):
    prof = build_profile(readings)
    assert prof.numeric == []
    assert prof.categorical == ["station", "sky", "reading_id", "humidity", "wind_kmh"]
    assert prof.datetime == ["taken_on"] and prof.boolean == ["verified"]
    assert prof.row_count == 7


def test_readings_top_values(readings):
    top = {}
    for r in sorted(analyze(readings).top_values.collect(), key=lambda r: r["rank"]):
        top.setdefault(r["column_name"], []).append((r["value"], r["count"]))
    assert top["station"] == [("Mesa", 3), ("Dune", 2), ("Fjord", 2)]
    assert top["sky"] == [("clear", 3), ("rain", 2), ("snow", 2)]
    assert top["humidity"][0] == ("90", 2)
    assert top["wind_kmh"][0] == ("3.5", 3) and top["wind_kmh"][-1] == (None, 1)  # NULL last among ties


def test_readings_trends(readings):
    grains = {"day": {}, "month": {}, "year": {}}
    for r in analyze(readings).trends.collect():
        grains[r["grain"]][r["period"]] = r["count"]
    assert grains["day"] == {
        dt.date(2023, 11, 30): 2, dt.date(2023, 12, 1): 1, dt.date(2023, 12, 31): 1, dt.date(2024, 1, 1): 2, None: 1,
    }
    assert grains["month"] == {dt.date(2023, 11, 1): 2, dt.date(2023, 12, 1): 2, dt.date(2024, 1, 1): 2, None: 1}
    assert grains["year"] == {dt.date(2023, 1, 1): 4, dt.date(2024, 1, 1): 2, None: 1}


def test_readings_stats_without_reclassification(readings):
    stats = {r["column_name"]: r for r in analyze(readings, categorical_max_distinct=0).numeric_stats.collect()}
    values = {
        "reading_id": [11, 12, 13, 14, 15, 15, 16],
        "humidity": [40, 80, 75, 20, 90, 90, 25],
        "wind_kmh": [3.5, 12.25, 7.0, 3.5, 3.5, 20.0],
    }
    assert set(stats) == set(values)
    for name, v in values.items():
        r = stats[name]
        assert (r["count"], r["min"], r["max"]) == (len(v), min(v), max(v))
        assert r["mean"] == pytest.approx(statistics.fmean(v)) and r["stddev_pop"] == pytest.approx(statistics.pstdev(v))


def test_late_dates_promote_a_text_column(spark):
    """Every row counts, wherever the first date stands."""
    n = 2000
    late = spark.range(n).selectExpr("id", f"CASE WHEN id >= {n - 5} THEN '2024-02-0' || (id % 5 + 1) END AS t")
    assert build_profile(late).datetime == build_profile(late.orderBy("id", ascending=False)).datetime == ["t"]
    assert build_profile(late.coalesce(1).orderBy("id"), sample_rows=100).datetime == []


def test_analyze_summary_matches_operator(spark):
    from strata.operators.summary import numeric_summary

    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    res = analyze(df)
    got = {r["column_name"]: tuple(r)[2:] for r in res.numeric_stats.collect()}
    direct = {r["column_name"]: tuple(r)[2:] for r in numeric_summary(df, res.profile.numeric).collect()}
    assert got.keys() == direct.keys() == set(res.profile.numeric)
    for k in got:
        assert got[k] == pytest.approx(direct[k])


def test_string_datetime_promotion(spark):
    values = ["2024-01-05", "2024", "12:30", "T12", "5", "20240105", "01/05/2024", "North", ""]
    df = spark.createDataFrame([(v, v) for v in values], "s STRING, t STRING")
    only = [spark.createDataFrame([(v,)], "s STRING") for v in values]
    promoted = {v: build_profile(d).datetime == ["s"] for v, d in zip(values, only)}
    # Year-first text parses; time-only text (today's date in Spark) never counts.
    assert promoted == {
        "2024-01-05": True, "2024": True, "12:30": False, "T12": False, "5": False,
        "20240105": False, "01/05/2024": False, "North": False, "": False,
    }
    assert build_profile(df).datetime == ["s", "t"]  # one parsable value is enough
    assert build_profile(df, min_fraction=0.5).datetime == []


def _distinct_frame(spark, n_distinct, with_null=False):
    rows = [(i % n_distinct,) for i in range(n_distinct * 3)]
    if with_null:
        rows.append((None,))
    return spark.createDataFrame(rows, "x INT")


@pytest.mark.parametrize(
    "n, with_null, role",
    [(199, False, "categorical"), (200, False, "categorical"), (201, False, "numeric"), (200, True, "numeric"), (199, True, "categorical")],
)
def test_low_cardinality_boundary(spark, n, with_null, role):
    prof = build_profile(_distinct_frame(spark, n, with_null))
    assert prof.role_of("x") == role


def test_exact_mode_matches_prefiltered(spark):
    df = _distinct_frame(spark, 150)
    assert build_profile(df, exact=True).categorical == build_profile(df).categorical == ["x"]


def test_empty_and_columnless_frames(spark):
    empty = spark.createDataFrame([], "x INT, s STRING")
    prof = build_profile(empty)
    assert prof.numeric == ["x"] and prof.categorical == ["s"] and prof.row_count == 0
    res = analyze(empty)
    assert res.status == "ok" and res.row_count == 0
    assert res.top_values.count() == 0
    none = spark.createDataFrame([()], T.StructType([]))
    prof = build_profile(none)
    assert validate_minimum_schema(prof) == (False, ["Dataset has no columns."])
    assert analyze(none).status == "error"


def test_type_roles(spark):
    schema = T.StructType(
        [
            T.StructField("d", T.DecimalType(10, 2)),
            T.StructField("b", T.BooleanType()),
            T.StructField("a", T.ArrayType(T.IntegerType())),
            T.StructField("m", T.MapType(T.StringType(), T.IntegerType())),
            T.StructField("s", T.StructType([T.StructField("x", T.IntegerType())])),
            T.StructField("ts", T.TimestampType()),
            T.StructField("dt", T.DateType()),
        ]
    )
    rows = [
        (decimal.Decimal(i) / 4, i % 2 == 0, [i], {"k": i}, (i,), dt.datetime(2024, 1, 1 + i % 28), dt.date(2024, 2, 1))
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, schema)
    prof = build_profile(df)
    assert prof.numeric == ["d"]
    assert prof.boolean == ["b"]
    assert prof.categorical == ["a", "m", "s"]
    assert prof.datetime == ["ts", "dt"]
    res = analyze(df, include_booleans=True)
    top = {r["column_name"] for r in res.top_values.collect()}
    assert top == {"a", "m", "s", "b"}
    json_form = res.top_values.filter(F.col("column_name") == "m").first()["value"]
    assert json_form.startswith('{"k":')


def test_null_date_bucket(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1),), (None,), (dt.date(2024, 1, 2),), (None,)], "d DATE"
    )
    res = analyze(df)
    rows = {(r["grain"], r["period"]): r["count"] for r in res.trends.collect()}
    assert rows[("day", None)] == 2 and rows[("month", None)] == 2 and rows[("year", None)] == 2


def test_negative_zero_is_one_group(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.5,)], "x DOUBLE")
    res = analyze(df)
    got = {(r["value"], r["count"]) for r in res.top_values.collect()}
    assert got == {("0.0", 2), ("1.5", 1)}


def test_invariants(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    res = analyze(df)
    n = res.row_count
    per_col = res.top_values.groupBy("column_name").agg(F.sum("count").alias("s")).collect()
    assert all(r["s"] <= n for r in per_col)
    sums = {r["grain"]: r["s"] for r in res.trends.groupBy("grain").agg(F.sum("count").alias("s")).collect()}
    assert sums == {"day": n, "month": n, "year": n}
    assert res.top_values.groupBy("column_name").count().filter("count > 10").count() == 0


def _texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s STRING")


def test_a_stray_date_does_not_change_a_role(spark):
    assert build_profile(_texts(spark, ["2024-01-05"] + [f"item {i}" for i in range(999)])).categorical == ["s"]
    late = [None] * 500 + [""] * 400 + [f"2024-01-{1 + i % 28:02d}" for i in range(100)]
    assert build_profile(_texts(spark, late)).datetime == ["s"]
    some = ["pending"] * 80 + [f"2024-01-{1 + i % 28:02d}T10:00:00" for i in range(20)]
    assert build_profile(_texts(spark, some)).datetime == ["s"]
    # Codes some of which look like years are no dates; a column of years is.
    assert build_profile(_texts(spark, [str(i) for i in range(900, 2100)])).categorical == ["s"]
    assert build_profile(_texts(spark, [str(i) for i in range(1900, 2020)])).datetime == ["s"]


def test_date_evidence_counts_by_format(spark):
    values = ["2024-01-05", " 2024-1-5", "2024-01-05 10:11:12", "2024-02", "2024", "20240105", "x", "", None]
    ((hits, filled, present, length),) = date_evidence(_texts(spark, values), ["s"]).values()
    assert hits == {"day": 2, "moment": 1, "month": 1, "year": 1, "other": 0}
    assert (filled, present) == (7, 8) and length == pytest.approx(sum(len(v or "") for v in values) / 8)
    assert not holds_dates({"day": 3, "moment": 3, "other": 3}, 100) and holds_dates({"day": 6, "moment": 3}, 100)


def test_capped_distinct_is_one_pass_and_exact(spark):
    rows = [(i % 200, float(i % 201), None if i % 3 else decimal.Decimal(i % 5), (0.0, -0.0, float("nan"))[i % 3], i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a INT, b DOUBLE, c DECIMAL(9,2), d DOUBLE, e BIGINT").repartition(7)
    n, found = capped_distinct(df, df.columns, 200)
    assert n == 3000
    assert found == {"a": (0, 200), "b": (0, None), "c": (2000, 5), "d": (0, 2), "e": (0, None)}
    assert capped_distinct(df.filter("false"), df.columns, 200) == (0, {c: (0, 0) for c in df.columns})
    group = "capped-distinct"
    spark.sparkContext.setJobGroup(group, group)
    capped_distinct(df, df.columns, 200)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    assert 1 <= len(jobs) <= 4  # stages of one query under adaptive execution
