"""Processed layer, marts, surrogate keys and star schema."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.cleaning import MISSING, processed, standardized
from strata.operators.keys import dense_ids
from strata.operators.marts import grouped_metrics, mart, mart_shape
from strata.operators.star import dimension, join_fact, star_schema
from strata.plans import warehouse
from strata.plans.warehouse import Warehouse, build_layers, reconciliation
from strata.sources.files import folders
from strata.sources.readers import load


def _csv(tmp_dir, name, text):
    path = os.path.join(tmp_dir, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_messy_header_names(spark, tmp_dir):
    raw = ["Region Name", "region-name", "2nd", "", "a", "A", "a_2"]
    df = spark.createDataFrame([tuple(range(7))], ",".join(f"c{i} INT" for i in range(7))).toDF(*raw)
    assert standardized(df).columns == ["region_name", "region_name_2", "c_2nd", "column", "a", "a_2", "a_2_2"]
    # Through the CSV reader Spark itself renames case-insensitive duplicates and
    # empty headers first; the standard names are still unique and valid.
    path = _csv(tmp_dir, "messy.csv", "Region Name,region-name,2nd,,a,A,a_2\n1,2,3,4,5,6,7\n")
    names = standardized(load(spark, path, "csv")).columns
    assert names[:3] == ["region_name", "region_name_2", "c_2nd"]
    assert len(set(names)) == 7 and all(n == n.lower() and " " not in n for n in names)


def test_null_fill_and_distinct(spark, tmp_dir):
    text = "name,amount,when\nx,1,2024-01-01\n,,\nx,1,2024-01-01\n,0,\ny,,2024-01-02\n"
    df = load(spark, _csv(tmp_dir, "nulls.csv", text), "csv")
    p = processed(df)
    rows = sorted(tuple(r) for r in p.collect())
    # the empty row and the (missing, 0, missing) row merge; the copy of x merges
    assert rows == [(MISSING, 0.0, MISSING), ("x", 1.0, "2024-01-01"), ("y", 0.0, "2024-01-02")]
    rec = reconciliation(spark, df, p).first()
    assert (rec["raw_rows"], rec["processed_rows"], rec["duplicates_removed"]) == (5, 3, 2)


def test_mart_forms(spark):
    mixed = spark.createDataFrame([("a", 1, 2.0), ("a", 3, 4.0), ("b", 5, 6.0)], "k STRING, x INT, y DOUBLE")
    m = {r["slice_key"]: r for r in mart(processed(mixed)).collect()}
    assert m["a"]["row_count"] == 2 and m["a"]["sum_x"] == 4.0 and m["a"]["avg_y"] == 3.0
    assert mart(processed(mixed)).columns == ["slice_key", "row_count", "sum_x", "sum_y", "avg_x", "avg_y"]
    numeric = spark.createDataFrame([(1, 2.0), (3, 4.0)], "x INT, y DOUBLE")
    g = mart(processed(numeric)).collect()
    assert len(g) == 1 and g[0]["row_count"] == 2 and g[0]["sum_x"] == 4.0
    strings = spark.createDataFrame([("a",), ("b",), ("a",)], "k STRING")
    c = mart(processed(strings)).collect()
    assert [tuple(r) for r in c] == [(2,)]  # count-only even with a string column (A9)


def test_dense_ids_ranged_equals_window(spark):
    keys = spark.range(0, 5000).select(F.format_string("k%05d", (F.col("id") * 7919) % 5000).alias("key"))
    window = {k: i + 1 for i, k in enumerate(sorted(r["key"] for r in keys.collect()))}
    ranged = dense_ids(keys, "key", partitions=13)
    got = {r["key"]: r["dim_id"] for r in ranged.collect()}
    assert got == window
    assert sorted(got.values()) == list(range(1, 5001))


def test_ranged_plan_has_no_single_partition_window(spark):
    keys = spark.range(0, 3000).select(F.col("id").cast("string").alias("key"))
    ranged = dense_ids(keys, "key", partitions=6)
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    # the only window runs over the per-partition sizes (a handful of rows)
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_star_schema_equals_mart(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    p = processed(df)
    shape = mart_shape(p)
    g = grouped_metrics(p, shape)
    dim, fact = star_schema(g, shape)
    joined = fact.join(dim, "dim_id").select(F.col("category_value").alias("slice_key"), *fact.columns[1:])
    assert joined.exceptAll(mart(p)).count() == 0 and mart(p).exceptAll(joined).count() == 0
    d = [r["dim_id"] for r in dim.collect()]
    assert sorted(d) == list(range(1, len(d) + 1))
    via_join = join_fact(g, dimension(p, shape.key), shape)
    assert via_join.exceptAll(fact).count() == 0 and fact.exceptAll(via_join).count() == 0


def test_build_layers_readings(spark, readings, tmp_dir):
    wh = Warehouse(spark, root=os.path.join(tmp_dir, "wh"), prefix="t_")
    run = build_layers(wh, readings, "station_readings_0001")
    assert run.ok, run.error
    assert run.counts == {"raw": 7, "processed": 6, "duplicates_removed": 1}
    proc = spark.table(run.tables["processed"])
    types = dict(proc.dtypes)
    assert types["taken_on"] == "string" and types["verified"] == "string" and types["reading_id"] == "double"
    fact = spark.table(run.tables["fact"])
    dim = spark.table(run.tables["dimension"])
    rows = {
        r["category_value"]: r
        for r in fact.join(dim, "dim_id").collect()
    }
    assert [rows[k]["dim_id"] for k in ("Dune", "Fjord", "Mesa")] == [1, 2, 3]
    assert [rows[k]["sum_humidity"] for k in ("Dune", "Fjord", "Mesa")] == [45, 115, 170]
    assert rows["Mesa"]["avg_wind_kmh"] == (12.25 + 3.5) / 2
    assert run.verification["analytics"] == sorted(
        ["analytics_station_readings_0001", "dim_station_readings_0001", "fact_station_readings_0001"]
    )


def test_build_layers_reports_failure(spark, tmp_dir):
    wh = Warehouse(spark, root=os.path.join(tmp_dir, "wh2"), prefix="t2_")
    from pyspark.sql import types as T

    empty_cols = spark.createDataFrame([()], T.StructType([]))
    run = build_layers(wh, empty_cols, "nothing_0001")
    assert not run.ok and run.error


def test_a_failing_write_leaves_the_table(spark, tmp_dir):
    wh = Warehouse(spark, root=f"{tmp_dir}/wh", prefix="swap_")
    wh.ensure_layers()
    first, n = wh.replace(spark.range(5), "processed", "t")
    assert n == 5 and first.count() == 5
    broken = spark.range(10).withColumn("id", F.expr("CASE WHEN id > 7 THEN raise_error('no') ELSE id END").cast("long"))
    with pytest.raises(Exception, match="no"):
        wh.write(broken, "processed", "t")
    assert [r[0] for r in spark.table("swap_processed.t").orderBy("id").collect()] == [0, 1, 2, 3, 4]
    again, n = wh.replace(spark.table("swap_processed.t").filter("id > 2"), "processed", "t")  # reads what it replaces
    assert n == 2 == again.count() and sorted(r[0] for r in again.collect()) == [3, 4]
    other, n = wh.replace(spark.range(3).selectExpr("id AS n", "'x' AS s"), "processed", "t")  # other columns
    assert n == 3 and other.columns == ["n", "s"] == spark.table("swap_processed.t").columns
    none, n = wh.replace(other.filter("n > 9"), "processed", "t")
    assert n == 0 == none.count() and none.columns == ["n", "s"]
    assert first.count() == 5  # a reader that has the old files


def test_replaced_versions_go_after_a_while(spark, tmp_dir, monkeypatch):
    wh = Warehouse(spark, root=f"{tmp_dir}/wh", prefix="old_")
    wh.ensure_layers()
    for n in (1, 2, 3):
        wh.write(spark.range(n), "processed", "t")
    home = wh.location("processed", "t")
    assert len(folders(spark, home)) == 3
    monkeypatch.setattr(warehouse, "KEEP_VERSIONS_NS", 0)
    assert wh.replace(spark.range(4), "processed", "t")[1] == 4
    assert len(folders(spark, home)) == 1 and spark.table("old_processed.t").count() == 4


def test_layers_are_counted_while_they_are_written(spark, readings, tmp_dir):
    wh = Warehouse(spark, root=f"{tmp_dir}/wh", prefix="obs_")
    run = build_layers(wh, readings, "r")
    assert run.ok, run.error
    raw, proc = (spark.table(run.tables[t]).count() for t in ("raw", "processed"))
    assert run.counts == {"raw": raw, "processed": proc, "duplicates_removed": raw - proc}
