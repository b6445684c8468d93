"""Ordering operators (L2, L4, L5) and the command-line driver (K7)."""

from __future__ import annotations

import datetime as dt
import json
import os

from strata.operators import trends
from strata.plans import catalog
from strata.plans.warehouse import Warehouse, build_layers


def test_trend_ordering(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 3, 1),), (None,), (dt.date(2023, 1, 5),), (dt.date(2024, 3, 1),)], "d DATE"
    )
    rows = trends.ordered(trends.trends(df, ["d"])).collect()
    grains = [r["grain"] for r in rows]
    assert grains == ["day"] * 3 + ["month"] * 3 + ["year"] * 3
    days = [r["period"] for r in rows if r["grain"] == "day"]
    assert days == [dt.date(2023, 1, 5), dt.date(2024, 3, 1), None]  # NULL bucket last


def test_preview_and_listing_order(spark, tmp_dir):
    wh = Warehouse(spark, root=os.path.join(tmp_dir, "wh"), prefix="ord_")
    run = build_layers(wh, spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), "orders_0001")
    assert run.ok, run.error
    first = catalog.preview(spark, run.tables["processed"], 5, order_by=["o_orderkey"]).collect()
    assert [r["o_orderkey"] for r in first] == [0.0, 1.0, 2.0, 3.0, 4.0]
    cols = catalog.columns(spark, run.tables["processed"]).collect()
    assert [c["ordinal"] for c in cols] == list(range(1, len(cols) + 1))
    listing = [(r["layer"], r["table_name"]) for r in catalog.structure(wh).collect()]
    assert listing == sorted(listing)


def test_cli_writes_json(spark, tmp_dir, readings_path):
    from strata.__main__ import main

    out = os.path.join(tmp_dir, "report")
    main([readings_path, "--out", out, "--job-id", "cli-1"])
    text = spark.read.text(out).collect()
    doc = json.loads(text[0]["value"])
    assert doc["status"] == "ok" and doc["row_count"] == 7
    assert doc["profile"]["datetime_columns"] == ["taken_on"]


def test_inspect_with_awkward_names(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "x INT, y STRING").toDF("we`ird.name", "plain")
    wh = Warehouse(spark, root=os.path.join(tmp_dir, "wh2"), prefix="awk_")
    run = build_layers(wh, df, "awkward_0001")
    assert run.ok, run.error
    rows = {r["table_name"]: r for r in catalog.inspect(wh).collect()}
    assert set(rows) == {r["table_name"] for r in catalog.inspect(wh, slug="awkward_0001").collect()}
    raw = rows["raw_awkward_0001"]
    assert raw["error"] is None and json.loads(raw["sample"][0]) == {"we`ird.name": 1, "plain": "a"}


def test_inspect_reports_a_broken_table(spark, tmp_dir):
    """One table whose files are damaged does not hide the others."""
    import glob

    wh = Warehouse(spark, root=os.path.join(tmp_dir, "wh3"), prefix="brk_")
    run = build_layers(wh, spark.range(5).selectExpr("id", "'a' AS k"), "broken_0001")
    assert run.ok, run.error and run.verification["schemas"]
    for part in glob.glob(os.path.join(wh.location("raw_data", "raw_broken_0001"), "v*", "part-*")):
        with open(part, "wb") as f:
            f.write(b"not parquet")
    spark.catalog.refreshTable(run.tables["raw"])
    rows = {r["table_name"]: r for r in catalog.inspect(wh, slug="broken_0001").collect()}
    assert rows["raw_broken_0001"]["error"] and rows["processed_broken_0001"]["error"] is None
    assert len(rows["processed_broken_0001"]["sample"]) == 5
