"""Sources (S1-S8), run history (K6, T7), the upload job (F4), reports
and the continuous intake (F6)."""

from __future__ import annotations

import datetime as dt
import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from strata.plans import report
from strata.plans.analytics import analyze
from strata.plans.runs import RunHistory, run_job, run_record
from strata.plans.warehouse import Warehouse
from strata.sources.excel import read_excel, workbook_bytes
from strata.sources.manifest import list_files, manifest
from strata.sources.json_layout import document_files
from strata.sources.readers import load
from strata.streaming.intake import Intake, Ledger, run_intake


def _write(path, data, mode="w"):
    with open(path, mode) as f:
        f.write(data)
    return path


def test_json_layouts(spark, tmp_dir):
    lines = _write(os.path.join(tmp_dir, "l.json"), '{"a": 1}\n{"a": 2}\n{"a": 3}\n')
    array = _write(os.path.join(tmp_dir, "arr.json"), '[\n {"a": 1},\n {"a": 2}\n]\n')
    doc = _write(os.path.join(tmp_dir, "doc.json"), '{\n "a": 7\n}\n')
    assert [p.split("/")[-1] for p in document_files(spark, f"{tmp_dir}/*.json")] == ["arr.json", "doc.json"]
    assert sorted(r["a"] for r in load(spark, f"{tmp_dir}/*.json", "json").collect()) == [1, 1, 2, 2, 3, 7]
    assert load(spark, lines, "json").count() == 3  # all records, not only the first (D1)
    assert sorted(r["a"] for r in load(spark, array, "json").collect()) == [1, 2]
    assert load(spark, doc, "json").first()["a"] == 7


def _two_sheet_workbook() -> bytes:
    """Two sheets, shared strings, a date serial and empty cells (hand-written XML)."""
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pkg = "http://schemas.openxmlformats.org/package/2006/relationships"
    sheet1 = (
        f'<worksheet xmlns="{ns}"><sheetData>'
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c></row>'
        '<row r="2"><c r="A2" t="s"><v>3</v></c><c r="B2"><v>3</v></c><c r="C2" s="1"><v>45296</v></c></row>'
        '<row r="3"><c r="A3" t="s"><v>4</v></c><c r="C3" s="1"><v>45297.5</v></c></row>'
        '<row r="4"><c r="A4" t="s"><v>3</v></c><c r="B4"><v>2.5</v></c></row>'
        "</sheetData></worksheet>"
    )
    sheet2 = f'<worksheet xmlns="{ns}"><sheetData><row r="1"><c r="A1"><v>99</v></c></row></sheetData></worksheet>'
    shared = (
        f'<sst xmlns="{ns}"><si><t>region</t></si><si><t>qty</t></si><si><t>when</t></si>'
        "<si><t>North</t></si><si><r><t>So</t></r><r><t>uth</t></r></si></sst>"
    )
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets>'
        '<sheet name="Data" sheetId="1" r:id="rId1"/><sheet name="Other" sheetId="2" r:id="rId2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{pkg}">'
        '<Relationship Id="rId1" Type="x" Target="worksheets/sheet1.xml"/>'
        '<Relationship Id="rId2" Type="x" Target="worksheets/sheet2.xml"/></Relationships>',
        "xl/sharedStrings.xml": shared,
        "xl/styles.xml": f'<styleSheet xmlns="{ns}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": sheet1,
        "xl/worksheets/sheet2.xml": sheet2,
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for k, v in parts.items():
            z.writestr(k, v)
    return buf.getvalue()


def test_excel_reader(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "book.xlsx"), _two_sheet_workbook(), "wb")
    df = read_excel(spark, path)
    assert df.columns == ["region", "qty", "when"]
    assert dict(df.dtypes) == {"region": "string", "qty": "double", "when": "timestamp"}
    rows = sorted((r["region"], r["qty"], r["when"]) for r in df.collect())
    assert rows == [
        ("North", 2.5, None),
        ("North", 3.0, dt.datetime(2024, 1, 5)),
        ("South", None, dt.datetime(2024, 1, 6, 12)),
    ]


def test_excel_round_trip_and_empty(spark, tmp_dir):
    path = _write(
        os.path.join(tmp_dir, "rt.xlsx"),
        workbook_bytes(["id", "name", "ok"], [[1, "a", True], [2, "b", False]]),
        "wb",
    )
    df = read_excel(spark, path)
    assert dict(df.dtypes) == {"id": "bigint", "name": "string", "ok": "boolean"}
    assert sorted(tuple(r) for r in df.collect()) == [(1, "a", True), (2, "b", False)]
    empty = _write(os.path.join(tmp_dir, "empty.xlsx"), workbook_bytes(["id", "name"], []), "wb")
    with pytest.raises(ValueError, match="no rows"):
        read_excel(spark, empty)


def test_manifest(spark, tmp_dir):
    land = os.path.join(tmp_dir, "land")
    os.makedirs(os.path.join(land, "sub"))
    _write(os.path.join(land, "a.csv"), "x\n1\n")
    _write(os.path.join(land, "sub", "b.json"), '{"x": 1}\n')
    _write(os.path.join(land, "c.txt"), "hello")
    _write(os.path.join(land, "noext"), "PAR1xxxx", "w")
    _write(os.path.join(land, "big.csv"), "x\n" + "1\n" * 600)
    m = {r["name"]: r for r in manifest(list_files(spark, land), max_bytes=1000).collect()}
    assert m["a.csv"]["accepted"] and m["a.csv"]["format"] == "csv"
    assert m["b.json"]["accepted"] and m["b.json"]["format"] == "json"
    assert not m["c.txt"]["accepted"]
    assert m["noext"]["format"] == "parquet" and m["noext"]["reject_reason"] == "File must have an extension."
    assert m["big.csv"]["reject_reason"] == "File exceeds 0 MB limit"
    assert m["a.csv"]["slug"].startswith("a_") and len(m["a.csv"]["job_id"]) == 36


def test_run_history_upsert_and_lookup(spark, tmp_dir):
    h = RunHistory(spark, os.path.join(tmp_dir, "hist"))
    assert h.lookup("none").count() == 0
    h.upsert(run_record(spark, "j1", "a.csv", "csv", "file:/a.csv", "ok", None, 3))
    h.upsert(run_record(spark, "j2", "b.csv", "csv", "file:/b.csv", "ok", None, 5))
    h.upsert(run_record(spark, "j1", "a.csv", "csv", "file:/a.csv", "error", None, 4))
    runs = {r["job_id"]: r for r in h.runs().collect()}
    assert set(runs) == {"j1", "j2"} and runs["j1"]["status"] == "error" and runs["j1"]["row_count"] == 4
    assert [r["job_id"] for r in h.lookup("j2").collect()] == ["j2"]
    plan = h.lookup("j2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "j2" in plan


def test_run_job_end_to_end(spark, readings_path, tmp_dir):
    h = RunHistory(spark, os.path.join(tmp_dir, "hist"))
    wh = Warehouse(spark, root=os.path.join(tmp_dir, "wh"), prefix="job_")
    r = run_job(spark, readings_path, history=h, warehouse=wh, job_id="0000aaaa-1111-2222-3333-444455556666")
    assert r.status == "completed", r.error
    assert r.layers.ok and r.layers.tables["fact"].endswith("station_readings_0000aaaa1111")
    rec = h.lookup(r.job_id).first()
    assert rec["row_count"] == 7 and rec["status"] == "ok" and rec["format"] == "csv"
    doc = json.loads(rec["result_json"])
    assert doc["profile"]["categorical_columns"][:2] == ["station", "sky"]
    assert doc["categorical_top"][1]["top_values"][0] == {"value": "clear", "count": 3}
    assert [m["count"] for m in doc["datetime_trends"][0]["by_month"]] == [2, 2, 2, 1]
    assert doc["datetime_trends"][0]["by_year"][-1] == {"year": None, "count": 1}
    bad = run_job(spark, os.path.join(tmp_dir, "x.txt"), history=h, warehouse=wh, job_id="bad")
    assert bad.status == "failed" and h.lookup("bad").first()["status"] == "failed"


def test_insights_limit_and_status(spark):
    wide = spark.range(0, 300).select(*[(F.col("id") * (i + 1)).alias(f"n{i}") for i in range(14)])
    res = analyze(wide)
    f = report.result_frames(spark, res, "w")
    lines = report.insights(f["profile"], f["numeric_stats"], f["top_values"], f["runs"]).collect()
    assert len(lines) == 12 and [r["line_no"] for r in sorted(lines, key=lambda r: r["line_no"])] == list(range(1, 13))
    bad_runs = spark.createDataFrame([("w", "error", 0)], "job_id STRING, status STRING, row_count BIGINT")
    only = report.insights(f["profile"], f["numeric_stats"], f["top_values"], bad_runs).collect()
    assert [(r["title"]) for r in only] == ["Run status"]


def test_day_series_gate(spark):
    trends = spark.createDataFrame(
        [("j", 1, "a", "day", dt.date(2024, 1, 1), 3), ("j", 1, "a", "day", dt.date(2024, 1, 2), 1), ("j", 2, "b", "day", dt.date(2024, 1, 1), 5)],
        "job_id STRING, position INT, column_name STRING, grain STRING, period DATE, count BIGINT",
    )
    assert {r["column_name"] for r in report.day_series(trends).collect()} == {"a"}


def test_streaming_intake_once_per_file(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    h = RunHistory(spark, os.path.join(tmp_dir, "hist"))
    wh = Warehouse(spark, root=os.path.join(tmp_dir, "wh"), prefix="in_")
    cp = os.path.join(tmp_dir, "cp")
    _write(os.path.join(land, "one.csv"), "k,v\na,1\nb,2\n")
    _write(os.path.join(land, "skip.txt"), "nothing")
    run_intake(spark, land, cp, h, wh)
    first = {r["filename"]: r["status"] for r in h.runs().collect()}
    assert first == {"one.csv": "ok", "skip.txt": "failed"}
    _write(os.path.join(land, "two.json"), '{"k": "c", "v": 3}\n')
    run_intake(spark, land, cp, h, wh)
    run_intake(spark, land, cp, h, wh)  # nothing new: no new records
    runs = h.runs().collect()
    assert sorted(r["filename"] for r in runs) == ["one.csv", "skip.txt", "two.json"]


def test_explicit_schema_skips_inference(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "typed.csv"), "a,b\n1,x\n2,y\n")
    df = load(spark, path, "csv", schema="a STRING, b STRING")
    assert dict(df.dtypes) == {"a": "string", "b": "string"}
    assert load(spark, path, "csv").dtypes[0] == ("a", "int")


def test_error_run_document(spark):
    from pyspark.sql import types as T

    res = analyze(spark.createDataFrame([()], T.StructType([])))
    doc = json.loads(report.result_json(spark, res, "e").first()["result_json"])
    assert doc["status"] == "error" and doc["errors"] == ["Dataset has no columns."]
    assert doc.get("row_count") is None and doc["numeric_stats"] == []


def test_run_job_with_schema(spark, readings_path, tmp_dir):
    h = RunHistory(spark, os.path.join(tmp_dir, "hist"))
    wh = Warehouse(spark, root=os.path.join(tmp_dir, "wh"), prefix="sch_")
    ddl = (
        "reading_id STRING, station STRING, sky STRING, humidity INT, wind_kmh DOUBLE, "
        "taken_on DATE, verified BOOLEAN"
    )
    r = run_job(spark, readings_path, history=h, warehouse=wh, job_id="schema-1", schema=ddl)
    assert r.status == "completed", r.error
    assert r.analytics.profile.categorical[:3] == ["reading_id", "station", "sky"]


def test_a_file_that_fails_once_is_completed_once(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    h = RunHistory(spark, os.path.join(tmp_dir, "hist"))
    wh = Warehouse(spark, root=os.path.join(tmp_dir, "wh"), prefix="retry_")
    cp = os.path.join(tmp_dir, "cp")
    late = _write(os.path.join(land, "late.xlsx"), b"not yet", "wb")
    broken = _write(os.path.join(land, "broken.xlsx"), b"never", "wb")
    _write(os.path.join(land, "good.csv"), "k,v\na,1\n")
    _write(os.path.join(land, "refused.txt"), "x")
    ledger = Ledger.of(h)
    run_intake(spark, land, cp, h, wh, max_attempts=3)
    state = lambda: {r["name"]: (r["state"], r["attempt"]) for r in ledger.files().collect()}
    assert state() == {"late.xlsx": ("pending", 1), "broken.xlsx": ("pending", 1), "good.csv": ("done", 1), "refused.txt": ("dead", 1)}
    times = os.stat(late)
    _write(late, workbook_bytes(["id"], [[1], [2]]), "wb")
    os.utime(late, ns=(times.st_atime_ns, times.st_mtime_ns))  # the same file version, readable now
    done = h.runs().filter("filename = 'good.csv'").first()["created_at"]
    for _ in range(3):
        run_intake(spark, land, cp, h, wh, max_attempts=3)
    assert state() == {"late.xlsx": ("done", 2), "broken.xlsx": ("dead", 3), "good.csv": ("done", 1), "refused.txt": ("dead", 1)}
    assert sorted(r["name"] for r in ledger.dead_letters().collect()) == ["broken.xlsx", "refused.txt"]
    runs = {r["filename"]: r for r in h.runs().collect()}
    assert runs["late.xlsx"]["status"] == "ok" and runs["late.xlsx"]["row_count"] == 2
    assert runs["good.csv"]["created_at"] == done  # not run again
    assert os.path.exists(broken)


def test_a_replayed_micro_batch_runs_nothing_twice(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    _write(os.path.join(land, "one.csv"), "k,v\na,1\n")
    h = RunHistory(spark, os.path.join(tmp_dir, "hist"))
    intake = Intake(h, Warehouse(spark, root=os.path.join(tmp_dir, "wh"), prefix="replay_"))
    intake.handle(list_files(spark, land), 0)
    first = h.runs().first()["created_at"]
    intake.handle(list_files(spark, land), 0)
    assert h.runs().first()["created_at"] == first and h.runs().count() == 1
