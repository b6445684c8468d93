"""The run history as a log of commits, and a job that fails after it had results."""

from __future__ import annotations

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from strata.plans import history
from strata.plans.runs import RESULT_KINDS, RunHistory, run_job, run_record
from strata.plans.warehouse import Warehouse


@pytest.fixture()
def runs(spark, tmp_dir):
    return RunHistory(spark, f"{tmp_dir}/history")


def _record(spark, job_id, n, status="ok"):
    return run_record(spark, job_id, "a.csv", "csv", "file:/a.csv", status, None, n)


def _top(spark, job_id, *values):
    rows = [(job_id, 1, "c", i + 1, v, 10 - i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "job_id STRING, position INT, column_name STRING, rank INT, value STRING, count BIGINT")


def _state(h):
    return {r.job_id: r.row_count for r in h.runs().collect()}, sorted((r.job_id, r.value) for r in h.results("top_values").collect())


def test_nothing_is_seen_before_the_commit(spark, runs):
    assert _state(runs) == ({}, [])
    first = runs.log.begin()
    written = first.add("top_values", _top(spark, "j", "x", "y"))
    first.add("runs", _record(spark, "j", 1))
    assert written.count() == 2 and _state(runs) == ({}, [])
    first.publish_one("j")
    assert _state(runs) == ({"j": 1}, [("j", "x"), ("j", "y")])
    second = runs.log.begin()
    second.add("top_values", _top(spark, "j", "z"))
    second.add("runs", _record(spark, "j", 2))
    before = runs.report_frames()
    assert _state(runs) == ({"j": 1}, [("j", "x"), ("j", "y")])
    second.publish_one("j")
    assert _state(runs) == ({"j": 2}, [("j", "z")])
    # Frames taken before the commit still show one run, not half of each.
    assert [r.row_count for r in before["runs"].collect()] == [1] and before["top_values"].count() == 2


def test_a_job_that_fails_after_it_had_results(spark, runs, readings_path, tmp_dir):
    wh = Warehouse(spark, root=f"{tmp_dir}/wh", prefix="fail_")
    assert run_job(spark, readings_path, history=runs, warehouse=wh, job_id="one").status == "completed"
    assert run_job(spark, readings_path, history=runs, warehouse=wh, job_id="two").status == "completed"
    assert all(runs.results(k).filter("job_id = 'one'").count() for k in RESULT_KINDS if k != "numeric_stats")
    again = run_job(spark, f"{tmp_dir}/not_there.csv", history=runs, warehouse=wh, job_id="one")
    assert again.status == "failed"
    assert [(r.status, r.row_count, r.result_json) for r in runs.lookup("one").collect()] == [("failed", None, None)]
    for kind in RESULT_KINDS:
        assert {r.job_id for r in runs.results(kind).select("job_id").distinct().collect()} <= {"two"}


def test_compaction_and_vacuum_keep_what_is_visible(spark, runs):
    log = runs.log
    for n in range(3):
        for job in ("a", "b/ä %", "2024"):
            c = log.begin()
            c.add("runs", _record(spark, job, n))
            c.add("top_values", _top(spark, job, f"{job}{n}"))
            c.publish_one(job)
    want = ({"a": 2, "b/ä %": 2, "2024": 2}, sorted((j, f"{j}2") for j in ("a", "b/ä %", "2024")))
    assert _state(runs) == want
    files = lambda kind: sum(f.endswith(".parquet") for _, _, names in os.walk(f"{runs.path}/{kind}") for f in names)
    assert files("runs") == 9
    log.compact()
    assert _state(runs) == want and files("runs") == 12
    assert log.vacuum() == 0  # nothing is old enough
    assert log.vacuum(dt.timedelta(0)) >= 1
    assert _state(runs) == want and files("runs") == 3 and files(history.COMMITS) == 3
    runs.put("a", _record(spark, "a", 7, "error"))
    assert _state(runs)[0]["a"] == 7 and ("a", "a2") not in _state(runs)[1]
    log.compact()
    log.vacuum(dt.timedelta(0))
    assert _state(runs)[0] == {"a": 7, "b/ä %": 2, "2024": 2}


def test_a_commit_made_during_a_compaction_stays(spark, runs):
    runs.put("a", _record(spark, "a", 1))
    late = runs.log.begin()
    late.add("runs", _record(spark, "a", 2))
    runs.log.compact()
    late.publish_one("a")
    assert _state(runs)[0] == {"a": 2}
    runs.log.vacuum(dt.timedelta(0))
    assert _state(runs)[0] == {"a": 2}


def test_many_jobs_make_few_folders(spark, runs):
    jobs = spark.range(10_000).select(F.concat(F.lit("job-"), F.col("id").cast("string")).alias("job_id"), F.col("id").alias("n"))
    base = _record(spark, "x", 0).drop("job_id", "row_count")
    runs.upsert(jobs.crossJoin(base).withColumnRenamed("n", "row_count"))
    folders = sum(len(names) for _, names, _ in os.walk(runs.path))
    assert runs.runs().count() == 10_000 and folders <= 2 * (2 * history.BUCKETS + 1) + 3
    assert [r.row_count for r in runs.lookup("job-77").collect()] == [77]
    plan = runs.lookup("job-77")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_jobs_are_written_side_by_side(spark, runs):
    def put(i):
        job = f"j{i % 4}"
        c = runs.log.begin()
        c.add("runs", _record(spark, job, i))
        c.add("top_values", _top(spark, job, str(i)))
        c.publish_one(job)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(put, range(12)))
    rows, values = _state(runs)
    assert set(rows) == {"j0", "j1", "j2", "j3"}
    assert dict(values) == {j: str(n) for j, n in rows.items()}  # every job shows the rows of one commit
