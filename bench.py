"""Benchmark of the headline operations.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line:

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query materialises its complete result (``collect`` of the result rows,
or the written tables). Timings exclude JVM start-up (one warm-up query runs
first, on sf0.001 data); each query runs ``BENCH_REPEAT`` times (default 2)
and the best time is reported, which removes JIT/GC ordering noise. ``jobs``
records the Spark jobs of one run. ``comparison`` (not part of ``value``)
times the per-column job pattern of SURVEY section 3.2 on the same data, and
the exact vs hash-first top-k strategies on the document texts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from strata.operators.cleaning import processed  # noqa: E402
from strata.operators.marts import grouped_metrics, mart, mart_shape  # noqa: E402
from strata.operators.star import dimension, star_schema  # noqa: E402
from strata.plans import report  # noqa: E402
from strata.plans.analytics import analyze  # noqa: E402
from strata.plans.runs import RunHistory, run_job  # noqa: E402
from strata.plans.warehouse import Warehouse, build_layers  # noqa: E402
from strata.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = max(1, int(os.environ.get("BENCH_REPEAT", "2")))


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def analyze_all(spark, name):
    res = analyze(table(spark, name))
    res.numeric_stats.collect()
    res.top_values.collect()
    res.trends.collect()


def q_analyze_lineitem(spark):
    analyze_all(spark, "lineitem")


def q_analyze_orders(spark):
    analyze_all(spark, "orders")


def q_analyze_events(spark):
    analyze_all(spark, "events")


def q_analyze_documents(spark):
    """High-cardinality long text (up to 20,000 words per value) in the top-k."""
    analyze_all(spark, "documents")


def q_processed_lineitem(spark):
    processed(table(spark, "lineitem")).count()


def q_mart_lineitem(spark):
    mart(processed(table(spark, "lineitem"))).collect()


def q_mart_events_highcard(spark):
    mart(processed(table(spark, "events"))).collect()


def q_star_orders(spark):
    p = processed(table(spark, "orders"))
    shape = mart_shape(p)
    dim, fact = star_schema(grouped_metrics(p, shape), shape)
    fact.collect()


def q_dimension_customer_ranged(spark):
    p = processed(table(spark, "customer"))
    dimension(p, mart_shape(p).key, partitions=4).collect()


def q_layers_lineitem(spark):
    wh = Warehouse(spark, prefix="bench_")
    run = build_layers(wh, table(spark, "lineitem"), f"lineitem_{uuid.uuid4().hex[:12]}")
    assert run.ok, run.error


def q_run_job_orders(spark):
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    h = RunHistory(spark, f"{base}/bench_runs")
    r = run_job(spark, f"{SF_DIR}/orders.parquet", history=h, warehouse=Warehouse(spark, prefix="bench_"))
    assert r.status == "completed", r.error


def q_report_orders(spark):
    res = analyze(table(spark, "orders"))
    f = report.result_frames(spark, res, "bench")
    report.insights(f["profile"], f["numeric_stats"], f["top_values"], f["runs"]).collect()
    report.result_json(spark, res, "bench", f).collect()


def one_column_at_a_time(df):
    """The yardstick: our own analysis called once per column."""
    for name in df.columns:
        res = analyze(df.select(name))
        for frame in (res.numeric_stats, res.top_values, res.trends):
            frame.collect()


def topk_documents(method):
    from strata.operators.frequency import top_values

    return lambda spark: top_values(table(spark, "documents"), ["text", "lang", "source"], 10, method=method).collect()


# Measured right after the named query, in the same JVM state; not in the total.
COMPARE_AFTER = {
    "analyze_lineitem": {"per_column_analyze_lineitem": lambda spark: one_column_at_a_time(table(spark, "lineitem"))},
    "analyze_orders": {"per_column_analyze_orders": lambda spark: one_column_at_a_time(table(spark, "orders"))},
    "analyze_documents": {
        "topk_documents_exact": topk_documents("exact"),
        "topk_documents_hashed": topk_documents("hashed"),
    },
}


QUERIES = {
    "analyze_lineitem": q_analyze_lineitem,
    "analyze_orders": q_analyze_orders,
    "analyze_events": q_analyze_events,
    "analyze_documents": q_analyze_documents,
    "processed_lineitem": q_processed_lineitem,
    "mart_lineitem": q_mart_lineitem,
    "mart_events_highcard": q_mart_events_highcard,
    "star_orders": q_star_orders,
    "dimension_customer_ranged": q_dimension_customer_ranged,
    "layers_lineitem": q_layers_lineitem,
    "run_job_orders": q_run_job_orders,
    "report_orders": q_report_orders,
}


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="strata-bench-")
    spark = local_session(
        CPUS,
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * int(CPUS)))),
        warehouse_dir=os.path.join(scratch, "warehouse"),
    )
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    sc = spark.sparkContext
    # Warm-up on the smallest scale factor (JVM start, class loading, JIT of the
    # generated code), so that timings are steady-state.
    analyze(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")).top_values.collect()

    def measure(name, fn):
        best, n_jobs = None, 0
        for attempt in range(REPEAT):
            group = f"bench-{name}-{attempt}"
            sc.setJobGroup(group, name)
            t0 = time.perf_counter()
            fn(spark)
            took = time.perf_counter() - t0
            best = took if best is None else min(best, took)
            n_jobs = len(sc.statusTracker().getJobIdsForGroup(group))
        return round(best, 3), n_jobs

    only = [q for q in sys.argv[1:] if q in QUERIES] or list(QUERIES)
    timings, jobs, comparison = {}, {}, {}
    for name in only:
        timings[name], jobs[name] = measure(name, QUERIES[name])
        for other, fn in COMPARE_AFTER.get(name, {}).items():
            sec, n = measure(other, fn)
            comparison[other] = {"sec": sec, "jobs": n}
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "jobs": jobs,
                "comparison": comparison,
                "sf": float(sf.group(1)) if sf else SF_DIR,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
