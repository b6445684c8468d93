"""

Every query reads whole test tables (or data Spark derives from them). Output
columns carry the same names in the Spark query and its oracle; floating point
results are rounded to 4 decimals on both sides (sums are order dependent).
"""

from __future__ import annotations

import importlib.util
import io
import os
import sys
import uuid
from collections.abc import Callable

import pandas as pd

# The package sits next to this file; make it importable however this module
# was loaded (by path, from another working directory).
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.naming import make_slug
from strata.operators import frequency, summary, trends
from strata.operators.cleaning import processed, standardized
from strata.operators.marts import grouped_metrics, mart, mart_shape
from strata.operators.profile import build_profile
from strata.operators.star import dimension, join_fact, star_schema
from strata.plans import catalog, report
from strata.plans.analytics import analyze, run_file
from strata.plans.runs import RunHistory, run_job
from strata.plans.warehouse import Warehouse, build_layers, reconciliation
from strata.sources.excel import workbook_bytes
from strata.sources.files import write_files
from strata.sources.manifest import list_files, manifest
from strata.sources.readers import load
from strata.streaming.intake import Ledger, run_intake

# The fixture mappers below run in executors; ship them by value with the task.
# (A module loaded by path without a sys.modules entry is pickled by value anyway.)
if __name__ in sys.modules:
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The training-data operators are optional: without their subpackage and the
# pipeline module on top of it the other queries still register. An import that
# fails inside them is an error.
if all(importlib.util.find_spec(name) for name in ("strata.llm", "corpus_pipeline")):
    import corpus_pipeline as _pipeline
    from strata.llm import queries as _llm
else:
    _pipeline = _llm = None

SF0001 = "/root/testdata/sf0.001"
LIMIT = 200  # categorical_max_distinct default


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r(c):
    return F.round(c, 4)


# ------------------------------------------------------------------ flagship


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: adaptive analytics of lineitem — the top-k frequency report."""
    return _categorical_topk_table(spark, SF0001, "lineitem")


# ------------------------------------------------------------------ queries


def q_profile_roles(spark, sf_dir):
    frames = []
    for name in ("lineitem", "orders", "events"):
        prof = build_profile(_t(spark, sf_dir, name))
        frames.append(
            prof.to_frame(spark).select(
                F.lit(name).alias("table_name"),
                "ordinal",
                "column_name",
                "role",
                "role_position",
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _late_dates(spark, sf_dir):
    """orders with its date as text, present in the last rows only, and its numbers as text."""
    orders = _t(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    late = F.when(F.col("o_orderkey") > 0.9 * last, F.col("o_orderdate").cast("string"))
    numbers = ["o_orderkey", "o_custkey", "o_totalprice"]
    return orders.select(
        late.alias("o_orderdate_text"),
        *[F.concat(F.lit("n"), F.col(c).cast("string")).alias(c) for c in numbers],
        "o_orderpriority",
        "o_orderstatus",
    )


def q_profile_string_datetime(spark, sf_dir):
    """P2 over all rows: the only dates stand in the last tenth of the keys."""
    return build_profile(_late_dates(spark, sf_dir)).to_frame(spark).select("column_name", "role")


def q_row_count_all(spark, sf_dir):
    out = None
    for name in TABLES:
        part = summary.row_count(_t(spark, sf_dir, name)).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        out = part if out is None else out.unionByName(part)
    return out


def _stats_frame(df: DataFrame) -> DataFrame:
    prof = build_profile(df)
    stats = summary.numeric_summary(df, prof.numeric)
    return stats.select(
        "position",
        "column_name",
        "count",
        _r("mean").alias("mean"),
        _r("min").alias("min"),
        _r("max").alias("max"),
        _r("stddev_pop").alias("stddev_pop"),
    )


def q_numeric_stats(spark, sf_dir):
    return _stats_frame(_t(spark, sf_dir, "lineitem"))


def q_numeric_stats_nulls(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    injected = li.select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "R", None)
        .otherwise(F.col("l_extendedprice"))
        .alias("l_extendedprice"),
        F.when(F.col("l_linestatus") == "O", None).otherwise(F.col("l_partkey")).alias("l_partkey"),
        "l_returnflag",
    )
    return _stats_frame(injected)


def q_numeric_stats_fused(spark, sf_dir):
    """A1/A2 through the full F1 analysis (profile pass row count + summary)."""
    res = analyze(_t(spark, sf_dir, "orders"))
    return res.numeric_stats.select(
        "position",
        "column_name",
        "count",
        _r("mean").alias("mean"),
        _r("min").alias("min"),
        _r("max").alias("max"),
        _r("stddev_pop").alias("stddev_pop"),
        F.lit(res.row_count).cast("bigint").alias("row_count"),
    )


def _categorical_topk_table(spark, sf_dir, name):
    df = _t(spark, sf_dir, name)
    res = analyze(df)
    return res.top_values.select(F.lit(name).alias("table_name"), "column_name", "rank", "value", "count")


def q_categorical_topk(spark, sf_dir):
    return _categorical_topk_table(spark, sf_dir, "orders").unionByName(
        _categorical_topk_table(spark, sf_dir, "part")
    )


def q_categorical_topk_numeric(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_linenumber")
    prof = build_profile(li)
    top = frequency.top_values(li, prof.categorical, 10)
    return top.select("column_name", "rank", F.col("value").cast("double").alias("value"), "count")


def _trend_source(spark, sf_dir):
    """Tables with datetime columns: orders (o_orderdate) and events (ts)."""
    return [
        ("orders", _t(spark, sf_dir, "orders")),
        ("events", _t(spark, sf_dir, "events")),
    ]


def _trend_grain(spark, sf_dir, grain):
    out = None
    for name, df in _trend_source(spark, sf_dir):
        prof = build_profile(df)
        days = trends.day_counts(df, prof.datetime)
        if grain == "day":
            part = days.select("column_name", F.col("day").alias("period"), "count")
        elif grain == "month":
            part = trends.month_counts(days).select(
                "column_name", F.col("month").alias("period"), "count"
            )
        else:
            part = trends.year_counts(days).select(
                "column_name", F.col("year").cast("int").alias("year"), "count"
            )
        part = part.select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def q_trend_day(spark, sf_dir):
    return _trend_grain(spark, sf_dir, "day")


def q_trend_month(spark, sf_dir):
    return _trend_grain(spark, sf_dir, "month")


def q_trend_year(spark, sf_dir):
    return _trend_grain(spark, sf_dir, "year")


FIRST_PERIODS = 30


def q_trend_first_periods(spark, sf_dir):
    """L2: the first periods of all orders in time order, those without a date last."""
    orders = _t(spark, sf_dir, "orders").withColumn("o_orderdate", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")))
    found = trends.trends(orders, ["o_orderdate"]).filter("grain <> 'day'")
    return trends.ordered(found).limit(FIRST_PERIODS).select("grain", "period", "count")


def q_profile_sampled(spark, sf_dir):
    """L3: roles of orders (its date as text) decided by a sample of 500 rows."""
    orders = _t(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    return build_profile(orders, sample_rows=500).to_frame(spark).select("column_name", "role")


def q_trend_all_grains(spark, sf_dir):
    res = analyze(_t(spark, sf_dir, "orders"))
    return res.trends.select("column_name", "grain", "period", "count")


def q_trend_null_bucket(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", None)
        .otherwise(F.col("o_orderdate"))
        .alias("o_orderdate"),
        F.when(F.col("o_orderstatus") == "F", None)
        .otherwise(F.col("o_orderdate").cast("string"))
        .alias("o_orderdate_text"),
    )
    res = analyze(orders)
    return res.trends.select("column_name", "grain", "period", "count")


# ------------------------------------------------------------------ layers

MESSY_NAMES = ["Cust Key", "cust-key", "2nd", "", "a", "A", "a_2"]


def _messy_customer(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_custkey", "c_name"
    ).toDF(*MESSY_NAMES)


def q_standardized_columns(spark, sf_dir):
    return standardized(_messy_customer(spark, sf_dir))


def _orders_with_dups(spark, sf_dir):
    """orders twice: NULLs injected in the first copy, 0 / '(missing)' in the second,
    so the NULL fill merges the copies again."""
    o = _t(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    first = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", None).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(urgent, None).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(urgent, None).otherwise(F.col("o_orderdate")).alias("o_orderdate"),
        "o_orderpriority",
    )
    second = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "(missing)").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(urgent, 0.0).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )
    return first.unionByName(second)


def q_processed_layer(spark, sf_dir):
    return processed(_orders_with_dups(spark, sf_dir))


def q_layer_reconciliation(spark, sf_dir):
    raw = _orders_with_dups(spark, sf_dir)
    return reconciliation(spark, raw, processed(raw))


def _mart_of(spark, sf_dir, name, cols=None):
    df = _t(spark, sf_dir, name)
    if cols:
        df = df.select(*cols)
    p = processed(df)
    out = mart(p)
    return out.select(*[_r(c).alias(c) if c.startswith(("sum_", "avg_")) else c for c in out.columns])


def q_mart_grouped(spark, sf_dir):
    return _mart_of(spark, sf_dir, "lineitem")


def q_mart_grouped_orders(spark, sf_dir):
    return _mart_of(spark, sf_dir, "orders")


def q_mart_grouped_highcard(spark, sf_dir):
    return _mart_of(spark, sf_dir, "events")


def q_mart_documents_text(spark, sf_dir):
    """A7 keyed by whole document texts (up to 20,000 words each)."""
    return _mart_of(spark, sf_dir, "documents")


def q_mart_conversations(spark, sf_dir):
    return _mart_of(spark, sf_dir, "conversations")


def q_topk_documents(spark, sf_dir):
    """A3/L1 over whole texts, languages and sources."""
    return _categorical_topk_table(spark, sf_dir, "documents")


def q_topk_documents_hashed(spark, sf_dir):
    """A3/L1 over whole texts with the hash-first strategy (same rows as topk_documents)."""
    res = analyze(_t(spark, sf_dir, "documents"), topk_method="hashed")
    return res.top_values.select(F.lit("documents").alias("table_name"), "column_name", "rank", "value", "count")


def q_mart_global(spark, sf_dir):
    return _mart_of(spark, sf_dir, "labels")


def q_mart_count_only(spark, sf_dir):
    return _mart_of(spark, sf_dir, "orders", ["o_orderstatus", "o_orderpriority"])


def q_dimension(spark, sf_dir):
    p = processed(_t(spark, sf_dir, "customer"))
    return dimension(p, mart_shape(p).key)


def q_dimension_ranged(spark, sf_dir):
    """W1 over a given number of ranges."""
    p = processed(_t(spark, sf_dir, "customer"))
    return dimension(p, mart_shape(p).key, partitions=5)


def _star(spark, sf_dir, name, cols=None, partitions=None):
    df = _t(spark, sf_dir, name)
    if cols:
        df = df.select(*cols)
    p = processed(df)
    shape = mart_shape(p)
    dim, fact = star_schema(grouped_metrics(p, shape), shape, partitions)
    return fact.select(*[_r(c).alias(c) if c.startswith(("sum_", "avg_")) else c for c in fact.columns])


def q_fact_star(spark, sf_dir):
    return _star(spark, sf_dir, "lineitem")


def q_fact_star_ranged(spark, sf_dir):
    return _star(spark, sf_dir, "orders", partitions=5)


def q_fact_count_only(spark, sf_dir):
    return _star(spark, sf_dir, "pages", ["url"])


def q_star_join(spark, sf_dir):
    """Per-key metrics joined to a separately built dimension."""
    p = processed(_t(spark, sf_dir, "orders"))
    shape = mart_shape(p)
    dim = dimension(p, shape.key)
    fact = join_fact(grouped_metrics(p, shape), dim, shape)
    return fact.select(*[_r(c).alias(c) if c.startswith(("sum_", "avg_")) else c for c in fact.columns])


def q_layer_preview(spark, sf_dir):
    wh, run = _built(spark, sf_dir, "orders")
    return catalog.preview(spark, run.tables["processed"], 10, ["o_orderkey"])


def _built(spark, sf_dir, name, cols=None):
    wh = Warehouse(spark, prefix="strata_check_")
    df = _t(spark, sf_dir, name)
    if cols:
        df = df.select(*cols)
    run = build_layers(wh, df, make_slug(f"{name}.parquet", "5eed" + "0" * 28))
    if not run.ok:
        raise RuntimeError(run.error)
    return wh, run


def q_catalog_columns(spark, sf_dir):
    wh, run = _built(spark, sf_dir, "customer")
    return catalog.columns(spark, run.tables["processed"])


def q_catalog_tables(spark, sf_dir):
    wh, run = _built(spark, sf_dir, "supplier")
    return catalog.structure(wh).filter(F.col("table_name").endswith(run.slug))


def q_layer_tables_fact(spark, sf_dir):
    """F3 end to end on orders: the fact table as written by the layer run."""
    wh, run = _built(spark, sf_dir, "orders")
    fact = spark.table(run.tables["fact"])
    return fact.select(*[_r(c).alias(c) if c.startswith(("sum_", "avg_")) else c for c in fact.columns])


def q_catalog_inspect(spark, sf_dir):
    """Columns and a 5-row JSON sample of every layer table of one run."""
    wh, run = _built(spark, sf_dir, "part")
    return catalog.inspect(wh, slug=run.slug).select(
        "layer", "table_name", "columns", F.size("sample").alias("sample_rows"), "error"
    )


def q_file_analytics(spark, sf_dir):
    """detect the format of a path, load it and run the adaptive analytics."""
    df, res = run_file(spark, f"{sf_dir}/part.parquet")
    return res.top_values.select(F.lit("part").alias("table_name"), "column_name", "rank", "value", "count")


def q_analytics_checkpointed(spark, sf_dir):
    """the same analysis after a reliable checkpoint of the input."""
    res = analyze(_t(spark, sf_dir, "orders"), checkpoint=True)
    return res.top_values.select(F.lit("orders").alias("table_name"), "column_name", "rank", "value", "count")


AWKWARD = ["order.status", "order `priority`"]


def q_awkward_names(spark, sf_dir):
    """Names with dots, spaces and backticks through the whole analysis."""
    o = _t(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").toDF(*AWKWARD)
    res = analyze(o)
    return res.top_values.select("column_name", "rank", "value", "count")


# ------------------------------------------------------------------ reports and runs


def _orders_frames(spark, sf_dir):
    res = analyze(_t(spark, sf_dir, "orders"))
    return res, report.result_frames(spark, res, "orders-run")


def q_report_insights(spark, sf_dir):
    res, f = _orders_frames(spark, sf_dir)
    return report.insights(f["profile"], f["numeric_stats"], f["top_values"], f["runs"])


def q_report_numeric_series(spark, sf_dir):
    res, f = _orders_frames(spark, sf_dir)
    s = report.numeric_series(f["numeric_stats"])
    return s.select("job_id", "position", "label", *[_r(c).alias(c) for c in ("average", "minimum", "maximum")])


def q_report_category_series(spark, sf_dir):
    res, f = _orders_frames(spark, sf_dir)
    return report.category_series(f["top_values"])


def q_report_day_series(spark, sf_dir):
    res, f = _orders_frames(spark, sf_dir)
    return report.day_series(f["trends"])


def q_report_panel(spark, sf_dir):
    res, f = _orders_frames(spark, sf_dir)
    p = report.panel(f["profile"], f["numeric_stats"], f["top_values"], f["runs"])
    return p.select(*[_r(c).alias(c) if c in ("mean", "min", "max", "stddev_pop") else c for c in p.columns])


_DOC_SCHEMA = (
    "row_count BIGINT, numeric_stats ARRAY<STRUCT<column: STRING, count: BIGINT, mean: DOUBLE, min: DOUBLE, "
    "max: DOUBLE, stddev_pop: DOUBLE>>, datetime_trends ARRAY<STRUCT<column: STRING, "
    "by_month: ARRAY<STRUCT<month: STRING, count: BIGINT>>, by_year: ARRAY<STRUCT<year: INT, count: BIGINT>>>>"
)


def q_result_json(spark, sf_dir):
    """K7 read back: orders with an all-NULL number and NULL dates, numbers of the
    document as rows, with the place of the NULL year and the explicit nulls."""
    orders = (
        _t(spark, sf_dir, "orders")
        .withColumn("o_nothing", F.lit(None).cast("double"))
        .withColumn("o_orderdate", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")))
    )
    res = analyze(orders, categorical_max_distinct=0)
    doc = report.result_json(spark, res, "orders-run", report.result_frames(spark, res, "orders-run"))
    d = doc.select(F.from_json("result_json", _DOC_SCHEMA).alias("d"), F.col("result_json").contains('"mean":null').alias("nulls"))

    def rows(section, column, key, number):
        return [F.lit(section).alias("section"), column.alias("column_name"), key.alias("key"), _r(number.cast("double")).alias("number")]

    none = F.lit(None).cast("string")
    out = d.select(*rows("row_count", none, none, F.col("d.row_count")))
    out = out.union(d.select(*rows("explicit nulls", none, none, F.col("nulls").cast("int"))))
    stats = d.select(F.explode("d.numeric_stats").alias("s")).select("s.*")
    for key in ("count", "mean", "min", "max", "stddev_pop"):
        out = out.union(stats.select(*rows("numeric", F.col("column"), F.lit(key), F.col(key))))
    trend = d.select(F.explode("d.datetime_trends").alias("t")).select("t.*")
    years = trend.select("column", F.posexplode("by_year").alias("at", "y"), F.size("by_year").alias("n"))
    out = out.union(years.select(*rows("year", F.col("column"), F.col("y.year").cast("string"), F.col("y.count"))))
    last = years.filter("y.year IS NULL").select(*rows("NULL year is last", F.col("column"), none, (F.col("at") == F.col("n") - 1).cast("int")))
    months = trend.select("column", F.explode("by_month").alias("m"))
    return out.union(last).union(months.select(*rows("month", F.col("column"), F.col("m.month"), F.col("m.count"))))


def _run_replaced(spark, sf_dir):
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    history = RunHistory(spark, f"{base}/strata_check_replaced/{uuid.uuid4().hex[:12]}")
    for table in ("orders", "customer"):
        wh = Warehouse(spark, prefix="strata_check_")
        run = run_job(spark, f"{sf_dir}/{table}.parquet", history=history, warehouse=wh, job_id="one-job")
        if run.status != "completed":
            raise RuntimeError(run.error)
    return history


def q_run_results_replaced(spark, sf_dir):
    """A job id run on orders, then on customer; all its results are customer's."""
    history = _run_replaced(spark, sf_dir)
    out = None
    for kind in ("profile", "numeric_stats", "top_values", "trends"):
        part = history.results(kind).select(F.lit(kind).alias("kind"), "column_name").distinct()
        out = part if out is None else out.union(part)
    rows = history.runs().select(F.lit("run").alias("kind"), F.lit(None).cast("string").alias("column_name"), "row_count")
    return out.withColumn("row_count", F.lit(None).cast("long")).union(rows)


def q_report_history_insights(spark, sf_dir):
    """R1 over the whole run history: two recorded jobs, one set of lines."""
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    h = RunHistory(spark, f"{base}/strata_check_reports/{uuid.uuid4().hex[:12]}")
    wh = Warehouse(spark, prefix="strata_check_")
    for job, table in (("hist-orders", "orders"), ("hist-customer", "customer")):
        r = run_job(spark, f"{sf_dir}/{table}.parquet", history=h, warehouse=wh, job_id=job)
        if r.status != "completed":
            raise RuntimeError(r.error)
    f = h.report_frames()
    return report.insights(f["profile"], f["numeric_stats"], f["top_values"], f["runs"])


def _history(spark):
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return RunHistory(spark, base + "/strata_check_runs")


def _record_runs(spark, sf_dir, runs):
    h = _history(spark)
    wh = Warehouse(spark, prefix="strata_check_")
    for job, table in runs:
        r = run_job(spark, f"{sf_dir}/{table}.parquet", history=h, warehouse=wh, job_id=job)
        if r.status != "completed":
            raise RuntimeError(r.error)
    return h


def _three_runs(spark, sf_dir):
    """Three jobs, two ids: 'job-a' runs twice (upsert), 'job-b' once."""
    return _record_runs(spark, sf_dir, (("job-a", "nation"), ("job-a", "orders"), ("job-b", "customer")))


def q_run_history_upsert(spark, sf_dir):
    h = _three_runs(spark, sf_dir)
    return h.runs().filter(F.col("job_id").isin("job-a", "job-b")).select(
        "job_id", "filename", "format", "status", "row_count"
    )


def q_run_lookup(spark, sf_dir):
    h = _record_runs(spark, sf_dir, (("job-a", "orders"), ("job-b", "customer")))
    return h.lookup("job-b").select("job_id", "filename", "format", "status", "row_count")


# ------------------------------------------------------------------ sources and intake


def _scratch(spark, kind):
    """A fresh folder under the warehouse location (shared storage on a cluster)."""
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{base}/strata_check_landing/{kind}-{uuid.uuid4().hex[:12]}"


def q_csv_scan(spark, sf_dir):
    root = _scratch(spark, "csv")
    _t(spark, sf_dir, "customer").write.option("header", "true").csv(root)
    return load(spark, root, "csv")


def _part_notes(spark, sf_dir):
    """part with a text that holds every delimiter, quotes, braces and a backslash."""
    note = F.concat("p_name", F.lit("; "), "p_type", F.lit(', "'), "p_brand", F.lit('" | {\t'), F.col("p_size").cast("string"), F.lit("] \\ }{"))
    return _t(spark, sf_dir, "part").select("p_partkey", note.alias("note"), "p_retailprice")


PART_NOTES_SQL = (
    "SELECT p_partkey, p_name || '; ' || p_type || ', \"' || p_brand || '\" | {' || chr(9) || p_size || '] \\ }{' AS note, "
    "p_retailprice FROM part"
)


def q_csv_dialects_scan(spark, sf_dir):
    """One folder of comma, semicolon, tab and bar files whose texts hold all four delimiters and quotes."""
    root = _scratch(spark, "csvdialects")
    rows = _part_notes(spark, sf_dir)
    for i, sep in enumerate((",", ";", "\t", "|")):
        own = rows.filter(F.col("p_partkey") % 4 == i)
        own.write.options(header="true", sep=sep, escape='"', quoteAll="true").csv(f"{root}/dialect-{i}")
    return load(spark, f"{root}/*", "csv")


def q_csv_headers_scan(spark, sf_dir):
    """One folder of files with reordered, missing and further columns, united by name."""
    root = _scratch(spark, "csvheaders")
    orders = _t(spark, sf_dir, "orders")
    layouts = (
        (",", ["o_orderkey", "o_custkey", "o_totalprice"]),
        (",", ["o_totalprice", "o_orderstatus", "o_orderkey"]),
        (";", ["o_orderpriority", "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"]),
    )
    for i, (sep, columns) in enumerate(layouts):
        own = orders.filter(F.col("o_orderkey") % 3 == i).select(*columns)
        own.write.options(header="true", sep=sep).csv(f"{root}/layout-{i}")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return load(spark, f"{root}/*", "csv").select(*columns)


def q_json_braces_scan(spark, sf_dir):
    """S3: JSON lines whose strings hold braces, brackets, quotes and backslashes."""
    root = _scratch(spark, "jsonbraces")
    _part_notes(spark, sf_dir).write.json(root)
    return load(spark, root, "json")


def q_json_documents_scan(spark, sf_dir):
    """S3: pretty-printed documents (arrays, and objects one after the other), cut into records by blocks."""
    root = _scratch(spark, "jsondocuments")
    rows = _part_notes(spark, sf_dir)
    pretty = {"pretty": "true"}
    row = F.struct(*rows.columns)
    docs = rows.groupBy(_bucket("p_partkey").alias("bucket")).agg(
        F.to_json(F.collect_list(F.when(F.col("p_partkey") % 2 == 0, row)), pretty).alias("array"),
        F.array_join(F.collect_list(F.when(F.col("p_partkey") % 2 == 1, F.to_json(row, pretty))), "\n").alias("objects"),
    )
    for kind in ("array", "objects"):
        path = F.concat(F.lit(f"{root}/{kind}-"), F.col("bucket").cast("string"), F.lit(".json"))
        write_files(docs.select(path.alias("path"), F.encode(kind, "UTF-8").alias("content"))).collect()
    return load(spark, root, "json").select(*rows.columns)


def q_json_lines_scan(spark, sf_dir):
    root = _scratch(spark, "jsonl")
    _t(spark, sf_dir, "part").write.json(root)
    return load(spark, root, "json")


ROWS_PER_DOCUMENT = 500


def _bucket(key: str):
    """Dense integer keys in blocks of at most ROWS_PER_DOCUMENT rows."""
    return F.floor(F.col(key) / ROWS_PER_DOCUMENT)


def q_json_array_scan(spark, sf_dir):
    """supplier as JSON array documents (at most 500 records each, one per file)."""
    root = _scratch(spark, "jsonarray")
    sup = _t(spark, sf_dir, "supplier")
    docs = sup.groupBy(_bucket("s_suppkey").alias("bucket")).agg(
        F.to_json(F.collect_list(F.struct(*sup.columns))).alias("doc")
    )
    write_files(
        docs.select(
            F.concat(F.lit(root + "/part-"), F.col("bucket").cast("string"), F.lit(".json")).alias("path"),
            F.encode("doc", "UTF-8").alias("content"),
        )
    ).collect()
    return load(spark, root, "json")


def q_json_mixed_scan(spark, sf_dir):
    """supplier in one folder: half as JSON array documents, half as JSON lines."""
    root = _scratch(spark, "jsonmixed")
    sup = _t(spark, sf_dir, "supplier")
    docs = sup.filter("s_suppkey % 2 = 0").groupBy(_bucket("s_suppkey").alias("bucket")).agg(
        F.to_json(F.collect_list(F.struct(*sup.columns))).alias("doc")
    )
    sup.filter("s_suppkey % 2 = 1").write.json(root)
    path = F.concat(F.lit(root + "/document-"), F.col("bucket").cast("string"), F.lit(".json"))
    write_files(docs.select(path.alias("path"), F.encode("doc", "UTF-8").alias("content"))).collect()
    return load(spark, root, "json").select(*sup.columns)


def _workbook_files(root):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        cols = [c for c in pdf.columns if c != "bucket"]
        rows = pdf[cols].values.tolist()
        path = f"{root}/part-{int(pdf['bucket'].iloc[0])}.xlsx"
        return pd.DataFrame({"path": [path], "content": [workbook_bytes(cols, rows)]})

    return build


def q_excel_scan(spark, sf_dir):
    """supplier as .xlsx workbooks (at most 500 rows each), read back."""
    root = _scratch(spark, "xlsx")
    grouped = _t(spark, sf_dir, "supplier").withColumn("bucket", _bucket("s_suppkey"))
    files = grouped.groupBy("bucket").applyInPandas(_workbook_files(root), "path STRING, content BINARY")
    write_files(files).collect()
    return load(spark, root, "excel")


def _landing_files(root):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        data = pdf.drop(columns=["g"]).sort_values("n_nationkey")
        csv = data.to_csv(index=False).encode()
        jsonl = data.to_json(orient="records", lines=True).encode()
        pq = io.BytesIO()
        data.to_parquet(pq, index=False)
        wide = pd.concat([data] * 200).to_csv(index=False).encode()
        xlsx = workbook_bytes(list(data.columns), data.values.tolist())
        named = {
            "nation.csv": csv,
            "nation.json": jsonl,
            "nation.pq": pq.getvalue(),
            "nation.parquet": pq.getvalue(),
            "nation.xlsx": xlsx,
            "nation.xls": xlsx,
            "nation.txt": csv,
            "nation": jsonl,
            "nation.dat": pq.getvalue(),
            "bad..name.csv": csv,
            "Nation Data.csv": csv,
            "nation_wide.csv": wide,
        }
        return pd.DataFrame({"path": [f"{root}/{k}" for k in named], "content": list(named.values())})

    return build


MANIFEST_MAX_BYTES = 20_000


PARTS_LABEL = "(orders parts)"


def q_ingest_manifest(spark, sf_dir):
    """Named fixture files (from nation) under a size limit, and orders landed as
    Spark CSV parts without one: all parts are accepted and hold every row."""
    root = _scratch(spark, "landing")
    n = _t(spark, sf_dir, "nation").withColumn("g", F.lit(0))
    write_files(n.groupBy("g").applyInPandas(_landing_files(f"{root}/named"), "path STRING, content BINARY")).collect()
    _t(spark, sf_dir, "orders").write.csv(f"{root}/orders", header=True)
    columns = ["name", "safe_name", "format", "accepted", "reject_reason"]
    named = manifest(list_files(spark, f"{root}/named"), max_bytes=MANIFEST_MAX_BYTES)
    parts = manifest(list_files(spark, f"{root}/orders"))
    label = F.lit(PARTS_LABEL)
    rows = load(spark, f"{root}/orders", "csv").count()
    accepted = parts.groupBy("format").agg(F.min("accepted").alias("accepted"), F.max("reject_reason").alias("reject_reason"))
    accepted = accepted.select(label.alias("name"), label.alias("safe_name"), "format", "accepted", "reject_reason", F.lit(rows).cast("long").alias("rows"))
    return named.select(*columns, F.lit(None).cast("long").alias("rows")).unionByName(accepted)


def _intake_files(root, table):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        data = pdf.drop(columns=["g"])
        if table == "nation":
            name, content = "nation.csv", data.to_csv(index=False).encode()
        else:
            name, content = f"{table}.json", data.to_json(orient="records", lines=True).encode()
        return pd.DataFrame({"path": [f"{root}/{name}"], "content": [content]})

    return build


def _land(spark, sf_dir, root, table):
    """One named file from a fixed-size table (nation, region)."""
    df = _t(spark, sf_dir, table).withColumn("g", F.lit(0))
    write_files(df.groupBy("g").applyInPandas(_intake_files(root, table), "path STRING, content BINARY")).collect()


def q_streaming_intake(spark, sf_dir):
    """Two availableNow runs: nation.csv + region.json, then customer as Parquet
    parts written by Spark (one dataset per part file)."""
    root = _scratch(spark, "intake")
    landing, checkpoint = f"{root}/landing", f"{root}/_checkpoint"
    history = RunHistory(spark, f"{root}/history")
    wh = Warehouse(spark, prefix="strata_check_")
    _land(spark, sf_dir, landing, "nation")
    _land(spark, sf_dir, landing, "region")
    run_intake(spark, landing, checkpoint, history, wh)
    _t(spark, sf_dir, "customer").write.parquet(f"{landing}/customer")
    run_intake(spark, landing, checkpoint, history, wh)
    return history.runs().groupBy("format", "status").agg(F.sum("row_count").alias("row_count"))


def q_intake_retries(spark, sf_dir):
    """customer parts, two of them cut short. The broken ones are tried three times, then they are dead letters;
    the others are done at the first attempt and not run again."""
    root = _scratch(spark, "retries")
    landing, history = f"{root}/landing", RunHistory(spark, f"{root}/history")
    wh = Warehouse(spark, prefix="strata_check_")
    _t(spark, sf_dir, "customer").repartition(2, "c_custkey").write.parquet(f"{landing}/customer")
    nation = _t(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").cast("string").alias("r"))
    broken = nation.agg(F.to_json(F.collect_list("n_name")).alias("doc")).filter("r IN ('0', '1')")
    path = F.concat(F.lit(f"{landing}/nation-"), F.col("r"), F.lit(".parquet"))
    write_files(broken.select(path.alias("path"), F.encode("doc", "UTF-8").alias("content"))).collect()
    for _ in range(4):
        run_intake(spark, landing, f"{root}/_checkpoint", history, wh)
    files = Ledger.of(history).files().join(history.runs().select("job_id", "row_count", F.col("status")), "job_id")
    return files.groupBy("state", "attempt", "status").agg(F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count"))


def q_run_failed_rerun(spark, sf_dir):
    """A job with results that fails when it is run again keeps its failed record only; another job stays."""
    history = _history_of(spark, "failed")
    wh = Warehouse(spark, prefix="strata_check_")
    for job, path in (("again", "orders"), ("stays", "customer"), ("again", "no_such_table")):
        run_job(spark, f"{sf_dir}/{path}.parquet", history=history, warehouse=wh, job_id=job)
    frames = history.report_frames()
    results = None
    for kind in ("profile", "numeric_stats", "top_values", "trends"):
        part = frames[kind].select("job_id", F.lit(kind).alias("kind")).distinct()
        results = part if results is None else results.union(part)
    kinds = results.groupBy("job_id").agg(F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"))
    return frames["runs"].join(kinds, "job_id", "left").select("job_id", "status", "row_count", "kinds")


def _history_of(spark, kind):
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return RunHistory(spark, f"{base}/strata_check_{kind}/{uuid.uuid4().hex[:12]}")


def q_table_replaced(spark, sf_dir):
    """K2-K5: a table that is replaced by other columns, then by rows made from itself; a write between them fails."""
    wh = Warehouse(spark, root=_scratch(spark, "replaced"), prefix=f"strata_check_{uuid.uuid4().hex[:8]}_")
    wh.ensure_layers()
    part = _t(spark, sf_dir, "part")
    wh.write(part, "processed", "t")
    sizes = wh.write(part.groupBy("p_brand").agg(F.sum("p_size").alias("size")), "processed", "t")
    failing = F.when(F.col("size") >= 0, F.raise_error(F.lit("stopped"))).otherwise(F.col("size")).cast("long")
    try:
        wh.write(sizes.withColumn("size", failing), "processed", "t")
        raise RuntimeError("the write did not fail")
    except Exception as error:
        if "stopped" not in str(error):
            raise
    rows, n = wh.replace(sizes.withColumn("size", F.col("size") + 1), "processed", "t")
    return rows.withColumn("n_rows", F.lit(n).cast("long"))


TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All registered queries; those of the training-data operators if present."""
    found = _library_queries()
    if _llm is not None:
        found |= _llm.QUERIES | {"pipeline": _pipeline.run}
    return found


def _library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "profile_roles": q_profile_roles,
        "profile_string_datetime": q_profile_string_datetime,
        "row_count_all": q_row_count_all,
        "numeric_stats": q_numeric_stats,
        "numeric_stats_nulls": q_numeric_stats_nulls,
        "numeric_stats_fused": q_numeric_stats_fused,
        "categorical_topk": q_categorical_topk,
        "categorical_topk_numeric": q_categorical_topk_numeric,
        "trend_day": q_trend_day,
        "trend_first_periods": q_trend_first_periods,
        "profile_sampled": q_profile_sampled,
        "trend_month": q_trend_month,
        "trend_year": q_trend_year,
        "trend_all_grains": q_trend_all_grains,
        "trend_null_bucket": q_trend_null_bucket,
        "standardized_columns": q_standardized_columns,
        "processed_layer": q_processed_layer,
        "layer_reconciliation": q_layer_reconciliation,
        "mart_grouped": q_mart_grouped,
        "mart_grouped_orders": q_mart_grouped_orders,
        "mart_grouped_highcard": q_mart_grouped_highcard,
        "mart_documents_text": q_mart_documents_text,
        "mart_conversations": q_mart_conversations,
        "topk_documents": q_topk_documents,
        "topk_documents_hashed": q_topk_documents_hashed,
        "mart_global": q_mart_global,
        "mart_count_only": q_mart_count_only,
        "dimension": q_dimension,
        "dimension_ranged": q_dimension_ranged,
        "fact_star": q_fact_star,
        "fact_star_ranged": q_fact_star_ranged,
        "fact_count_only": q_fact_count_only,
        "star_join": q_star_join,
        "layer_preview": q_layer_preview,
        "catalog_columns": q_catalog_columns,
        "catalog_tables": q_catalog_tables,
        "layer_tables_fact": q_layer_tables_fact,
        "catalog_inspect": q_catalog_inspect,
        "file_analytics": q_file_analytics,
        "analytics_checkpointed": q_analytics_checkpointed,
        "awkward_names": q_awkward_names,
        "report_insights": q_report_insights,
        "report_history_insights": q_report_history_insights,
        "report_numeric_series": q_report_numeric_series,
        "report_category_series": q_report_category_series,
        "report_day_series": q_report_day_series,
        "report_panel": q_report_panel,
        "result_json": q_result_json,
        "run_history_upsert": q_run_history_upsert,
        "run_lookup": q_run_lookup,
        "run_results_replaced": q_run_results_replaced,
        "intake_retries": q_intake_retries,
        "run_failed_rerun": q_run_failed_rerun,
        "table_replaced": q_table_replaced,
        "csv_scan": q_csv_scan,
        "csv_dialects_scan": q_csv_dialects_scan,
        "csv_headers_scan": q_csv_headers_scan,
        "json_braces_scan": q_json_braces_scan,
        "json_documents_scan": q_json_documents_scan,
        "json_lines_scan": q_json_lines_scan,
        "json_array_scan": q_json_array_scan,
        "json_mixed_scan": q_json_mixed_scan,
        "excel_scan": q_excel_scan,
        "ingest_manifest": q_ingest_manifest,
        "streaming_intake": q_streaming_intake,
    }


# ------------------------------------------------------------------ oracles
#
# Schemas of the test tables (names and type classes) are fixed knowledge; the
# classification itself (distinct counts against the limit) is computed in SQL.

SCHEMAS = {
    "lineitem": [
        ("l_orderkey", "num"), ("l_partkey", "num"), ("l_suppkey", "num"),
        ("l_linenumber", "num"), ("l_quantity", "num"), ("l_extendedprice", "num"),
        ("l_discount", "num"), ("l_tax", "num"), ("l_returnflag", "str"),
        ("l_linestatus", "str"), ("l_shipdate", "dt"),
    ],
    "orders": [
        ("o_orderkey", "num"), ("o_custkey", "num"), ("o_orderstatus", "str"),
        ("o_totalprice", "num"), ("o_orderdate", "dt"), ("o_orderpriority", "str"),
    ],
    "events": [
        ("event_id", "num"), ("ts", "dt"), ("user_id", "num"), ("event_type", "str"),
        ("value", "num"), ("props", "str"),
    ],
    "customer": [
        ("c_custkey", "num"), ("c_name", "str"), ("c_nationkey", "num"), ("c_acctbal", "num"),
        ("c_mktsegment", "str"),
    ],
    "labels": [("doc_id", "num"), ("quality", "num"), ("toxic", "num")],
    "documents": [
        ("doc_id", "num"), ("text", "str"), ("lang", "str"), ("source", "str"), ("n_chars", "num"),
    ],
    "conversations": [("conv_id", "num"), ("turn", "num"), ("role", "str"), ("text", "str")],
    "region": [("r_regionkey", "num"), ("r_name", "str")],
    "pages": [("page_id", "num"), ("url", "str"), ("html", "str")],
    "part": [
        ("p_partkey", "num"), ("p_name", "str"), ("p_brand", "str"), ("p_type", "str"),
        ("p_size", "num"), ("p_retailprice", "num"),
    ],
}


def _distinct_sql(c: str) -> str:
    return f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"


def _is_low(c: str, src: str) -> str:
    return f"(SELECT {_distinct_sql(c)} FROM {src}) BETWEEN 1 AND {LIMIT}"


def _profile_sql(table: str) -> str:
    parts = []
    for i, (c, kind) in enumerate(SCHEMAS[table]):
        if kind == "num":
            role = f"CASE WHEN {_is_low(c, table)} THEN 'categorical' ELSE 'numeric' END"
            sub = f"CASE WHEN {_is_low(c, table)} THEN 1 ELSE 0 END"
        elif kind == "dt":
            role, sub = "'datetime'", "0"
        else:
            role, sub = "'categorical'", "0"
        parts.append(
            f"SELECT '{table}' AS table_name, {i} AS ordinal, '{c}' AS column_name, "
            f"{role} AS role, {sub} AS sub"
        )
    body = " UNION ALL ".join(parts)
    return (
        f"SELECT table_name, CAST(ordinal AS INTEGER) AS ordinal, column_name, role, "
        f"CAST(row_number() OVER (PARTITION BY table_name, role ORDER BY sub, ordinal) AS INTEGER) "
        f"AS role_position FROM ({body}) p"
    )


def _stats_sql(select_from: str, cols: list[str], extra: str = "") -> str:
    parts = []
    for i, c in enumerate(cols):
        parts.append(
            f"SELECT {i} AS ord, '{c}' AS column_name, count({c}) AS count, "
            f"avg({c}) AS mean, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
            f"stddev_pop({c}) AS stddev_pop, {_distinct_sql(c)} AS d FROM {select_from}"
        )
    return (
        "SELECT CAST(row_number() OVER (ORDER BY ord) AS INTEGER) AS position, column_name, "
        "count, round(mean, 4) AS mean, round(min, 4) AS min, round(max, 4) AS max, "
        f"round(stddev_pop, 4) AS stddev_pop{extra} FROM ({' UNION ALL '.join(parts)}) s "
        f"WHERE NOT (d BETWEEN 1 AND {LIMIT})"
    )


def _text(c: str, kind: str) -> str:
    return f"CAST({c} AS VARCHAR)" if kind != "str" else c


def _topk_sql(table: str, value_as_double: bool = False, src: str | None = None, cols=None) -> str:
    src = src or table
    cols = cols or SCHEMAS[table]
    parts = []
    for i, (c, kind) in enumerate(cols):
        if kind == "dt":
            continue
        cond = "TRUE" if kind == "str" else _is_low(c, src)
        sub = 0 if kind == "str" else 1
        parts.append(
            f"SELECT {sub} AS sub, {i} AS ord, '{c}' AS column_name, {_text(c, kind)} AS value, "
            f"count(*) AS count FROM {src} WHERE {cond} GROUP BY {c}"
        )
    value = "CAST(value AS DOUBLE)" if value_as_double else "value"
    return (
        f"SELECT * FROM (SELECT '{table}' AS table_name, column_name, "
        "CAST(row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value ASC NULLS LAST) "
        f"AS INTEGER) AS rank, {value} AS value, count FROM ({' UNION ALL '.join(parts)}) c) r "
        "WHERE rank <= 10"
    )


def _trend_sql(grain: str) -> str:
    parts = []
    for table, c in (("orders", "o_orderdate"), ("events", "ts")):
        if grain == "day":
            expr, name = f"CAST({c} AS DATE)", "period"
        elif grain == "month":
            expr, name = f"CAST(date_trunc('month', {c}) AS DATE)", "period"
        else:
            expr, name = f"CAST(year({c}) AS INTEGER)", "year"
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, {expr} AS {name}, "
            f"count(*) AS count FROM {table} GROUP BY 1, 2, 3"
        )
    return " UNION ALL ".join(parts)


def _all_grains_sql(src: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for c, expr in cols:
        parts += [
            f"SELECT '{c}' AS column_name, 'day' AS grain, CAST({expr} AS DATE) AS period, "
            f"count(*) AS count FROM {src} GROUP BY 3",
            f"SELECT '{c}' AS column_name, 'month' AS grain, "
            f"CAST(date_trunc('month', {expr}) AS DATE) AS period, count(*) AS count FROM {src} GROUP BY 3",
            f"SELECT '{c}' AS column_name, 'year' AS grain, "
            f"make_date(CAST(year({expr}) AS INTEGER), 1, 1) AS period, count(*) AS count "
            f"FROM {src} GROUP BY 3",
        ]
    return " UNION ALL ".join(parts)


_NULL_ORDERS = (
    "(SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END AS o_orderdate, "
    "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderdate AS VARCHAR) END AS o_orderdate_text "
    "FROM orders)"
)

_NULL_LINEITEM = (
    "(SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END "
    "AS l_extendedprice, CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_partkey END AS l_partkey "
    "FROM lineitem)"
)


def _fill(c: str, kind: str) -> str:
    if kind == "num":
        return f"COALESCE(CAST({c} AS DOUBLE), 0) AS {c}"
    if kind == "str":
        return f"COALESCE({c}, '(missing)') AS {c}"
    return f"COALESCE(CAST({c} AS VARCHAR), '(missing)') AS {c}"


def _processed_sql(src: str, cols) -> str:
    return f"SELECT DISTINCT {', '.join(_fill(c, k) for c, k in cols)} FROM {src}"


def _mart_sql(src: str, cols, prefix: str = "") -> str:
    nums = [c for c, k in cols if k == "num"]
    key = next((c for c, k in cols if k != "num"), None)
    metrics = ["count(*) AS row_count"]
    metrics += [f"round(sum({c}), 4) AS sum_{c}" for c in nums]
    metrics += [f"round(avg({c}), 4) AS avg_{c}" for c in nums]
    p = f"({_processed_sql(src, cols)}) p"
    if key and nums:
        return f"SELECT {prefix}{key} AS slice_key, {', '.join(metrics)} FROM {p} GROUP BY {key}"
    if nums:
        return f"SELECT {', '.join(metrics)} FROM {p}"
    return f"SELECT count(*) AS row_count FROM {p}"


def _fact_sql(src: str, cols) -> str:
    nums = [c for c, k in cols if k == "num"]
    key = next(c for c, k in cols if k != "num")
    metrics = ["count(*) AS row_count"]
    metrics += [f"round(sum(p.{c}), 4) AS sum_{c}" for c in nums]
    metrics += [f"round(avg(p.{c}), 4) AS avg_{c}" for c in nums]
    p = f"({_processed_sql(src, cols)}) p"
    dim = f"(SELECT row_number() OVER (ORDER BY {key}) AS dim_id, {key} AS category_value FROM (SELECT DISTINCT {key} FROM {p}) d) d"
    return (
        f"SELECT d.dim_id, {', '.join(metrics)} FROM {p} INNER JOIN {dim} "
        f"ON p.{key} = d.category_value GROUP BY d.dim_id"
    )


_DUP_ORDERS = (
    "(SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS o_orderstatus, "
    "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END AS o_totalprice, "
    "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END AS o_orderdate, o_orderpriority FROM orders "
    "UNION ALL SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '(missing)' ELSE o_orderstatus END, "
    "CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 ELSE o_totalprice END, o_orderdate, o_orderpriority FROM orders) x"
)
_DUP_COLS = [("o_orderkey", "num"), ("o_orderstatus", "str"), ("o_totalprice", "num"), ("o_orderdate", "dt"), ("o_orderpriority", "str")]


def _insights_sql(job_id: str = "orders-run", table: str = "orders") -> str:
    """Insight lines computed from the data: roles from distinct counts, then
    numeric -> categorical -> datetime, at most 12 lines."""
    lines = []
    for i, (c, kind) in enumerate(SCHEMAS[table]):
        low = _is_low(c, table)
        if kind == "num":
            lines.append(
                f"SELECT 1 AS section, 0 AS sub, {i} AS pos, 'Numbers: {c}' AS title, "
                "printf('Typical value (mean) is around %.2f. Compare min and max to see spread.', "
                f"(SELECT avg({c}) FROM {table})) AS body WHERE NOT {low}"
            )
        if kind == "str" or kind == "num":
            top = (
                f"(SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {table} GROUP BY 1 "
                "ORDER BY n DESC, v ASC LIMIT 1) t"
            )
            cond = "TRUE" if kind == "str" else low
            lines.append(
                f"SELECT 2, {0 if kind == 'str' else 1}, {i}, 'Categories: {c}', "
                "printf('The most common value is %s, appearing %d times in the sample shown.', v, n) "
                f"FROM {top} WHERE {cond}"
            )
        if kind == "dt":
            lines.append(f"SELECT 3, 0, {i}, 'Time trend: {c}', 'The line shows how many rows fall on each day.'")
    return (
        f"SELECT * FROM (SELECT '{job_id}' AS job_id, "
        "CAST(row_number() OVER (ORDER BY section, sub, pos) AS INTEGER) AS line_no, "
        f"title, body FROM ({' UNION ALL '.join(lines)}) l) x WHERE line_no <= 12"
    )


def _roles_sql(table: str) -> str:
    """(ordinal, column, kind, is_numeric, cat_sub) per column, roles from the data;
    numeric/categorical positions follow the profile order (P4)."""
    parts = []
    for i, (c, kind) in enumerate(SCHEMAS[table]):
        if kind == "num":
            low = _is_low(c, table)
            parts.append(
                f"SELECT {i} AS ordinal, '{c}' AS column_name, CASE WHEN {low} THEN 0 ELSE 1 END AS is_numeric, "
                "1 AS cat_sub"
            )
        elif kind == "str":
            parts.append(f"SELECT {i}, '{c}', 0, 0")
    roles = " UNION ALL ".join(parts)
    return (
        f"SELECT *, CASE WHEN is_numeric = 1 THEN row_number() OVER (PARTITION BY is_numeric ORDER BY ordinal) "
        f"ELSE row_number() OVER (PARTITION BY is_numeric ORDER BY cat_sub, ordinal) END AS pos FROM ({roles}) r"
    )


def _stat_rows_sql(table: str) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, avg({c}) AS mean, CAST(min({c}) AS DOUBLE) AS mn, "
        f"CAST(max({c}) AS DOUBLE) AS mx, stddev_pop({c}) AS sd FROM {table}"
        for c, kind in SCHEMAS[table]
        if kind == "num"
    ]
    return " UNION ALL ".join(parts)


def _top_rows_sql(table: str) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM {table} GROUP BY 2"
        for c, kind in SCHEMAS[table]
        if kind in ("num", "str")
    ]
    return (
        "SELECT column_name, CAST(row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value ASC) "
        f"AS INTEGER) AS rank, value, count FROM ({' UNION ALL '.join(parts)}) t"
    )


def _numeric_series_sql(table: str = "orders") -> str:
    return (
        "SELECT 'orders-run' AS job_id, CAST(r.pos AS INTEGER) AS position, substr(r.column_name, 1, 14) AS label, "
        "round(s.mean, 4) AS average, round(s.mn, 4) AS minimum, round(s.mx, 4) AS maximum "
        f"FROM ({_roles_sql(table)}) r JOIN ({_stat_rows_sql(table)}) s USING (column_name) WHERE r.is_numeric = 1"
    )


def _category_series_sql(table: str = "orders") -> str:
    return (
        "SELECT 'orders-run' AS job_id, t.column_name, t.rank, substr(t.value, 1, 18) AS name, t.count "
        f"FROM ({_top_rows_sql(table)}) t JOIN ({_roles_sql(table)}) r USING (column_name) "
        "WHERE r.is_numeric = 0 AND t.rank <= 10"
    )


def _panel_sql(table: str = "orders") -> str:
    roles = f"({_roles_sql(table)})"
    head = (
        f"(SELECT count(*) FROM {table}) AS rows_processed, "
        f"(SELECT count(*) FROM {roles} x WHERE is_numeric = 1) AS numeric_columns, "
        f"(SELECT count(*) FROM {roles} x WHERE is_numeric = 0) AS categorical_columns"
    )
    nums = (
        "SELECT 'numeric' AS kind, CAST(r.pos AS INTEGER) AS block_no, r.column_name, round(s.mean, 4) AS mean, "
        "round(s.mn, 4) AS min, round(s.mx, 4) AS max, round(s.sd, 4) AS stddev_pop, "
        "CAST(NULL AS VARCHAR) AS most_frequent, CAST(NULL AS BIGINT) AS count "
        f"FROM {roles} r JOIN ({_stat_rows_sql(table)}) s USING (column_name) WHERE r.is_numeric = 1 AND r.pos <= 6"
    )
    cats = (
        "SELECT 'categorical', CAST(r.pos AS INTEGER), r.column_name, NULL, NULL, NULL, NULL, t.value, t.count "
        f"FROM {roles} r JOIN ({_top_rows_sql(table)}) t USING (column_name) "
        "WHERE r.is_numeric = 0 AND r.pos <= 6 AND t.rank = 1"
    )
    return f"SELECT 'orders-run' AS job_id, {head}, b.* FROM ({nums} UNION ALL {cats}) b"


def _runs_sql(ids) -> str:
    rows = {
        "job-a": "SELECT 'job-a' AS job_id, 'orders.parquet' AS filename, 'parquet' AS format, 'ok' AS status, "
        "(SELECT count(*) FROM orders) AS row_count",
        "job-b": "SELECT 'job-b' AS job_id, 'customer.parquet' AS filename, 'parquet' AS format, 'ok' AS status, "
        "(SELECT count(*) FROM customer) AS row_count",
    }
    return " UNION ALL ".join(rows[i] for i in ids)


def _inspect_sql() -> str:
    slug = "part_5eed00000000"
    nums = ["sum_p_partkey", "sum_p_size", "sum_p_retailprice", "avg_p_partkey", "avg_p_size", "avg_p_retailprice"]
    metrics = ", ".join(f"{m}: double" for m in nums)
    tables = [
        ("raw_data", f"raw_{slug}",
         "p_partkey: bigint, p_name: string, p_brand: string, p_type: string, p_size: int, p_retailprice: double"),
        ("processed", f"processed_{slug}",
         "p_partkey: double, p_name: string, p_brand: string, p_type: string, p_size: double, p_retailprice: double"),
        ("analytics", f"analytics_{slug}", f"slice_key: string, row_count: bigint, {metrics}"),
        ("analytics", f"dim_{slug}", "dim_id: bigint, category_value: string"),
        ("analytics", f"fact_{slug}", f"dim_id: bigint, row_count: bigint, {metrics}"),
    ]
    rows = ", ".join(f"('{layer}', '{t}', '{cols}', 5, CAST(NULL AS VARCHAR))" for layer, t, cols in tables)
    return f"SELECT * FROM (VALUES {rows}) AS t(layer, table_name, columns, sample_rows, error)"


def _replaced_sql() -> str:
    """Columns of customer by kind; numbers of few distinct values count as categorical."""
    nums, others = ["c_custkey", "c_nationkey", "c_acctbal"], ["c_name", "c_mktsegment"]
    parts = [f"SELECT 'profile' AS kind, '{c}' AS column_name" for c in nums + others]
    for c in nums:
        d = f"(SELECT {_distinct_sql(c)} FROM customer)"
        parts.append(f"SELECT CASE WHEN {d} BETWEEN 1 AND {LIMIT} THEN 'top_values' ELSE 'numeric_stats' END, '{c}'")
    parts += [f"SELECT 'top_values', '{c}'" for c in others]
    return (
        f"SELECT kind, column_name, CAST(NULL AS BIGINT) AS row_count FROM ({' UNION ALL '.join(parts)}) p "
        "UNION ALL SELECT 'run', NULL, count(*) FROM customer"
    )


def _result_json_sql() -> str:
    dates = "(SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS d FROM orders) x"
    parts = [
        "SELECT 'row_count' AS section, CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS key, CAST(count(*) AS DOUBLE) AS number FROM orders",
        "SELECT 'explicit nulls', NULL, NULL, 1",
        f"SELECT 'NULL year is last', 'o_orderdate', NULL, 1 FROM {dates} WHERE d IS NULL GROUP BY 1, 2",
        f"SELECT 'year', 'o_orderdate', CAST(year(d) AS VARCHAR), count(*) FROM {dates} GROUP BY year(d)",
        f"SELECT 'month', 'o_orderdate', coalesce(strftime(date_trunc('month', d), '%Y-%m-%d'), 'None'), count(*) FROM {dates} GROUP BY date_trunc('month', d)",
    ]
    for c in ("o_orderkey", "o_custkey", "o_totalprice", "CAST(NULL AS DOUBLE)"):
        name = c if c.startswith("o_") else "o_nothing"
        for key, f in (("count", "count"), ("mean", "avg"), ("min", "min"), ("max", "max"), ("stddev_pop", "stddev_pop")):
            parts.append(f"SELECT 'numeric', '{name}', '{key}', round(CAST({f}({c}) AS DOUBLE), 4) FROM orders")
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    found = _library_oracle_sql()
    if _llm is not None:
        found |= _llm.ORACLE_SQL | ({"pipeline": _pipeline.ORACLE_SQL} if _pipeline.ORACLE_SQL else {})
    return found


def _library_oracle_sql() -> dict[str, str]:
    row_counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES
    )
    li_nums = [c for c, k in SCHEMAS["lineitem"] if k == "num"]
    or_nums = [c for c, k in SCHEMAS["orders"] if k == "num"]
    return {
        "profile_roles": " UNION ALL ".join(
            _profile_sql(t) for t in ("lineitem", "orders", "events")
        ),
        "profile_string_datetime": (
            "SELECT 'o_orderdate_text' AS column_name, CASE WHEN count(CASE WHEN o_orderkey > "
            "0.9 * (SELECT max(o_orderkey) FROM orders) THEN TRY_CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) END) > 0 "
            "THEN 'datetime' ELSE 'categorical' END AS role FROM orders"
            + "".join(
                f" UNION ALL SELECT '{c}', CASE WHEN count(TRY_CAST({v} AS TIMESTAMP)) > 0 THEN 'datetime' ELSE 'categorical' END FROM orders"
                for c, v in [(c, f"('n' || {c})") for c in ("o_orderkey", "o_custkey", "o_totalprice")]
                + [(c, c) for c in ("o_orderpriority", "o_orderstatus")]
            )
        ),
        "row_count_all": row_counts,
        "numeric_stats": _stats_sql("lineitem", li_nums),
        "numeric_stats_nulls": _stats_sql(_NULL_LINEITEM + " x", ["l_orderkey", "l_extendedprice", "l_partkey"]),
        "numeric_stats_fused": _stats_sql(
            "orders", or_nums, ", (SELECT count(*) FROM orders) AS row_count"
        ),
        "categorical_topk": _topk_sql("orders") + " UNION ALL " + _topk_sql("part"),
        "categorical_topk_numeric": (
            "SELECT column_name, rank, value, count FROM ("
            + _topk_sql(
                "lineitem",
                value_as_double=True,
                cols=[("l_quantity", "num"), ("l_discount", "num"), ("l_tax", "num"), ("l_linenumber", "num")],
            )
            + ") t"
        ),
        "trend_day": _trend_sql("day"),
        "trend_first_periods": (
            "SELECT grain, period, count FROM (SELECT 'month' AS grain, 1 AS g, CAST(date_trunc('month', d) AS DATE) AS period, count(*) AS count "
            "FROM (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS d FROM orders) GROUP BY 3 UNION ALL "
            "SELECT 'year', 2, make_date(CAST(year(d) AS INTEGER), 1, 1), count(*) "
            "FROM (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS d FROM orders) GROUP BY 3) "
            f"ORDER BY g, period NULLS LAST LIMIT {FIRST_PERIODS}"
        ),
        "profile_sampled": (
            "SELECT * FROM (VALUES ('o_orderstatus', 'categorical'), ('o_orderpriority', 'categorical'), ('o_orderdate', 'datetime')) v(column_name, role)"
            + "".join(
                f" UNION ALL SELECT '{c}', CASE WHEN count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) "
                f"<= {LIMIT} THEN 'categorical' ELSE 'numeric' END FROM orders"
                for c in ("o_orderkey", "o_custkey", "o_totalprice")
            )
        ),
        "trend_month": _trend_sql("month"),
        "trend_year": _trend_sql("year"),
        "trend_all_grains": _all_grains_sql("orders", [("o_orderdate", "o_orderdate")]),
        "trend_null_bucket": _all_grains_sql(
            _NULL_ORDERS + " x",
            [("o_orderdate", "o_orderdate"), ("o_orderdate_text", "CAST(o_orderdate_text AS TIMESTAMP)")],
        ),
        "standardized_columns": (
            "SELECT c_custkey AS cust_key, c_name AS cust_key_2, c_nationkey AS c_2nd, "
            "c_acctbal AS \"column\", c_mktsegment AS a, c_custkey AS a_2, c_name AS a_2_2 FROM customer"
        ),
        "processed_layer": _processed_sql(_DUP_ORDERS, _DUP_COLS),
        "layer_reconciliation": (
            f"SELECT (SELECT count(*) FROM {_DUP_ORDERS}) AS raw_rows, "
            f"(SELECT count(*) FROM ({_processed_sql(_DUP_ORDERS, _DUP_COLS)}) p) AS processed_rows, "
            f"(SELECT count(*) FROM {_DUP_ORDERS}) - (SELECT count(*) FROM ({_processed_sql(_DUP_ORDERS, _DUP_COLS)}) p) "
            "AS duplicates_removed"
        ),
        "mart_grouped": _mart_sql("lineitem", SCHEMAS["lineitem"]),
        "mart_grouped_orders": _mart_sql("orders", SCHEMAS["orders"]),
        "mart_grouped_highcard": _mart_sql("events", SCHEMAS["events"]),
        "mart_documents_text": _mart_sql("documents", SCHEMAS["documents"]),
        "mart_conversations": _mart_sql("conversations", SCHEMAS["conversations"]),
        "topk_documents": _topk_sql("documents"),
        "topk_documents_hashed": _topk_sql("documents"),
        "mart_global": _mart_sql("labels", SCHEMAS["labels"]),
        "mart_count_only": _mart_sql("orders", [("o_orderstatus", "str"), ("o_orderpriority", "str")]),
        "dimension": (
            "SELECT row_number() OVER (ORDER BY c_name) AS dim_id, c_name AS category_value "
            f"FROM (SELECT DISTINCT c_name FROM ({_processed_sql('customer', SCHEMAS['customer'])}) p) d"
        ),
        "dimension_ranged": (
            "SELECT row_number() OVER (ORDER BY c_name) AS dim_id, c_name AS category_value "
            f"FROM (SELECT DISTINCT c_name FROM ({_processed_sql('customer', SCHEMAS['customer'])}) p) d"
        ),
        "fact_star": _fact_sql("lineitem", SCHEMAS["lineitem"]),
        "fact_star_ranged": _fact_sql("orders", SCHEMAS["orders"]),
        "fact_count_only": _fact_sql("pages", [("url", "str")]),
        "star_join": _fact_sql("orders", SCHEMAS["orders"]),
        "layer_preview": (
            f"SELECT * FROM ({_processed_sql('orders', SCHEMAS['orders'])}) p ORDER BY o_orderkey LIMIT 10"
        ),
        "layer_tables_fact": _fact_sql("orders", SCHEMAS["orders"]),
        "file_analytics": _topk_sql("part"),
        "analytics_checkpointed": _topk_sql("orders"),
        "awkward_names": (
            "SELECT column_name, rank, value, count FROM ("
            + _topk_sql(
                "orders",
                cols=[("o_orderstatus", "str"), ("o_orderpriority", "str")],
            ).replace("'o_orderstatus'", "'order.status'").replace("'o_orderpriority'", "'order `priority`'")
            + ") t"
        ),
        # Catalog metadata follows from the layer rules: numbers become DOUBLE,
        # text stays STRING; the check slug is "<table>_5eed00000000".
        "catalog_columns": (
            "SELECT * FROM (VALUES (1, 'c_custkey', 'double'), (2, 'c_name', 'string'), "
            "(3, 'c_nationkey', 'double'), (4, 'c_acctbal', 'double'), (5, 'c_mktsegment', 'string')) "
            "AS t(ordinal, column_name, data_type)"
        ),
        "catalog_tables": (
            "SELECT * FROM (VALUES ('analytics', 'analytics_supplier_5eed00000000'), "
            "('analytics', 'dim_supplier_5eed00000000'), ('analytics', 'fact_supplier_5eed00000000'), "
            "('processed', 'processed_supplier_5eed00000000'), ('raw_data', 'raw_supplier_5eed00000000')) "
            "AS t(layer, table_name)"
        ),
        "catalog_inspect": _inspect_sql(),
        "report_insights": _insights_sql(),
        "report_history_insights": (
            _insights_sql("hist-orders", "orders") + " UNION ALL " + _insights_sql("hist-customer", "customer")
        ),
        "report_numeric_series": _numeric_series_sql(),
        "report_category_series": _category_series_sql(),
        "report_day_series": (
            "SELECT 'orders-run' AS job_id, 'o_orderdate' AS column_name, CAST(o_orderdate AS DATE) AS day, "
            "count(*) AS count FROM orders GROUP BY 3"
        ),
        "report_panel": _panel_sql(),
        "run_history_upsert": _runs_sql(["job-a", "job-b"]),
        "run_lookup": _runs_sql(["job-b"]),
        "run_results_replaced": _replaced_sql(),
        "result_json": _result_json_sql(),
        "intake_retries": "SELECT 'done' AS state, 1 AS attempt, 'ok' AS status, 2 AS files, count(*) AS row_count FROM customer "
        "UNION ALL SELECT 'dead', 3, 'failed', count(DISTINCT n_regionkey), NULL FROM nation WHERE n_regionkey IN (0, 1)",
        "run_failed_rerun": "SELECT 'again' AS job_id, 'failed' AS status, CAST(NULL AS BIGINT) AS row_count, CAST(NULL AS VARCHAR) AS kinds "
        "UNION ALL SELECT 'stays', 'ok', count(*), 'numeric_stats,profile,top_values' FROM customer",
        "table_replaced": "SELECT p_brand, sum(p_size) + 1 AS size, count(*) OVER () AS n_rows FROM part GROUP BY p_brand",
        "csv_scan": "SELECT * FROM customer",
        "csv_dialects_scan": PART_NOTES_SQL,
        "csv_headers_scan": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 1 THEN o_custkey END AS o_custkey, "
        "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus, o_totalprice, "
        "CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority FROM orders",
        "json_braces_scan": PART_NOTES_SQL,
        "json_documents_scan": PART_NOTES_SQL,
        "json_lines_scan": "SELECT * FROM part",
        "json_array_scan": "SELECT * FROM supplier",
        "json_mixed_scan": "SELECT * FROM supplier",
        "excel_scan": "SELECT * FROM supplier",
        "ingest_manifest": (
            "SELECT *, CASE WHEN name = '(orders parts)' THEN (SELECT count(*) FROM orders) END AS rows FROM (VALUES "
            "('nation.csv', 'nation.csv', 'csv', true, NULL), "
            "('nation.json', 'nation.json', 'json', true, NULL), "
            "('nation.pq', 'nation.pq', 'parquet', true, NULL), "
            "('nation.parquet', 'nation.parquet', 'parquet', true, NULL), "
            "('nation.xlsx', 'nation.xlsx', 'excel', true, NULL), "
            "('nation.xls', 'nation.xls', 'excel', false, 'Legacy .xls workbooks are not supported; save the sheet as .xlsx.'), "
            "('nation.txt', 'nation.txt', 'csv', false, 'Extension not allowed. Allowed: [''.csv'', ''.json'', ''.parquet'', ''.pq'', ''.xls'', ''.xlsx'']'), "
            "('nation', 'nation', 'json', false, 'File must have an extension.'), "
            "('nation.dat', 'nation.dat', 'parquet', false, 'Extension not allowed. Allowed: [''.csv'', ''.json'', ''.parquet'', ''.pq'', ''.xls'', ''.xlsx'']'), "
            "('bad..name.csv', 'bad..name.csv', 'csv', false, 'Invalid filename.'), "
            "('Nation Data.csv', 'Nation_Data.csv', 'csv', true, NULL), "
            "('nation_wide.csv', 'nation_wide.csv', 'csv', false, 'File exceeds 0 MB limit'), "
            "('(orders parts)', '(orders parts)', 'csv', true, NULL)"
            ") AS t(name, safe_name, format, accepted, reject_reason)"
        ),
        "streaming_intake": (
            "SELECT 'csv' AS format, 'ok' AS status, (SELECT count(*) FROM nation) AS row_count "
            "UNION ALL SELECT 'json', 'ok', (SELECT count(*) FROM region) "
            "UNION ALL SELECT 'parquet', 'ok', (SELECT count(*) FROM customer)"
        ),
    }
