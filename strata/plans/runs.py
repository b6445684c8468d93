"""Run history (K6, T7) and the upload job.

The record of a run and its long-form results (profile, statistics, top values,
trends; reports R1-R5 run over all of them at once) are one commit of the log
in :mod:`strata.plans.history`: writing the same job again replaces all of it,
a reader sees all of a run or nothing, and a failed run leaves no rows of the
run before.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.naming import make_slug
from strata.plans import report
from strata.plans.analytics import Analytics, analyze
from strata.plans.history import RunLog
from strata.plans.warehouse import RAW, LayerRun, Warehouse, build_layers, spread_if_narrow
from strata.sources.manifest import detect_format_of_path, validate_filename
from strata.sources.readers import load

log = logging.getLogger("strata.runs")

RUN_COLUMNS = (
    "job_id STRING, created_at TIMESTAMP, filename STRING, format STRING, "
    "input_storage_uri STRING, input_stage_label STRING, row_count BIGINT, status STRING, "
    "warehouse_type STRING, warehouse_detail STRING, bq_table STRING, result_json STRING"
)
RESULT_KINDS = ("profile", "numeric_stats", "top_values", "trends")
RESULT_SCHEMAS = {
    "profile": "job_id STRING, ordinal INT, column_name STRING, data_type STRING, role STRING, "
    "role_position INT, distinct_count BIGINT, reason STRING",
    "numeric_stats": "job_id STRING, position INT, column_name STRING, count BIGINT, mean DOUBLE, "
    "min DOUBLE, max DOUBLE, stddev_pop DOUBLE",
    "top_values": "job_id STRING, position INT, column_name STRING, rank INT, value STRING, count BIGINT",
    "trends": "job_id STRING, position INT, column_name STRING, grain STRING, period DATE, count BIGINT",
}

# Fixed values (job states of the reference's upload job).
QUEUED, RUNNING, COMPLETED, FAILED = "queued", "running", "completed", "failed"
WAREHOUSE_TYPE = "Parquet tables (Spark catalog)"


def latest_per_job(records: DataFrame) -> DataFrame:
    """Batch form of the upsert: keep the newest record of each ``job_id``."""
    w = Window.partitionBy("job_id").orderBy(F.col("created_at").desc_nulls_last())
    return records.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


@dataclass
class RunHistory:
    spark: SparkSession
    path: str

    @classmethod
    def default(cls, spark: SparkSession) -> RunHistory:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        return cls(spark, base + "/strata_runs")

    @property
    def log(self) -> RunLog:
        return RunLog(self.spark, self.path, {"runs": RUN_COLUMNS, **RESULT_SCHEMAS})

    def upsert(self, records: DataFrame) -> None:
        """K6: insert or replace the jobs in ``records`` (the newest record of each; results of an earlier run go)."""
        commit = self.log.begin()
        commit.publish(commit.add("runs", latest_per_job(records)))

    def put(self, job_id: str, record: DataFrame) -> None:
        """K6 for one job that has no results."""
        commit = self.log.begin()
        commit.add("runs", latest_per_job(record.filter(F.col("job_id") == F.lit(job_id))))
        commit.publish_one(job_id)

    def runs(self) -> DataFrame:
        return self.log.visible("runs")

    def results(self, kind: str) -> DataFrame:
        return self.log.visible(kind)

    def lookup(self, job_id: str) -> DataFrame:
        """The record of one job (zero or one row); reads one bucket."""
        return self.log.visible("runs", job_id)

    def report_frames(self) -> dict[str, DataFrame]:
        """Inputs of the report derivations (R1-R5) for every recorded run."""
        newest = self.log.newest()
        frames = {kind: self.log.visible(kind, newest=newest) for kind in RESULT_KINDS}
        frames["runs"] = self.log.visible("runs", newest=newest).select("job_id", "status", "row_count")
        return frames


def run_record(
    spark: SparkSession,
    job_id: str,
    filename: str,
    fmt: str,
    uri: str,
    status: str,
    result_json: DataFrame | None,
    row_count: int | None,
    stage_label: str = "",
    warehouse_detail: str = "",
) -> DataFrame:
    now = dt.datetime.now(dt.timezone.utc)  # aware: the same instant in any session zone
    meta = spark.createDataFrame(
        [(job_id, now, filename, fmt, uri, stage_label, row_count, status, WAREHOUSE_TYPE, warehouse_detail, None)],
        "job_id STRING, created_at TIMESTAMP, filename STRING, format STRING, input_storage_uri STRING, "
        "input_stage_label STRING, row_count BIGINT, status STRING, warehouse_type STRING, "
        "warehouse_detail STRING, bq_table STRING",
    )
    if result_json is None:
        return meta.withColumn("result_json", F.lit(None).cast("string"))
    return meta.join(result_json, "job_id", "left")


@dataclass
class JobResult:
    job_id: str
    status: str
    filename: str
    format: str | None = None
    analytics: Analytics | None = None
    layers: LayerRun | None = None
    error: str | None = None
    progress: list[tuple[str, int]] = field(default_factory=list)

    def to_dict(self) -> dict[str, Any]:
        return {
            "job_id": self.job_id,
            "status": self.status,
            "filename": self.filename,
            "format": self.format,
            "row_count": self.analytics.row_count if self.analytics else None,
            "warehouse_layers": self.layers.to_dict() if self.layers else None,
            "error": self.error,
        }


def run_job(
    spark: SparkSession,
    path: str,
    history: RunHistory | None = None,
    warehouse: Warehouse | None = None,
    job_id: str | None = None,
    filename: str | None = None,
    fmt: str | None = None,
    size: int | None = None,
    options: dict[str, str] | None = None,
    schema: str | None = None,
    **analyze_args: Any,
) -> JobResult:
    """validate -> detect -> load -> analyse (F1) -> run history (K6) ->
    layered warehouse (F3). A warehouse failure does not fail the job; any other
    failure records the job as failed. ``options``/``schema`` go to the reader
    (a DDL schema skips the type-inference pass over CSV/JSON input)."""
    job_id = job_id or str(uuid.uuid4())
    filename = filename or path.rstrip("/").split("/")[-1]
    history = history or RunHistory.default(spark)
    result = JobResult(job_id, QUEUED, filename)
    # Progress in percent: fixed values (as the upload job reports them).
    result.progress.append((QUEUED, 0))
    ok, safe_or_reason = validate_filename(filename, size)
    if not ok:
        result.status, result.error = FAILED, safe_or_reason
        history.put(job_id, run_record(spark, job_id, filename, fmt or "", path, FAILED, None, None, warehouse_detail=safe_or_reason))
        return result
    try:
        result.status = RUNNING
        result.progress.append((RUNNING, 10))
        kind = fmt or detect_format_of_path(spark, path)
        result.format = kind
        df = load(spark, path, kind, options, schema)
        slug = make_slug(safe_or_reason, job_id)
        wh = warehouse or Warehouse(spark)
        # The raw layer is the input parsed once into Parquet; every later pass
        # (profile, statistics, counts, layers) reads only the columns it needs.
        source, raw_rows = df, None
        try:
            wh.ensure_layers()
            source, raw_rows = wh.replace(spread_if_narrow(df), RAW, f"raw_{slug}")
        except Exception as exc:
            log.warning("raw layer not written for %s: %s", job_id, exc)
        result.progress.append((RUNNING, 40))
        analytics = analyze(source, **analyze_args)
        result.analytics = analytics
        result.progress.append((RUNNING, 55))
        commit = history.log.begin()
        frames = report.result_frames(spark, analytics, job_id)
        saved = {kind: commit.add(kind, frames[kind]) for kind in RESULT_KINDS}
        saved["runs"] = report.runs_frame(spark, job_id, analytics)
        doc = report.result_json(spark, analytics, job_id, saved)
        n_rows = analytics.row_count if analytics.status == "ok" else None
        commit.add("runs", run_record(spark, job_id, safe_or_reason, kind, path, analytics.status, doc, n_rows))
        commit.publish_one(job_id)
        result.progress.append((RUNNING, 85))
        result.layers = build_layers(wh, source, slug, raw_rows=raw_rows)
        result.status = COMPLETED
        result.progress.append((COMPLETED, 100))
    except Exception as exc:
        log.exception("job %s failed", job_id)
        result.status, result.error = FAILED, str(exc)
        history.put(
            job_id, run_record(spark, job_id, filename, result.format or "", path, FAILED, None, None, warehouse_detail=str(exc)[:500])
        )
    return result
