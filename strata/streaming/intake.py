"""Continuous intake (F6): every file that lands in a folder is processed once.

A Structured Streaming ``binaryFile`` source lists new files (``content`` is
never selected, so only metadata is read); each micro-batch is a manifest
(S7/S8/T8) and every accepted file runs the upload job (F4).

The stream checkpoint records which files were handed out; what became of them
stands in a ledger of attempts beside the run history (a log of commits like
it, so the newest attempt of a file counts). A job that failed is tried again
by the next micro-batch and the next run, ``MAX_ATTEMPTS`` times in all, then
it is dead: a dead letter with its last error. A file that the intake rules
reject is dead at once. A file that is done is not run again, also when a
micro-batch is replayed after a failure; the job id follows from path and
modification time, so an attempt replaces what the one before left in the history.

``maxFilesPerTrigger`` bounds the manifest that a micro-batch handles (the
driver only iterates over file *names*; each dataset is its own distributed
job, several of them run side by side).
"""

from __future__ import annotations

import datetime as dt
import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strata.plans.history import RunLog
from strata.plans.runs import FAILED, RunHistory, run_job, run_record
from strata.plans.warehouse import Warehouse
from strata.sources.manifest import manifest

log = logging.getLogger("strata.intake")

DEFAULT_MAX_FILES_PER_TRIGGER = 100
DEFAULT_PARALLEL_JOBS = 4
# The fixed schema of the binaryFile source (a stream must declare it).
BINARY_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def landed_files(spark: SparkSession, landing: str, max_files: int = DEFAULT_MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Streaming listing ``(path, length, modificationTime)`` of ``landing``."""
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files))
        .load(landing)
        .select("path", "length", "modificationTime")
    )


# States of a file in the ledger.
PENDING, DONE, DEAD = "pending", "done", "dead"
MAX_ATTEMPTS = 3
ATTEMPTS = "attempts"
ATTEMPT_COLUMNS = (
    "job_id STRING, path STRING, name STRING, format STRING, length BIGINT, attempt INT, state STRING, error STRING, tried_at TIMESTAMP"
)


@dataclass
class Ledger:
    """Attempts at the files of an intake, the newest of each file."""

    spark: SparkSession
    path: str

    @classmethod
    def of(cls, history: RunHistory) -> Ledger:
        return cls(history.spark, f"{history.path}/intake")

    @property
    def log(self) -> RunLog:
        return RunLog(self.spark, self.path, {ATTEMPTS: ATTEMPT_COLUMNS})

    def files(self) -> DataFrame:
        return self.log.visible(ATTEMPTS)

    def dead_letters(self) -> DataFrame:
        """Files that are given up, with their last error."""
        return self.files().filter(F.col("state") == DEAD).select("job_id", "path", "name", "attempt", "error", "tried_at")

    def pending(self, before: dt.datetime) -> list[Row]:
        """Files that failed and are to be tried again, last tried before the given time."""
        found = self.files().filter((F.col("state") == PENDING) & (F.col("tried_at") < F.lit(before)))
        return found.orderBy("tried_at", "path").collect()  # names of failed files

    def state_of(self, job_ids: list[str]) -> dict[str, Row]:
        if not job_ids:
            return {}
        return {r["job_id"]: r for r in self.files().filter(F.col("job_id").isin(job_ids)).collect()}  # a micro-batch's files

    def record(self, entry: Row, attempt: int, state: str, error: str | None) -> None:
        row = (entry["job_id"], entry["path"], entry["name"], entry["format"], entry["length"], attempt, state, error)
        now = dt.datetime.now(dt.timezone.utc)
        commit = self.log.begin()
        commit.add(ATTEMPTS, self.spark.createDataFrame([(*row, now)], ATTEMPT_COLUMNS))
        commit.publish_one(entry["job_id"])


class Intake:
    """Runs the upload jobs of manifest entries and keeps the ledger."""

    def __init__(
        self,
        history: RunHistory,
        warehouse: Warehouse | None = None,
        max_bytes: int | None = None,
        parallel_jobs: int = DEFAULT_PARALLEL_JOBS,
        max_attempts: int = MAX_ATTEMPTS,
        **job_args,
    ):
        self.history, self.warehouse, self.max_bytes = history, warehouse, max_bytes
        self.parallel_jobs, self.max_attempts, self.job_args = parallel_jobs, max_attempts, job_args
        self.ledger = Ledger.of(history)

    def handle(self, batch: DataFrame, epoch_id: int) -> None:
        """``foreachBatch``: one upload job per accepted file that is not settled, then the failed files of earlier batches."""
        started = dt.datetime.now(dt.timezone.utc)
        entries = manifest(batch, max_bytes=self.max_bytes, sniff=False).collect()
        known = self.ledger.state_of([e["job_id"] for e in entries])
        fresh = [(e, known[e["job_id"]]["attempt"] if e["job_id"] in known else 0) for e in entries]
        self._all([(e, n) for e, n in fresh if e["job_id"] not in known or known[e["job_id"]]["state"] == PENDING])
        self.retry(started)
        log.info("intake batch %s: %s files", epoch_id, len(entries))

    def retry(self, before: dt.datetime | None = None) -> int:
        """One more attempt at every file that failed; gives their number."""
        pending = self.ledger.pending(before or dt.datetime.now(dt.timezone.utc))
        self._all([(e, e["attempt"]) for e in pending])
        return len(pending)

    def _all(self, entries: list[tuple[Row, int]]) -> None:
        # Spark runs jobs from several driver threads side by side.
        with ThreadPoolExecutor(max_workers=max(1, self.parallel_jobs)) as pool:
            list(pool.map(lambda e: self._one(*e), entries))

    def _one(self, entry: Row, tried: int) -> None:
        spark = self.history.spark
        known = entry.asDict()
        if not known.get("accepted", True):
            reason = entry["reject_reason"]
            record = run_record(
                spark, entry["job_id"], entry["name"], entry["format"] or "", entry["path"], FAILED, None, None, warehouse_detail=reason
            )
            self.history.put(entry["job_id"], record)
            self.ledger.record(entry, tried + 1, DEAD, reason)
            return
        result = run_job(
            spark,
            entry["path"],
            history=self.history,
            warehouse=self.warehouse,
            job_id=entry["job_id"],
            filename=known.get("safe_name") or entry["name"],
            fmt=entry["format"],
            size=entry["length"],
            **self.job_args,
        )
        failed = result.status == FAILED
        state = DONE if not failed else DEAD if tried + 1 >= self.max_attempts else PENDING
        self.ledger.record(entry, tried + 1, state, result.error if failed else None)
        log.info("intake %s, attempt %s: %s", entry["name"], tried + 1, state)


def run_intake(
    spark: SparkSession,
    landing: str,
    checkpoint_location: str,
    history: RunHistory,
    warehouse: Warehouse | None = None,
    available_now: bool = True,
    max_files: int = DEFAULT_MAX_FILES_PER_TRIGGER,
    max_bytes: int | None = None,
    parallel_jobs: int = DEFAULT_PARALLEL_JOBS,
    max_attempts: int = MAX_ATTEMPTS,
    **job_args,
):
    """Process the files that landed since the last run (``available_now``) or
    keep watching the folder (returns the running query). Files that failed
    before are tried again first."""
    intake = Intake(history, warehouse, max_bytes, parallel_jobs, max_attempts, **job_args)
    intake.retry()
    writer = (
        landed_files(spark, landing, max_files)
        .writeStream.foreachBatch(intake.handle)
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    return writer.start()


def intake_records(history: RunHistory) -> DataFrame:
    """The run-history rows written by the intake, newest state per job."""
    return history.runs().select("job_id", "filename", "format", "status", "row_count", F.col("created_at"))
