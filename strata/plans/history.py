"""Run history as a log of commits.

Rows of every kind (the run record, profile, statistics, top values, trends)
are appended to ``<path>/<kind>/bucket=<b>/home=<h>``; a job's bucket is a hash
of its id, a home is the day of the append or a compaction. Rows carry the id
of the commit that they belong to. A commit record, written last and in one
file, makes them visible: a reader takes the newest commit of every job and
only that commit's rows, so

* a reader sees all of a job's rows or none, also while it is written again,
* what a later run does not write (a failed one has no results) is gone,
* writing the same job again replaces its record, whatever happened before,
* jobs are written side by side without a lock.

The newest commit has the highest version (one more than the writer saw), then
the most moves by compactions, then the highest id. :meth:`RunLog.compact`
copies what is visible to a new home and commits the move; :meth:`RunLog.vacuum`
deletes homes that nothing visible lies in. The number of folders follows the
buckets and the days since the last vacuum, not the jobs.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.files import delete, move_into

COMMITS = "commits"
COMMIT_COLUMNS = "job_id STRING, version BIGINT, moves INT, commit_id STRING, committed_at TIMESTAMP"
_PLACE = "bucket INT, home STRING"
BUCKETS = 64


def _names(columns: str) -> list[str]:
    return [c.split()[0] for c in columns.split(", ")]


@dataclass
class RunLog:
    """The log under ``path``; ``kinds`` gives the columns (DDL, job_id among them) of every kind of rows."""

    spark: SparkSession
    path: str
    kinds: dict[str, str]
    buckets: int = BUCKETS

    def _bucket(self, job_id):
        return F.pmod(F.xxhash64(job_id), F.lit(self.buckets)).cast("int")

    def _read(self, kind: str, columns: str) -> DataFrame:
        """Rows as they lie there; a kind never written is empty."""
        schema = f"{columns}, {_PLACE}"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _append(self, kind: str, rows: DataFrame) -> None:
        staging = f"{self.path}/_staging/{uuid.uuid4().hex}"
        rows.write.partitionBy("bucket", "home").parquet(staging)
        move_into(self.spark, staging, f"{self.path}/{kind}")

    def newest(self, job_id: str | None = None) -> DataFrame:
        """(job_id, bucket, version, moves, commit_id, home): the newest commit of every job, or of one."""
        commits = self._read(COMMITS, COMMIT_COLUMNS)
        if job_id is not None:  # one bucket is read
            commits = commits.filter((F.col("bucket") == self._bucket(F.lit(job_id))) & (F.col("job_id") == job_id))
        last = F.max(F.struct("version", "moves", "commit_id", "home")).alias("last")
        return commits.groupBy("job_id", "bucket").agg(last).select("job_id", "bucket", "last.*")

    def visible(self, kind: str, job_id: str | None = None, newest: DataFrame | None = None) -> DataFrame:
        """The rows of a kind in the newest commit of every job, or of one.

        Readers of several kinds pass one ``newest`` to all, so that they see one commit of a job.
        """
        newest = (self.newest(job_id) if newest is None else newest).select("job_id", "bucket", "commit_id", "home")
        # Files are listed after the commits, so every listed commit finds its rows.
        rows = self._read(kind, f"{self.kinds[kind]}, commit_id STRING")
        if job_id is not None:
            rows = rows.filter((F.col("bucket") == self._bucket(F.lit(job_id))) & (F.col("job_id") == job_id))
        return rows.join(newest, ["job_id", "bucket", "commit_id", "home"]).select(*_names(self.kinds[kind]))

    # -------------------------------------------------------- writing

    def begin(self) -> Commit:
        return Commit(self, uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc).strftime("d%Y%m%d"))

    def compact(self) -> None:
        """Copies everything visible to one new home: a file a bucket and kind."""
        home = f"c{uuid.uuid4().hex}"
        newest = self.newest()
        for kind, columns in self.kinds.items():
            rows = self._read(kind, f"{columns}, commit_id STRING")
            kept = rows.join(newest.select("job_id", "bucket", "commit_id", "home"), ["job_id", "bucket", "commit_id", "home"])
            kept = kept.select(*_names(columns), "commit_id", "bucket", F.lit(home).alias("home"))
            self._append(kind, kept.repartition("bucket"))
        moved = newest.select(
            "job_id", "version", (F.col("moves") + 1).alias("moves"), "commit_id", F.current_timestamp().alias("committed_at"), "bucket", F.lit(home).alias("home")
        )
        self._append(COMMITS, moved.repartition("bucket"))

    def vacuum(self, older_than: dt.timedelta = dt.timedelta(days=1)) -> int:
        """Deletes homes without a visible commit whose last commit is older; gives their number.

        ``older_than`` must be longer than any write or read takes: a writer may
        still be about to commit to its home, a reader about to open its files.
        """
        commits = self._read(COMMITS, COMMIT_COLUMNS)
        last = commits.groupBy("bucket", "home").agg(F.max("committed_at").alias("last"))
        limit = dt.datetime.now(dt.timezone.utc) - older_than
        live = self.newest().select("bucket", "home").distinct()
        dead = last.filter(F.col("last") < F.lit(limit)).join(live, ["bucket", "home"], "left_anti").select("bucket", "home").collect()
        for r in dead:  # buckets times homes since the last vacuum; the commits go last
            for kind in (*self.kinds, COMMITS):
                delete(self.spark, f"{self.path}/{kind}/bucket={r['bucket']}/home={r['home']}")
        return len(dead)


@dataclass
class Commit:
    """Rows on their way into the log: :meth:`add` them kind by kind, then :meth:`publish`."""

    log: RunLog
    commit_id: str
    home: str

    def add(self, kind: str, rows: DataFrame) -> DataFrame:
        """Appends rows of a kind (not visible yet) and gives them as they were written."""
        columns = self.log.kinds[kind]
        own = rows.select(*_names(columns)).withColumn("commit_id", F.lit(self.commit_id))
        self.log._append(kind, own.withColumn("bucket", self.log._bucket("job_id")).withColumn("home", F.lit(self.home)))
        written = self.log._read(kind, f"{columns}, commit_id STRING")
        return written.filter((F.col("commit_id") == self.commit_id) & (F.col("home") == self.home)).select(*_names(columns))

    def publish(self, jobs: DataFrame) -> None:
        """Makes the rows of ``jobs`` (job_id) visible, and nothing else of these jobs."""
        jobs = jobs.select("job_id").distinct().withColumn("bucket", self.log._bucket("job_id"))
        known = self.log.newest().select("job_id", "version")
        self._record(jobs.join(known, "job_id", "left"))

    def publish_one(self, job_id: str) -> None:
        """:meth:`publish` for one job; reads one bucket of commits."""
        known = self.log.newest(job_id).agg(F.max("version").alias("version"))
        self._record(known.select(F.lit(job_id).alias("job_id"), self.log._bucket(F.lit(job_id)).alias("bucket"), "version"))

    def _record(self, jobs: DataFrame) -> None:
        record = jobs.select(
            "job_id", (F.coalesce("version", F.lit(0)) + 1).cast("long").alias("version"), F.lit(0).alias("moves"),
            F.lit(self.commit_id).alias("commit_id"), F.current_timestamp().alias("committed_at"), "bucket", F.lit(self.home).alias("home"),
        )
        self.log._append(COMMITS, record)
