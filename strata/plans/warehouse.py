"""Layered warehouse run (F3): raw -> processed -> analytics, plus the star schema.

Each layer is written once as a Parquet table (K2-K5) and the next layer reads
the written table back: the lineage is cut at every layer (a lost executor
re-reads files instead of recomputing the chain), and every later step scans
only the columns it needs. Tables live under an explicit warehouse root (the
session's ``spark.sql.warehouse.dir`` by default — shared storage on a
cluster), registered in the session catalog in three databases.
"""

from __future__ import annotations

import logging
import re
import time
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.naming import quote_sql
from strata.operators.cleaning import processed
from strata.operators.marts import grouped_metrics, mart, mart_shape
from strata.operators.star import star_schema
from strata.sources.files import delete, folders

log = logging.getLogger("strata.warehouse")

# Fixed values (reference's layer names and table prefixes).
RAW, PROCESSED, ANALYTICS = "raw_data", "processed", "analytics"
LAYERS = (RAW, PROCESSED, ANALYTICS)
FLOW = "Input file -> raw_data.raw_<id> -> processed.processed_<id> -> analytics.analytics_<id>"

#: Versions of a table are kept for a day after they were replaced.
KEEP_VERSIONS_NS = 24 * 3600 * 10**9
VERSION = re.compile(r"v\d{20}-[0-9a-f]{8}")


@dataclass
class Warehouse:
    """Where layer tables go: a root folder and an optional database prefix."""

    spark: SparkSession
    root: str | None = None
    prefix: str = ""

    def __post_init__(self) -> None:
        if self.root is None:
            base = self.spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
            self.root = base + "/strata"

    def db(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{quote_sql(self.db(layer))}.{quote_sql(table)}"

    def location(self, layer: str, table: str) -> str:
        return f"{self.root}/{self.db(layer)}.db/{table}"

    def ensure_layers(self) -> None:
        """K1: the three layer databases."""
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {quote_sql(self.db(layer))} "
                f"LOCATION '{self.root}/{self.db(layer)}.db'"
            )

    def write(self, df: DataFrame, layer: str, table: str) -> DataFrame:
        """Replace one layer table (Parquet) and return it read back."""
        return self.replace(df, layer, table)[0]

    def replace(self, df: DataFrame, layer: str, table: str) -> tuple[DataFrame, int]:
        """CREATE OR REPLACE of one layer table: (the table read back, its number of rows).

        The rows go to a folder of their own first; then the catalog entry is
        pointed at it. A write that fails leaves the table as it was, readers
        that have opened it finish on the old files, and ``df`` may read the
        table that it replaces. Rows are counted while they are written.
        """
        home = self.location(layer, table)
        version = f"{home}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        written = Observation()
        df.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(version)
        self._point(self.name(layer, table), version)
        self._forget_old(home, version)
        return self.spark.table(self.name(layer, table)), written.get["rows"]

    def _point(self, name: str, version: str) -> None:
        """The catalog entry now stands for the files of ``version``."""
        if not self.spark.catalog.tableExists(name):
            self.spark.catalog.createTable(name, version, "parquet")
            return
        fields = lambda frame: [(f.name, f.dataType.simpleString()) for f in frame.schema]
        if fields(self.spark.table(name)) == fields(self.spark.read.parquet(version)):
            where = version.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{where}'")  # one change of the catalog
            self.spark.catalog.refreshTable(name)
            return
        # Spark's own catalog cannot change the columns of an entry: it is made anew, or put back.
        old = self.spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]
        self.spark.sql(f"DROP TABLE {name}")  # the files stay: they have a location of their own
        try:
            self.spark.catalog.createTable(name, version, "parquet")
        except Exception:
            self.spark.catalog.createTable(name, old, "parquet")
            raise

    def _forget_old(self, home: str, version: str) -> None:
        """Deletes versions that were replaced long ago (readers and slower writers have ended)."""
        limit = time.time_ns() - KEEP_VERSIONS_NS
        versions = [v for v in folders(self.spark, home) if VERSION.fullmatch(v)]
        for v, later in zip(versions, versions[1:]):
            # The time at which a version was replaced is about that of the next one.
            if f"{home}/{v}" != version and int(later[1:21]) < limit:
                delete(self.spark, f"{home}/{v}")

    def tables(self, layer: str, slug: str | None = None) -> list[str]:
        """Tables of a layer; with ``slug`` only those of one run (the catalog filters)."""
        pattern = f"*_{slug}" if slug else None
        return sorted(t.name for t in self.spark.catalog.listTables(self.db(layer), pattern))

    def schemas(self) -> list[str]:
        """Names of the layer databases."""
        return [self.db(layer) for layer in LAYERS]


def spread_if_narrow(df: DataFrame) -> DataFrame:
    """Round-robin an input that arrives in far fewer partitions than the cluster
    has task slots (one gzip CSV, one workbook, one Parquet row group) before it
    is written as the raw layer. The raw table then has a file per slot, so every
    later layer scans in parallel instead of in one task. Inputs that already
    arrive in many splits (the large-scale case) are left as they are.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan:  # asking for the partitions of a shuffle would run it
        return df
    # The partition count of the planned scan (metadata only, no job runs).
    if df.rdd.getNumPartitions() * 2 <= slots:
        return df.repartition(slots)
    return df


@dataclass
class LayerRun:
    ok: bool
    slug: str
    error: str | None = None
    tables: dict[str, str | None] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    verification: dict[str, list[str]] = field(default_factory=dict)
    mart_kind: str | None = None

    def to_dict(self) -> dict[str, Any]:
        if not self.ok:
            return {"ok": False, "error": self.error}
        t = self.tables
        queries = [
            f"SELECT * FROM {t['raw']} LIMIT 10;",
            f"SELECT * FROM {t['processed']} LIMIT 10;",
            f"SELECT * FROM {t['analytics']} LIMIT 20;",
        ]
        if t.get("dimension") and t.get("fact"):
            queries += [
                f"SELECT * FROM {t['dimension']} LIMIT 50;",
                f"SELECT * FROM {t['fact']} LIMIT 50;",
            ]
        return {
            "ok": True,
            "slug": self.slug,
            "schemas": list(LAYERS),
            "tables": dict(t),
            "counts": dict(self.counts),
            "verification": self.verification,
            "flow": FLOW,
            "example_queries": queries,
        }


def build_layers(
    wh: Warehouse,
    raw_df: DataFrame,
    slug: str,
    raw_rows: int | None = None,
) -> LayerRun:
    """K1 -> K2 -> K3 -> K4 / K5 -> C2. Never raises; failures are reported.

    ``raw_rows`` says that ``raw_df`` already is the raw table of this slug, and how many rows it has.
    """
    try:
        wh.ensure_layers()
        raw = raw_df
        if raw_rows is None:
            raw, raw_rows = wh.replace(spread_if_narrow(raw_df), RAW, f"raw_{slug}")
        proc, proc_rows = wh.replace(processed(raw, rows=raw_rows), PROCESSED, f"processed_{slug}")
        shape = mart_shape(proc)
        analytics = wh.write(mart(proc, shape), ANALYTICS, f"analytics_{slug}")
        tables = {
            "raw": f"{wh.db(RAW)}.raw_{slug}",
            "processed": f"{wh.db(PROCESSED)}.processed_{slug}",
            "analytics": f"{wh.db(ANALYTICS)}.analytics_{slug}",
            "dimension": None,
            "fact": None,
        }
        if shape.key:
            grouped = analytics if shape.kind == "grouped" else grouped_metrics(proc, shape)
            dim, fact = star_schema(grouped, shape)
            wh.write(dim, ANALYTICS, f"dim_{slug}")
            wh.write(fact, ANALYTICS, f"fact_{slug}")
            tables["dimension"] = f"{wh.db(ANALYTICS)}.dim_{slug}"
            tables["fact"] = f"{wh.db(ANALYTICS)}.fact_{slug}"
        counts = {"raw": raw_rows, "processed": proc_rows, "duplicates_removed": raw_rows - proc_rows}
        verification = {layer: wh.tables(layer, slug) for layer in LAYERS}
        verification["schemas"] = wh.schemas()
        return LayerRun(True, slug, None, tables, counts, verification, shape.kind)
    except Exception as exc:  # the run record carries the failure
        log.exception("layered warehouse failed for %s", slug)
        return LayerRun(False, slug, str(exc))


def reconciliation(spark: SparkSession, raw: DataFrame, proc: DataFrame) -> DataFrame:
    """C4: rows in raw, rows in processed and duplicate rows removed (one row)."""
    counts = raw.agg(F.count(F.lit(1)).alias("n")).select(F.lit(RAW).alias("layer"), "n").unionByName(
        proc.agg(F.count(F.lit(1)).alias("n")).select(F.lit(PROCESSED).alias("layer"), "n")
    )
    raw_rows = F.sum(F.when(F.col("layer") == RAW, F.col("n")))
    proc_rows = F.sum(F.when(F.col("layer") == PROCESSED, F.col("n")))
    return counts.agg(
        raw_rows.alias("raw_rows"),
        proc_rows.alias("processed_rows"),
        (raw_rows - proc_rows).alias("duplicates_removed"),
    )
