"""Session helpers.

The library never builds its own session inside operators: every function takes
the caller's ``SparkSession`` and respects its configuration (shuffle partitions,
time zone, checkpoint directory). ``local_session`` exists for tests, the bench
and the command line only.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "strata",
    warehouse_dir: str | None = None,
    checkpoint_dir: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session configured the way our tests and bench expect.

    Production code should build the session from the cluster's own defaults
    and pass it in; nothing in the library depends on these settings.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
    )
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    Order: an already active directory on the SparkContext, then the cluster's
    ``spark.checkpoint.dir`` setting, then a folder under the SQL warehouse
    location (shared storage on a cluster, like the tables we write). A
    machine-local temporary folder is never chosen here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        configured = warehouse.rstrip("/") + "/_strata_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
