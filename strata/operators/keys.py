"""Dense surrogate keys (W1): ``1..n`` in key order, like
``ROW_NUMBER() OVER (ORDER BY key)`` over distinct keys.

A global window sorts everything in one task. Instead, at every size:

1. ``repartitionByRange(P, key)`` + ``sortWithinPartitions(key)``: P ordered,
   similar-sized ranges, sorted inside;
2. a reliable ``checkpoint()`` pins those partitions (the range bounds come from
   sampling and would otherwise be re-drawn by every action; a lost executor
   then re-reads the checkpoint instead of re-sampling);
3. ``monotonically_increasing_id`` gives each row its index inside its
   partition (no shuffle); one small job counts rows per partition;
4. the P partition offsets (a running sum over P rows — bounded by the
   partition count, not the data) are broadcast and added.

Ids are therefore identical to the global window, with no single-partition step
over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.naming import col
from strata.session import ensure_checkpoint_dir

_PID, _MID, _OFF, _N = "_strata_pid", "_strata_mid", "_strata_off", "_strata_n"


def _ranged_ids(df: DataFrame, key: str, id_col: str, partitions: int) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = col(key).asc_nulls_last()
    ranged = df.repartitionByRange(partitions, order).sortWithinPartitions(order)
    pinned = ranged.checkpoint(eager=True)
    tagged = pinned.withColumn(_PID, F.spark_partition_id()).withColumn(
        _MID, F.monotonically_increasing_id()
    )
    sizes = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PID, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    local_index = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    return (
        tagged.join(F.broadcast(offsets), _PID)
        .withColumn(id_col, (F.col(_OFF) + local_index + 1).cast("bigint"))
        .drop(_PID, _MID, _OFF)
    )


def dense_ids(df: DataFrame, key: str, id_col: str = "dim_id", partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = rank of ``key`` (1-based, ascending, NULL last).

    ``df`` must hold each key once (e.g. a mart or distinct keys). It is
    evaluated once, whatever its size; ``partitions`` defaults to the session's
    shuffle partitions.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _ranged_ids(df, key, id_col, n)
