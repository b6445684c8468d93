"""Full-row DISTINCT by fingerprints (A11 for rows with long texts).

Spark's DISTINCT shuffles every row whole. Rows of long texts are mostly
different, so here two 64-bit hashes of a row are shuffled and counted instead.
A row whose fingerprint occurs once is different from all others and stays
where it is; only rows with a repeated fingerprint are shuffled and compared
whole. A collision of fingerprints costs a comparison, never a row.

The repeated fingerprints are a broadcast of a counted, bounded size; above the
bound the plain DISTINCT runs (then most rows would be shuffled anyway).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import col
from strata.session import ensure_checkpoint_dir

#: Repeated fingerprints that are broadcast (16 bytes each).
REPEATED_BOUND = 1_000_000
#: Bytes a row from which fingerprints pay: they are a second scan.
LONG_ROW = 512
_SECOND = "second fingerprint"


def _plain_zeros(df: DataFrame) -> DataFrame:
    """-0.0 becomes 0.0, as in the rows of DISTINCT."""
    zero = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    plain = [(col(c) + F.lit(0.0)).cast(df.schema[c].dataType).alias(c) if c in zero else col(c) for c in df.columns]
    return df.select(*plain) if zero else df


def _fingerprint(df: DataFrame) -> list[Column]:
    """Two hashes of all columns; NULLs are marked, as the hashes pass over them."""
    columns = [x for c in df.columns for x in (col(c).isNull(), col(c))]
    return [F.xxhash64(*columns).alias("_f1"), F.xxhash64(F.lit(_SECOND), *reversed(columns)).alias("_f2")]


def distinct_rows(df: DataFrame, bound: int = REPEATED_BOUND) -> DataFrame:
    """The rows of ``df.distinct()``. Runs the count of the fingerprints at once; the rest is lazy."""
    spark = df.sparkSession
    df = _plain_zeros(df)
    path = f"{ensure_checkpoint_dir(spark)}/distinct-{uuid.uuid4().hex}"
    counted = df.select(*_fingerprint(df)).groupBy("_f1", "_f2").agg(F.count(F.lit(1)).alias("_n"))
    counted.filter("_n > 1").select("_f1", "_f2").write.parquet(path)
    repeated = spark.read.schema("_f1 long, _f2 long").parquet(path)
    if repeated.count() > bound:
        return df.distinct()
    marked = df.select(F.struct(*[col(c) for c in df.columns]).alias("_row"), *_fingerprint(df))
    known = F.broadcast(repeated)  # at most ``bound`` rows
    once = marked.join(known, ["_f1", "_f2"], "left_anti").select("_row.*")
    more = marked.join(known, ["_f1", "_f2"], "left_semi").select("_row.*").distinct()
    return once.union(more)


def bytes_a_row(df: DataFrame, rows: int) -> float:
    """What the planner knows of the input's size, over its rows (no job)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size / rows if rows else 0.0
