"""Exact top-k values with hash-first counting (A3/L1 for long texts).

The plain plan (``operators.frequency``) shuffles every distinct value once.
For long, nearly unique texts (documents, pages) that is the whole column. This
strategy shuffles ``(column, xxhash64(value), length(value))`` — about 24 bytes
per row — and full values only where they can reach the top k:

1. count rows per hash group (map-side partial counts) and write the counts to
   the shared folder;
2. per column, ``t`` = the k-th largest group count (``WindowGroupLimit``);
   only groups with ``n >= t`` can hold a value of the top k;
3. *bounded*: if those groups are at most ``candidate_bound``, their rows are
   semi-joined (broadcast keys) and counted by full value;
4. *unique tail* (``t == 1``): groups with ``n >= 2`` are fewer than k and
   counted likewise. Every other group is one row, a value that occurs once; the
   smallest of those fill the top k (partial ``WindowGroupLimit``: k rows per
   partition cross the shuffle);
5. a hash group that turns out to hold two different values (a collision), or
   a tie set above the bound, sends that column to the plain plan.

The result equals the plain plan exactly (ties by value ascending, NULL last).
The driver sees numbers per column only; values stay in the cluster.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.frequency import DEFAULT_TOP_K, TOP_SCHEMA, top_k, unpivot_text, value_counts
from strata.session import ensure_checkpoint_dir

KEY = ["position", "column_name", "h", "ln"]
DEFAULT_CANDIDATE_BOUND = 100_000


def _xxhash(value: Column) -> Column:
    return F.xxhash64(value)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder; several small jobs read it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hashed_top_values(
    df: DataFrame,
    columns: list[str],
    k: int = DEFAULT_TOP_K,
    candidate_bound: int = DEFAULT_CANDIDATE_BOUND,
    hash_fn: Callable[[Column], Column] = _xxhash,
    positions: list[int] | None = None,
) -> DataFrame:
    """Same output as ``frequency.top_values(df, columns, k)``."""
    spark = df.sparkSession
    positions = positions or list(range(1, len(columns) + 1))
    by_position = dict(zip(positions, columns))
    rows = unpivot_text(df, columns, positions).select(
        "position",
        "column_name",
        "value",
        hash_fn(F.col("value")).alias("h"),
        F.coalesce(F.length("value"), F.lit(-1)).alias("ln"),  # NULL is its own group
    )
    counts = _stored(rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")), "topk-counts")
    lower, tail, plain = _lower_bounds(counts, k, candidate_bound)
    parts = []
    if lower:
        low = F.create_map(*[F.lit(x) for item in lower.items() for x in item])  # a number a column
        wanted = counts.filter(F.col("position").isin(list(lower)) & (F.col("n") >= low[F.col("position")])).select(*KEY)
        found = rows.filter(F.col("position").isin(list(lower))).join(F.broadcast(wanted), KEY, "left_semi")  # at most the bound
        found = _stored(found.groupBy(*KEY, "value").agg(F.count(F.lit(1)).alias("count")), "topk-candidates")
        several = found.groupBy(*KEY).agg(F.count(F.lit(1)).alias("values")).filter("values > 1")
        collided = {r[0] for r in several.select("position").distinct().collect()}  # hash collisions: the plain plan decides
        plain |= collided
        tail -= collided
        kept = found.filter(~F.col("position").isin(list(collided))) if collided else found
        parts.append(kept.select("position", "column_name", "value", "count"))
        if tail:
            once = rows.filter(F.col("position").isin(list(tail))).join(F.broadcast(wanted), KEY, "left_anti")
            smallest = Window.partitionBy("position", "column_name").orderBy(F.col("value").asc_nulls_last())
            once = once.withColumn("r", F.row_number().over(smallest)).filter(F.col("r") <= k)
            parts.append(once.select("position", "column_name", "value", F.lit(1).cast("long").alias("count")))
    out = None
    if parts:
        both = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
        out = top_k(both, k)
    if plain:
        chosen = sorted(plain)
        exact = top_k(value_counts(df, [by_position[p] for p in chosen], chosen), k)
        out = exact if out is None else out.unionByName(exact)
    return spark.createDataFrame([], TOP_SCHEMA) if out is None else out


def _lower_bounds(counts: DataFrame, k: int, bound: int) -> tuple[dict[int, int], set[int], set[int]]:
    """(count from which a column's groups are candidates, columns with a unique tail, columns for the plain plan)."""
    largest = Window.partitionBy("position").orderBy(F.col("n").desc())
    leaders = counts.select("position", "n").withColumn("r", F.row_number().over(largest)).filter(F.col("r") <= k)
    limits = leaders.groupBy("position").agg(F.min("n").alias("t"))
    sizes = counts.join(limits, "position").groupBy("position", "t").agg(F.count_if(F.col("n") >= F.col("t")).alias("groups"))
    lower, tail, plain = {}, set(), set()
    for r in sizes.collect():  # one row a column
        if r["groups"] <= bound:
            lower[r["position"]] = r["t"]
        elif r["t"] == 1:
            lower[r["position"]] = 2  # fewer than k groups
            tail.add(r["position"])
        else:
            plain.add(r["position"])
    return lower, tail, plain
