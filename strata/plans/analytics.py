"""Adaptive analytics (F1) and file-to-analytics (F2).

``analyze`` classifies the columns (2-3 small jobs, see ``operators.profile``)
and returns three lazily evaluated long-form DataFrames:

* ``numeric_stats``  ``(position, column, count, mean, min, max, stddev_pop)``
* ``top_values``     ``(position, column, rank, value, count)``
* ``trends``         ``(position, column, grain, period, count)``

so the whole analysis costs a fixed number of jobs — one per output — however
many columns the input has. Nothing is collected except the profile's
aggregate row (a few values per column).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from strata.operators import frequency, summary, trends
from strata.operators.profile import (
    DEFAULT_CATEGORICAL_MAX_DISTINCT,
    Profile,
    build_profile,
    validate_minimum_schema,
)
from strata.sources.manifest import detect_format_of_path
from strata.sources.readers import load

OK, ERROR = "ok", "error"


@dataclass
class Analytics:
    status: str
    profile: Profile
    row_count: int
    numeric_stats: DataFrame
    top_values: DataFrame
    trends: DataFrame
    errors: list[str] = field(default_factory=list)

    def frames(self) -> dict[str, DataFrame]:
        return {
            "numeric_stats": self.numeric_stats,
            "top_values": self.top_values,
            "trends": self.trends,
        }


def analyze(
    df: DataFrame,
    profile: Profile | None = None,
    top_k: int = frequency.DEFAULT_TOP_K,
    categorical_max_distinct: int = DEFAULT_CATEGORICAL_MAX_DISTINCT,
    include_booleans: bool = False,
    min_fraction: float | None = None,
    checkpoint: bool = False,
    topk_method: str = "auto",
) -> Analytics:
    """profile (unless given) and build the adaptive analytics frames.

    ``include_booleans`` sends boolean columns to the frequency counts (D7; the
    reference profiles them but never analyses them). ``checkpoint`` cuts the
    lineage of ``df`` first (F5) with a reliable checkpoint. ``topk_method``
    chooses the top-k strategy ("exact": count full values; "hashed": count
    hashes first, same result, less shuffle for long texts, runs eagerly;
    "auto", the default: hashed only for columns whose values are long).
    """
    spark = df.sparkSession
    if checkpoint:
        from strata.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(spark)
        df = df.checkpoint(eager=True)
    if profile is None:
        profile = build_profile(
            df, categorical_max_distinct=categorical_max_distinct, min_fraction=min_fraction
        )
    ok, errors = validate_minimum_schema(profile)
    if not ok:
        empty = spark.createDataFrame([], summary.SUMMARY_SCHEMA)
        return Analytics(
            ERROR,
            profile,
            0,
            empty,
            spark.createDataFrame([], frequency.TOP_SCHEMA),
            spark.createDataFrame([], trends.TREND_SCHEMA),
            errors,
        )

    rows = profile.row_count if profile.row_count is not None else df.count()

    categorical = list(profile.categorical)
    if include_booleans:
        categorical += profile.boolean
    return Analytics(
        status=OK,
        profile=profile,
        row_count=rows,
        numeric_stats=summary.numeric_summary(df, profile.numeric),
        top_values=frequency.top_values(
            df, categorical, top_k, method=topk_method, text_lengths=profile.text_lengths
        ),
        trends=trends.trends(df, profile.datetime),
    )


def run_file(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    options: dict[str, str] | None = None,
    persist: bool = False,
    schema: str | None = None,
    **analyze_args: Any,
) -> tuple[DataFrame, Analytics]:
    """detect the format (unless given), load and analyse one dataset.

    ``persist`` keeps the decoded input in memory/disk between the analysis
    jobs; worth it for CSV/JSON (no column pruning), not for Parquet at scale.
    """
    kind = fmt or detect_format_of_path(spark, path)
    df = load(spark, path, kind, options, schema)
    if persist:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    return df, analyze(df, **analyze_args)
