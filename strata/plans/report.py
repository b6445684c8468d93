"""Report derivations over analytics results.

Every function takes the long-form result frames *with a ``job_id`` column*,
so the same code serves one run or the whole run history at once:

* ``profile``       ``(job_id, role, role_position, column_name, ...)``
* ``numeric_stats`` ``(job_id, position, column_name, count, mean, min, max, stddev_pop)``
* ``top_values``    ``(job_id, position, column_name, rank, value, count)``
* ``trends``        ``(job_id, position, column_name, grain, period, count)``
* ``runs``          ``(job_id, status, row_count)``

Joins are equi-joins on ``(job_id, column_name)`` between frames that hold one
row per column (or per top-k entry); windows are partitioned by job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators.profile import CATEGORICAL, DATETIME, NUMERIC, Profile
from strata.plans.analytics import Analytics

# Fixed values (texts and limits of the reference's result views).
INSIGHT_LIMIT = 12
NUMERIC_TITLE = "Numbers: "
NUMERIC_BODY = "Typical value (mean) is around %.2f. Compare min and max to see spread."
NUMERIC_BODY_NO_MEAN = "Summary statistics were computed for this numeric column."
CATEGORY_TITLE = "Categories: "
CATEGORY_BODY = "The most common value is %s, appearing %d times in the sample shown."
NOT_AVAILABLE = "not available"
TREND_TITLE = "Time trend: "
TREND_BODY = "The line shows how many rows fall on each day."
STATUS_TITLE = "Run status"
STATUS_BODY = "The pipeline reported an issue; see the error card above."
NULL_TEXT = "None"  # how a NULL value is printed in result texts
NUMERIC_LABEL_CHARS = 14
CATEGORY_LABEL_CHARS = 18
DAY_SERIES_MIN_POINTS = 2
PANEL_BLOCKS = 6


# ---------------------------------------------------------------- inputs


def profile_frame(spark: SparkSession, profile: Profile, job_id: str) -> DataFrame:
    return profile.to_frame(spark).select(F.lit(job_id).alias("job_id"), "*")


def with_job(df: DataFrame, job_id: str) -> DataFrame:
    return df.select(F.lit(job_id).alias("job_id"), "*")


def runs_frame(spark: SparkSession, job_id: str, analytics: Analytics) -> DataFrame:
    """``(job_id, status, row_count)``; no row count for a run that did not analyse."""
    rows = int(analytics.row_count) if analytics.status == "ok" else None
    return spark.createDataFrame([(job_id, analytics.status, rows)], "job_id STRING, status STRING, row_count BIGINT")


def result_frames(spark: SparkSession, analytics: Analytics, job_id: str) -> dict[str, DataFrame]:
    """The long forms of one analysis, keyed by ``job_id``."""
    return {
        "profile": profile_frame(spark, analytics.profile, job_id),
        "numeric_stats": with_job(analytics.numeric_stats, job_id),
        "top_values": with_job(analytics.top_values, job_id),
        "trends": with_job(analytics.trends, job_id),
        "runs": runs_frame(spark, job_id, analytics),
    }


# ---------------------------------------------------------------- K7


def _str_array(values: list[str]):
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _pick(entries, *names: str):
    """Keep (and order) the named fields of every struct in an array column."""
    return F.transform(entries, lambda e: F.struct(*[e[n].alias(n) for n in names]))


def _sorted_list(*fields) -> Column:
    """Per-group list of structs, sorted by the first field (a position or key)."""
    return F.sort_array(F.collect_list(F.struct(*fields)))


def result_json(
    spark: SparkSession, analytics: Analytics, job_id: str, frames: dict[str, DataFrame] | None = None
) -> DataFrame:
    """K7: ``(job_id, result_json)`` — one analysis as one JSON document.

    Each section is an aggregate per job over per-column rows (one row per
    numeric column; k values per categorical column; one entry per calendar
    day, month and year per datetime column), joined on ``job_id``.
    """
    f = frames or result_frames(spark, analytics, job_id)
    p = analytics.profile
    profile = F.struct(
        _str_array(p.all_columns).alias("all_columns"),
        _str_array(p.numeric).alias("numeric_columns"),
        _str_array(p.categorical).alias("categorical_columns"),
        _str_array(p.datetime).alias("datetime_columns"),
        _str_array(p.boolean).alias("boolean_columns"),
        _str_array(p.issues).alias("issues"),
    )
    column = F.col("column_name").alias("column")

    stats = f["numeric_stats"].groupBy("job_id").agg(
        _sorted_list("position", column, "count", "mean", "min", "max", "stddev_pop").alias("s")
    )

    text = F.coalesce("value", F.lit(NULL_TEXT)).alias("value")
    per_column = f["top_values"].groupBy("job_id", "position", "column_name").agg(
        _sorted_list("rank", text, "count").alias("tv")
    )
    top = per_column.groupBy("job_id").agg(
        _sorted_list("position", column, _pick("tv", "value", "count").alias("top_values")).alias("c")
    )

    period = F.col("period").alias("k")
    period_text = F.coalesce(F.col("period").cast("string"), F.lit(NULL_TEXT))

    def grain(name: str, label: str, value) -> Column:
        # NULL periods come last.
        entry = F.struct(F.col("period").isNull().alias("n"), period, value.alias(label), "count")
        return F.sort_array(F.collect_list(F.when(F.col("grain") == name, entry)))

    per_dt = f["trends"].groupBy("job_id", "position", "column_name").agg(
        grain("day", "date", period_text).alias("d"),
        grain("month", "month", period_text).alias("m"),
        grain("year", "year", F.year("period")).alias("y"),
    )
    dts = per_dt.groupBy("job_id").agg(
        _sorted_list(
            "position",
            column,
            _pick("d", "date", "count").alias("by_day"),
            _pick("m", "month", "count").alias("by_month"),
            _pick("y", "year", "count").alias("by_year"),
        ).alias("t")
    )

    doc = f["runs"].join(stats, "job_id", "left").join(top, "job_id", "left").join(dts, "job_id", "left")
    body = F.struct(
        F.col("status"),
        _str_array(analytics.errors).alias("errors"),
        profile.alias("profile"),
        F.coalesce(_pick("s", "column", "count", "mean", "min", "max", "stddev_pop"), F.array()).alias(
            "numeric_stats"
        ),
        F.coalesce(_pick("c", "column", "top_values"), F.array()).alias("categorical_top"),
        F.coalesce(_pick("t", "column", "by_day", "by_month", "by_year"), F.array()).alias("datetime_trends"),
        F.col("row_count"),
    )
    return doc.select("job_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("result_json"))


# ---------------------------------------------------------------- R1


def insights(
    profile: DataFrame, numeric_stats: DataFrame, top_values: DataFrame, runs: DataFrame
) -> DataFrame:
    """``(job_id, line_no, title, body)``, numeric -> categorical -> datetime
    lines, at most 12 per run; a run whose status is not ``ok`` gets one status line."""
    cols = profile.select("job_id", "role", "role_position", "column_name")
    num = (
        cols.filter(F.col("role") == NUMERIC)
        .join(numeric_stats.select("job_id", "column_name", "mean"), ["job_id", "column_name"], "left")
        .select(
            "job_id",
            F.lit(1).alias("section"),
            "role_position",
            F.concat(F.lit(NUMERIC_TITLE), "column_name").alias("title"),
            F.when(F.col("mean").isNull(), F.lit(NUMERIC_BODY_NO_MEAN))
            .otherwise(F.format_string(NUMERIC_BODY, F.col("mean")))
            .alias("body"),
        )
    )
    first = top_values.filter(F.col("rank") == 1).select(
        "job_id", "column_name", F.coalesce("value", F.lit(NULL_TEXT)).alias("top_value"), F.col("count").alias("top_count")
    )
    cat = (
        cols.filter(F.col("role") == CATEGORICAL)
        .join(first, ["job_id", "column_name"], "left")
        .select(
            "job_id",
            F.lit(2).alias("section"),
            "role_position",
            F.concat(F.lit(CATEGORY_TITLE), "column_name").alias("title"),
            F.format_string(
                CATEGORY_BODY,
                F.coalesce("top_value", F.lit(NOT_AVAILABLE)),
                F.coalesce("top_count", F.lit(0).cast("bigint")),
            ).alias("body"),
        )
    )
    dt = cols.filter(F.col("role") == DATETIME).select(
        "job_id",
        F.lit(3).alias("section"),
        "role_position",
        F.concat(F.lit(TREND_TITLE), "column_name").alias("title"),
        F.lit(TREND_BODY).alias("body"),
    )
    lines = num.unionByName(cat).unionByName(dt)
    ok_runs = runs.filter(F.col("status") == "ok").select("job_id")
    w = Window.partitionBy("job_id").orderBy("section", "role_position")
    numbered = (
        lines.join(ok_runs, "job_id", "left_semi")
        .withColumn("line_no", F.row_number().over(w))
        .filter(F.col("line_no") <= INSIGHT_LIMIT)
        .select("job_id", "line_no", "title", "body")
    )
    status_lines = runs.filter(F.col("status") != "ok").select(
        "job_id", F.lit(1).alias("line_no"), F.lit(STATUS_TITLE).alias("title"), F.lit(STATUS_BODY).alias("body")
    )
    return numbered.unionByName(status_lines)


# ---------------------------------------------------------------- R2-R5


def numeric_series(numeric_stats: DataFrame) -> DataFrame:
    """R2: ``(job_id, position, label, average, minimum, maximum)``; NULL -> 0."""
    zero = F.lit(0.0)
    return numeric_stats.select(
        "job_id",
        "position",
        F.substring("column_name", 1, NUMERIC_LABEL_CHARS).alias("label"),
        F.coalesce("mean", zero).alias("average"),
        F.coalesce("min", zero).alias("minimum"),
        F.coalesce("max", zero).alias("maximum"),
    )


def category_series(top_values: DataFrame) -> DataFrame:
    """``(job_id, column_name, rank, name, count)``, label cut to 18 characters."""
    return top_values.select(
        "job_id",
        "column_name",
        "rank",
        F.substring(F.coalesce("value", F.lit(NULL_TEXT)), 1, CATEGORY_LABEL_CHARS).alias("name"),
        "count",
    )


def day_series(trends: DataFrame) -> DataFrame:
    """Day points of columns that have at least two of them."""
    days = trends.filter(F.col("grain") == "day")
    w = Window.partitionBy("job_id", "column_name")
    return (
        days.withColumn("_points", F.count(F.lit(1)).over(w))
        .filter(F.col("_points") >= DAY_SERIES_MIN_POINTS)
        .select("job_id", "column_name", F.col("period").alias("day"), "count")
    )


def panel(profile: DataFrame, numeric_stats: DataFrame, top_values: DataFrame, runs: DataFrame) -> DataFrame:
    """Per run, the headline numbers and the first six numeric and categorical
    blocks: ``(job_id, rows_processed, numeric_columns, categorical_columns, kind,
    block_no, column_name, mean, min, max, stddev_pop, most_frequent, count)``.
    Uses ``stddev_pop`` (the reference's panel read a missing field and showed 0)."""
    roles = profile.groupBy("job_id").agg(
        F.count(F.when(F.col("role") == NUMERIC, 1)).alias("numeric_columns"),
        F.count(F.when(F.col("role") == CATEGORICAL, 1)).alias("categorical_columns"),
    )
    head = runs.select("job_id", F.col("row_count").alias("rows_processed")).join(roles, "job_id", "left")
    numeric_blocks = numeric_stats.filter(F.col("position") <= PANEL_BLOCKS).select(
        "job_id",
        F.lit(NUMERIC).alias("kind"),
        F.col("position").alias("block_no"),
        "column_name",
        "mean",
        "min",
        "max",
        "stddev_pop",
        F.lit(None).cast("string").alias("most_frequent"),
        F.lit(None).cast("bigint").alias("count"),
    )
    first = top_values.filter(F.col("rank") == 1).select("job_id", "column_name", "value", "count")
    cat_blocks = (
        profile.filter((F.col("role") == CATEGORICAL) & (F.col("role_position") <= PANEL_BLOCKS))
        .select("job_id", "column_name", "role_position")
        .join(first, ["job_id", "column_name"], "left")
        .select(
            "job_id",
            F.lit(CATEGORICAL).alias("kind"),
            F.col("role_position").alias("block_no"),
            "column_name",
            F.lit(None).cast("double").alias("mean"),
            F.lit(None).cast("double").alias("min"),
            F.lit(None).cast("double").alias("max"),
            F.lit(None).cast("double").alias("stddev_pop"),
            F.coalesce("value", F.lit(NOT_AVAILABLE)).alias("most_frequent"),
            F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
        )
    )
    return head.join(numeric_blocks.unionByName(cat_blocks), "job_id", "left")



def write_json(documents: DataFrame, path: str) -> None:
    """K7 sink: one JSON document per line (``job_id`` order), as text files."""
    documents.select("result_json").write.mode("overwrite").text(path)
