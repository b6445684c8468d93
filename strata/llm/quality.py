"""Quality rules: hashed n-gram log-likelihood ratio, with DataFrame functions only.

Two multinomials over hashed word n-grams (1 and 2 words) are counted in one
pass: the raw corpus (every document) and a trusted target (documents labelled
good). A document's score is the mean over its n-grams of
``log(p_target / p_raw)``, so it does not depend on its length; it is kept when
the score reaches a fixed threshold and no base rule fails. Both tables have
``BUCKETS`` entries, whatever the corpus: they come back to the driver as one
bounded list and enter the scoring plan as one constant array, so that scoring
is a projection of the scan without any shuffle.

Cases: a null or empty text has no words and fails the base rules; without any
trusted document the target equals the raw corpus and every score is 0;
repeated rows give repeated results; other columns pass through
:func:`apply_rules` unchanged (its own columns replace columns of their names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import WORD, table

#: Hash buckets of the n-gram tables.
BUCKETS = 10_000
#: Added to every bucket of the raw corpus.
SMOOTHING = 1.0
#: n-grams of the raw corpus' distribution added to the target, so that few
#: labels pull scores to 0 and not to a uniform distribution.
PRIOR_GRAMS = 10_000.0
#: A document is kept from this mean log ratio on.
MIN_SCORE = -0.05
#: Trusted documents that the target is counted on, at most: those whose id has
#: the smallest hash. (Bounded labelled sample; raw counts cover all documents.)
TARGET_DOCS = 20_000
#: Words in a window of the repetition rule (its hashes are doubled: a power of two).
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    plain = F.coalesce(text, F.lit(""))
    for space in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def _hashes(words_col: Column) -> Column:
    return F.transform(words_col, lambda w: F.xxhash64(w))


def _paired(hashes: Column, gap: int) -> Column:
    """Hashes of runs twice as long, from the hashes of runs of ``gap`` words."""
    n = F.greatest(F.size(hashes) - gap, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, gap + 1, n), lambda a, b: F.xxhash64(a, b))


def trusted_sample(labels: DataFrame, limit: int = TARGET_DOCS) -> DataFrame:
    """Ids of at most ``limit`` trusted documents: quality 1 in every label row."""
    return (
        labels.filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
        .select(F.col("doc_id").alias("trusted_id"))
    )


def fit(docs: DataFrame, labels: DataFrame, limit: int = TARGET_DOCS) -> list[tuple[int, int, int]]:
    """(bucket, raw count, target count) of every bucket seen; one pass over the texts."""
    trusted = F.broadcast(trusted_sample(labels, limit))  # at most ``limit`` ids
    grams = (
        docs.select("doc_id", "text")
        .join(trusted, F.col("doc_id") == F.col("trusted_id"), "left")
        .select(F.col("trusted_id").isNotNull().alias("t"), _hashes(words(F.col("text"))).alias("h1"))
        .select("t", F.explode(F.concat("h1", _paired(F.col("h1"), 1))).alias("h"))
    )
    buckets = grams.select("t", F.pmod("h", F.lit(BUCKETS)).cast("int").alias("bucket"))
    return sorted(
        tuple(r)
        for r in buckets.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum(F.col("t").cast("long")).alias("target"))
        .collect()  # at most BUCKETS rows
    )


def log_ratios(counts: list[tuple[int, int, int]]) -> list[float]:
    """log(p_target / p_raw) of every bucket, smoothed, to 6 decimals."""
    from math import log

    raw = [SMOOTHING] * BUCKETS
    target = [0.0] * BUCKETS
    for bucket, r, t in counts:
        raw[bucket] += r
        target[bucket] += t
    seen, trusted = sum(raw), sum(target)
    if not trusted:
        return [0.0] * BUCKETS
    return [
        round(log((t + PRIOR_GRAMS * r / seen) / (trusted + PRIOR_GRAMS)) - log(r / seen), 6)
        for r, t in zip(raw, target, strict=True)
    ]


def _weights(ratios: list[float]) -> Column:
    """The ratios as one constant array (folded by the optimizer)."""
    return F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds BASE_COLUMNS, ``base_failed`` and ``_h1``, ``_h2`` (hashes of runs of 1 and 2 words)."""
    filled = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("_words", words(F.col(text)))
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(filled, F.lit("[#*$%&|<>]")).cast("long"),
            "_lines": F.filter(F.split(filled, "\n", -1), lambda line: line.rlike(WORD)),
            "_h1": _hashes(F.col("_words")),
        }
    )
    out = out.withColumns(
        {
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_h2": _paired(F.col("_h1"), 1),
        }
    ).drop("_words", "_lines")
    out = out.withColumn("_h4", _paired(F.col("_h2"), 2)).withColumn("_h8", _paired(F.col("_h4"), 4)).drop("_h4")
    # Where a window repeats, windows are sorted by (hash, position): equal ones are neighbours.
    out = out.withColumn(
        "_windows",
        F.when(
            F.size(F.array_distinct("_h8")) < F.size("_h8"),
            F.sort_array(F.transform(F.col("_h8"), lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        ),
    )
    repeated = F.filter(
        F.col("_windows"),
        lambda w, i: F.equal_null(F.get(F.col("_windows"), i + 1)["h"], w["h"])
        | F.equal_null(F.get(F.col("_windows"), i - 1)["h"], w["h"]),
    )
    starts = F.sort_array(F.transform(repeated, lambda w: w["p"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).cast("long").alias("n")
        ),
        lambda acc: acc["n"],
    )
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_h8", "_windows")
    return out.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def apply_rules(docs: DataFrame, ratios: list[float], min_score: float = MIN_SCORE) -> DataFrame:
    """Every row of ``docs`` with the rule columns, ``score`` and ``kept``."""
    weights = _weights(ratios)

    def total(hashes: str) -> Column:
        return F.aggregate(hashes, F.lit(0.0), lambda acc, h: acc + F.get(weights, F.pmod(h, F.lit(BUCKETS)).cast("int")))

    n = F.size("_h1") + F.size("_h2")
    out = base_rules(docs).withColumn(
        "score", F.when(n > 0, F.round((total("_h1") + total("_h2")) / n, 6)).otherwise(F.lit(0.0))
    )
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= min_score))
    return out.drop("_h1", "_h2")


def quality_rules(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    return apply_rules(docs, log_ratios(fit(docs, labels)), min_score)


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep.

    A filter would be pushed below the projections that compute the verdict,
    with all their expressions repeated inside it; a row number, which is not
    deterministic, keeps it above them.
    """
    judged = quality_rules(docs, labels).withColumn("_row", F.monotonically_increasing_id())
    return judged.filter("kept AND _row >= 0").select(*docs.columns)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *BASE_COLUMNS, "base_failed", "kept", "score")
