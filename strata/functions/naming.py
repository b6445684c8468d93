"""Name functions: column-name standardisation (T1), table slug (T8), quoting.

Pure Python on *names* (schema metadata, never data), plus a column-expression
form of the slug so that a file manifest can compute slugs for millions of
paths inside Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's outputs):
#   fallback column name "column", prefix "c_" before a leading digit;
#   fallback slug stem "dataset", prefix "t_" before a leading digit,
#   stem cut to 28 characters, 12 hex characters of the job id.
EMPTY_COLUMN_NAME = "column"
DIGIT_COLUMN_PREFIX = "c_"
EMPTY_SLUG_STEM = "dataset"
DIGIT_SLUG_PREFIX = "t_"
SLUG_STEM_MAX = 28
JOB_ID_HEX_CHARS = 12

_NOT_WORD = re.compile(r"[^a-z0-9]+")


def _squash(text: str) -> str:
    """Lower-case text with every run of characters outside [a-z0-9] as one '_',
    without leading or trailing '_'."""
    return _NOT_WORD.sub("_", text).strip("_")


def standardize_name(name: str) -> str:
    """Base standard form of one column name (no collision handling)."""
    base = _squash(name.strip().lower())
    if not base:
        return EMPTY_COLUMN_NAME
    if base[0].isdigit():
        return DIGIT_COLUMN_PREFIX + base
    return base


def standardize_names(names: Iterable[str]) -> list[str]:
    """Standard names for a whole schema, unique in order of appearance.

    A repeated base gets ``_2``, ``_3``...; every emitted name is recorded, so a
    generated ``a_2`` can never collide with a later literal ``a_2`` (which then
    becomes ``a_2_2``).
    """
    taken: set[str] = set()
    out: list[str] = []
    for name in names:
        base = standardize_name(name)
        candidate, n = base, 1
        while candidate in taken:
            n += 1
            candidate = f"{base}_{n}"
        taken.add(candidate)
        out.append(candidate)
    return out


def file_stem(filename: str) -> str:
    return PurePosixPath(filename).stem


def make_slug(filename: str, job_id: str) -> str:
    """Safe, unique table suffix ``<stem>_<12 hex of job id>``."""
    stem = _squash(file_stem(filename).lower()) or EMPTY_SLUG_STEM
    if stem[0].isdigit():
        stem = DIGIT_SLUG_PREFIX + stem
    short = job_id.replace("-", "")[:JOB_ID_HEX_CHARS]
    return f"{stem[:SLUG_STEM_MAX]}_{short}"


def slug_column(filename: Column, job_id: Column) -> Column:
    """Column-expression form of :func:`make_slug` (same results for ASCII names)."""
    stem = F.regexp_extract(filename, r"^(.+?)(\.[^.]+)?$", 1)
    squashed = F.regexp_replace(
        F.regexp_replace(F.lower(stem), r"[^a-z0-9]+", "_"), r"^_+|_+$", ""
    )
    named = F.when(squashed == "", F.lit(EMPTY_SLUG_STEM)).otherwise(squashed)
    prefixed = F.when(named.rlike(r"^[0-9]"), F.concat(F.lit(DIGIT_SLUG_PREFIX), named)).otherwise(
        named
    )
    short = F.substring(F.regexp_replace(job_id, "-", ""), 1, JOB_ID_HEX_CHARS)
    return F.concat(F.substring(prefixed, 1, SLUG_STEM_MAX), F.lit("_"), short)


def quote_sql(name: str) -> str:
    """Quote an identifier for Spark SQL text (backticks, doubled inside)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column reference that is safe for any name (dots, spaces, backticks)."""
    return F.col(quote_sql(name))
