"""Schema profiling (P1-P5): every column becomes numeric, categorical, datetime
or boolean.

Spark jobs issued, independent of the number of columns:

1. one aggregate over all rows of all string columns (P2): how many values
   parse as a date, by the format they have;
2. one pass over all numeric columns (A1, P3): rows, NULLs, and the distinct
   values of every column as a set that saturates above
   ``categorical_max_distinct``. Tasks keep one such set a column and stop
   looking at a column once it is saturated; the sets of all tasks are united
   by an aggregate with a map-side part. Counts up to the limit are exact.

The numeric summary (A2) is a codegen'd aggregate of its own
(``operators.summary``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import col
from strata.functions.values import DATETIME_TYPES, parse_timestamp

NUMERIC = "numeric"
CATEGORICAL = "categorical"
DATETIME = "datetime"
BOOLEAN = "boolean"
ROLE_ORDER = (NUMERIC, CATEGORICAL, DATETIME, BOOLEAN)

# Fixed defaults (must equal the reference's): 500 sample rows for datetime
# detection, at most 200 distinct values for a numeric column to count as
# categorical.
#: Rows that decide on text dates; None: all of them.
DEFAULT_SAMPLE_ROWS: int | None = None
DEFAULT_CATEGORICAL_MAX_DISTINCT = 200

#: A text column holds dates if at least this share of its values are full dates
#: and one format makes up at least AGREEMENT of them, or if nearly all values
#: (BARE_SHARE) parse, bare years and months included.
DATE_SHARE, AGREEMENT, BARE_SHARE = 0.05, 0.5, 0.95
#: Formats by which parsed texts are told apart: full dates, then bare ones.
DATE_FORMATS = {
    "day": r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$",
    "moment": r"^\s*\d{4}-\d{1,2}-\d{1,2}[ T]\d",
    "month": r"^\s*\d{4}-\d{1,2}\s*$",
    "year": r"^\s*\d{4}\s*$",
}
FULL_FORMATS = ("day", "moment", "other")

# Aggregate expressions per job: wide tables are processed in chunks of columns
# so that generated code stays under the JVM method-size limits.
DEFAULT_CHUNK = 100


@dataclass(frozen=True)
class ColumnProfile:
    ordinal: int
    name: str
    data_type: str
    role: str
    reason: str
    distinct_count: int | None = None


@dataclass
class Profile:
    """Driver-side description of a dataset's columns (one entry per column)."""

    columns: list[ColumnProfile]
    numeric: list[str]
    categorical: list[str]
    datetime: list[str]
    boolean: list[str]
    row_count: int | None = None
    issues: list[str] = field(default_factory=list)
    # Average length of the sampled values of each string column (P2 probe).
    text_lengths: dict[str, float] = field(default_factory=dict)
    data_types: dict[str, T.DataType] = field(default_factory=dict)

    @property
    def all_columns(self) -> list[str]:
        return [c.name for c in sorted(self.columns, key=lambda c: c.ordinal)]

    @property
    def ok(self) -> bool:
        return bool(self.columns)

    def role_of(self, name: str) -> str:
        for c in self.columns:
            if c.name == name:
                return c.role
        raise KeyError(name)

    def ordered(self) -> list[tuple[str, int, ColumnProfile]]:
        """(role, position within role, column) in report order."""
        by_name = {c.name: c for c in self.columns}
        out = []
        for role, names in (
            (NUMERIC, self.numeric),
            (CATEGORICAL, self.categorical),
            (DATETIME, self.datetime),
            (BOOLEAN, self.boolean),
        ):
            for pos, name in enumerate(names, start=1):
                out.append((role, pos, by_name[name]))
        return out

    def to_dict(self) -> dict[str, Any]:
        # The keys of the published document.
        return {
            "all_columns": self.all_columns,
            "numeric_columns": list(self.numeric),
            "categorical_columns": list(self.categorical),
            "datetime_columns": list(self.datetime),
            "boolean_columns": list(self.boolean),
            "row_count_estimate": self.row_count,
            "issues": list(self.issues),
        }

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The profile as a DataFrame, one row per column (metadata only)."""
        rows = [
            (c.ordinal, c.name, c.data_type, role, pos, c.distinct_count, c.reason)
            for role, pos, c in self.ordered()
        ]
        schema = (
            "ordinal INT, column_name STRING, data_type STRING, role STRING, "
            "role_position INT, distinct_count BIGINT, reason STRING"
        )
        return spark.createDataFrame(rows, schema)


def coarse_role(data_type: T.DataType) -> str:
    """Role from the type alone (boolean, numeric, datetime, else categorical)."""
    if isinstance(data_type, T.BooleanType):
        return BOOLEAN
    if isinstance(data_type, T.NumericType):
        return NUMERIC
    if isinstance(data_type, DATETIME_TYPES):
        return DATETIME
    return CATEGORICAL


def _chunks(items: list, size: int) -> list[list]:
    return [items[i : i + size] for i in range(0, len(items), size)] or [[]]


def holds_dates(hits: dict[str, int], present: int, min_fraction: float | None = None) -> bool:
    """Whether a text column with these hits by format, among its non-blank values, holds dates."""
    parsed = sum(hits.values())
    if not parsed:
        return False
    if min_fraction is not None:
        return parsed >= min_fraction * present
    full = {f: hits.get(f, 0) for f in FULL_FORMATS}
    n = sum(full.values())
    if n and n >= DATE_SHARE * present and max(full.values()) >= AGREEMENT * n:
        return True
    return parsed >= BARE_SHARE * present and max(hits.values()) >= AGREEMENT * parsed


def date_evidence(
    df: DataFrame, string_columns: list[str], sample_rows: int | None = DEFAULT_SAMPLE_ROWS, chunk: int = DEFAULT_CHUNK
) -> dict[str, tuple[dict[str, int], int, int, float]]:
    """(hits by format, non-blank values, values, average length) of every text column.

    All rows count by default, so late dates do too: sums that are one
    aggregate with a map-side part (chunked for wide tables).
    """
    looked = df if sample_rows is None else df.limit(sample_rows)
    formats = [*DATE_FORMATS, "other"]
    found = {}
    for part in _chunks(string_columns, chunk):
        if not part:
            continue
        kinds, aggs = [], []
        for i, c in enumerate(part):
            kind = F.when(parse_timestamp(col(c)).isNull(), F.lit(-1))
            for k, pattern in enumerate(DATE_FORMATS.values()):
                kind = kind.when(col(c).rlike(pattern), F.lit(k))
            kinds += [kind.otherwise(F.lit(len(DATE_FORMATS))).alias(f"k{i}"), F.length(col(c)).cast("long").alias(f"l{i}")]
            kinds.append((F.trim(col(c)) != "").alias(f"b{i}"))
            aggs += [F.count_if(F.col(f"k{i}") == k).alias(f"h{i}_{k}") for k in range(len(formats))]
            aggs += [F.count_if(f"b{i}").alias(f"n{i}"), F.count(f"l{i}").alias(f"p{i}"), F.sum(f"l{i}").alias(f"s{i}")]
        row = looked.select(*kinds).agg(*aggs).first()
        for i, c in enumerate(part):
            hits = {f: row[f"h{i}_{k}"] for k, f in enumerate(formats)}
            present = row[f"p{i}"]
            found[c] = hits, row[f"n{i}"], present, (row[f"s{i}"] or 0) / present if present else 0.0
    return found


def probe_strings(
    df: DataFrame,
    string_columns: list[str],
    sample_rows: int | None = DEFAULT_SAMPLE_ROWS,
    min_fraction: float | None = None,
    chunk: int = DEFAULT_CHUNK,
) -> tuple[set[str], dict[str, float]]:
    """String columns that hold dates, and the average length of every one.

    ``min_fraction``: the share of all values (blank ones too) that must parse,
    whatever their format, in place of the rule of :func:`holds_dates`.
    """
    if not string_columns or sample_rows == 0:
        return set(), {}
    found = date_evidence(df, string_columns, sample_rows, chunk)
    dates = {
        c
        for c, (hits, filled, present, _) in found.items()
        if holds_dates(hits, filled if min_fraction is None else present, min_fraction)
    }
    return dates, {c: length for c, (_, _, _, length) in found.items()}


def capped_distinct(df: DataFrame, columns: list[str], limit: int) -> tuple[int, dict[str, tuple[int, int | None]]]:
    """The number of rows and, per numeric column, (NULLs, distinct values up to ``limit``, else None), in one pass.

    NaN is one value, -0.0 is 0.0. A task hands on ``limit`` values a column at most.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        rows, nulls = 0, [0] * len(columns)
        sets: list[set | None] = [set() for _ in columns]
        for batch in batches:
            rows += batch.num_rows
            for i, known in enumerate(sets):
                values = batch.column(i)
                nulls[i] += values.null_count
                if known is None:
                    continue
                if pa.types.is_floating(values.type):
                    values = pc.add(values, 0.0)  # -0.0 becomes 0.0
                values = pc.unique(values).drop_null()
                if len(values) <= limit:
                    known.update(map(repr, values.to_pylist()))
                if max(len(values), len(known)) > limit:
                    sets[i] = None
        found = [(i, rows if i == 0 else 0, nulls[i], known is None, None) for i, known in enumerate(sets)]
        found += [(i, 0, 0, False, v) for i, known in enumerate(sets) for v in known or ()]
        types = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*found), types, strict=True)], names=["i", "rows", "nulls", "full", "value"]
        )

    source = df.select(*[col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    parts = source.mapInArrow(run, "i int, rows long, nulls long, full boolean, value string")
    totals = parts.groupBy("i").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.max("full").alias("full"), F.count_distinct("value").alias("n")
    )
    found = {r["i"]: r for r in totals.collect()}  # one row a column
    out = {}
    for i, c in enumerate(columns):
        r = found.get(i)
        n = 0 if r is None else None if r["full"] or r["n"] > limit else r["n"]
        out[c] = (r["nulls"] if r else 0, n)
    return (found[0]["rows"] if found else 0), out


def _exact_distinct(df: DataFrame, columns: list[str], chunk: int) -> dict[str, int]:
    out: dict[str, int] = {}
    for part in _chunks(columns, chunk):
        if not part:
            continue
        row = df.agg(*[F.count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(part)]).first()
        for i, c in enumerate(part):
            out[c] = row[f"d{i}"]
    return out


def build_profile(
    df: DataFrame,
    categorical_max_distinct: int = DEFAULT_CATEGORICAL_MAX_DISTINCT,
    sample_rows: int | None = DEFAULT_SAMPLE_ROWS,
    min_fraction: float | None = None,
    exact: bool = False,
    chunk: int = DEFAULT_CHUNK,
) -> Profile:
    """Classify every column of ``df``.

    Order within roles follows the schema; numerics reclassified as categorical
    are appended after the natively categorical columns (P4).
    ``categorical_max_distinct=0`` disables the reclassification. ``exact``
    also counts the distinct values of columns above the limit (a shuffle of
    their values; roles do not depend on it).
    """
    fields = list(df.schema.fields)
    types = {f.name: f.dataType for f in fields}
    coarse = {f.name: coarse_role(f.dataType) for f in fields}
    strings = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    numeric_typed = [n for n, r in coarse.items() if r == NUMERIC]
    issues: list[str] = []

    promoted, text_lengths = probe_strings(df, strings, sample_rows, min_fraction)

    distinct: dict[str, int] = {}
    reclassified: set[str] = set()
    limit = categorical_max_distinct
    if numeric_typed and limit > 0:
        try:
            row_count, info = capped_distinct(df, numeric_typed, limit)
        except Exception as exc:  # reported, never fatal
            # Fixed text of the issue.
            issues.append(f"distinct check failed for {', '.join(numeric_typed)}: {exc}")
            row_count, info = df.count(), {}
        for c, (nulls, n) in info.items():
            if n is None:
                continue
            distinct[c] = n + (1 if nulls else 0)  # NULL counts as one value
            if 0 < distinct[c] <= limit:
                reclassified.add(c)
        over = [c for c in info if c not in distinct] if exact else []
        for c, n in _exact_distinct(df, over, chunk).items():
            distinct[c] = n + (1 if info[c][0] else 0)
    else:
        row_count = df.count()

    numeric, categorical, datetime_cols, boolean = [], [], [], []
    columns: list[ColumnProfile] = []
    for ordinal, f in enumerate(fields):
        name, role = f.name, coarse[f.name]
        reason = "type"
        if role == CATEGORICAL and name in promoted:
            role, reason = DATETIME, "parsed_as_timestamp"
        elif role == NUMERIC and name in reclassified:
            role, reason = CATEGORICAL, "low_cardinality"
        columns.append(
            ColumnProfile(ordinal, name, f.dataType.simpleString(), role, reason, distinct.get(name))
        )
        if role == BOOLEAN:
            boolean.append(name)
        elif role == NUMERIC:
            numeric.append(name)
        elif role == DATETIME:
            datetime_cols.append(name)
        elif reason == "type":
            categorical.append(name)
    categorical += [c for c in numeric_typed if c in reclassified]

    return Profile(
        columns=columns,
        numeric=numeric,
        categorical=categorical,
        datetime=datetime_cols,
        boolean=boolean,
        row_count=row_count,
        issues=issues,
        text_lengths=text_lengths,
        data_types=types,
    )


def validate_minimum_schema(profile: Profile) -> tuple[bool, list[str]]:
    """P5: at least one column is required."""
    if not profile.columns:
        return False, ["Dataset has no columns."]  # fixed text
    return True, []
