"""CSV dialects, headers and columns, found from the input itself.

One pass over the lines counts, per file and candidate (delimiter, quote), how
many lines have how many fields. These histograms add up, so files with the
same first line are judged together; the candidate with the most constant
number of fields wins. The files are then grouped by header (names in their
order) and dialect, every group is read with its own options, and the groups
are united by column name over a lattice of types.

A first line is a header unless one of its fields is a value (empty, a number,
a date, true or false) that also fits the type of the column below it.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import ensure_checkpoint_dir
from strata.sources.files import as_path

#: Candidates, in order of preference (fixed values).
DELIMITERS = (",", "|", ";", "\t")
QUOTES = ('"', "'")

_INTEGER = re.compile(r"\s*[+-]?\d+\s*$")
_NUMBER = re.compile(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
_DATE = re.compile(r"\s*\d{4}-\d{1,2}-\d{1,2}\s*$")
_MOMENT = re.compile(r"\s*\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}.*)?\s*$")
_TRUTH = re.compile(r"\s*(true|false)\s*$", re.IGNORECASE)


@dataclass(frozen=True)
class Dialect:
    sep: str = ","
    quote: str = '"'
    escape: str = "\\"

    def options(self) -> dict[str, str]:
        return {"sep": self.sep, "quote": self.quote, "escape": self.escape}

    def fields(self, line: str) -> list[str]:
        """The fields of one line."""
        doubled = self.escape == self.quote
        quoting = {"quoting": csv.QUOTE_NONE} if not self.quote else {"quotechar": self.quote}
        rows = csv.reader([line], delimiter=self.sep, doublequote=doubled, escapechar=None if doubled else "\\", **quoting)
        try:
            return next(rows, [""])
        except csv.Error:  # a field of more than csv.field_size_limit() characters
            return line.split(self.sep)


@dataclass
class FileGroup:
    """Files that are read with the same options."""

    dialect: Dialect
    names: tuple[str, ...] | None  # None: the first line may hold values
    files: list[str] = field(default_factory=list)
    first_lines: set[str] = field(default_factory=set)


def _candidates(options: dict[str, str]) -> list[tuple[str, str]]:
    sep = options.get("sep", options.get("delimiter"))
    quote = options.get("quote")
    return [(s, q) for q in ([quote] if quote is not None else QUOTES) for s in ([sep] if sep else DELIMITERS)]


def _without_quoted(column, quote: str):
    if not quote:
        return column
    q = re.escape(quote)
    return F.regexp_replace(column, f"{q}(?:[^{q}\\\\]|\\\\.)*{q}", "")


def _lines(spark: SparkSession, path, options: dict[str, str]) -> DataFrame:
    """(file, block, row, value) of the lines that are not blank; ``row`` grows with the place in a block."""
    keep = {k: v for k, v in options.items() if k.lower() in ("encoding", "linesep", "recursivefilelookup", "pathglobfilter")}
    return (
        spark.read.options(**keep).text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
            "value",
        )
        .filter(F.trim("value") != "")
    )


def _counted(lines: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(file, block, candidate, n_fields, lines, row, backslashed, doubled), ``row`` being the first.

    All sums are numbers, which Spark keeps in a hash table of its few groups: lines are never sorted.
    """
    quotes = list(dict.fromkeys(q for _, q in pairs))
    marks = (F.col("value").contains('\\"'), F.col("value").rlike("[^,;|\t\"]\"\"|\"\"[^,;|\t\"]"))
    bare = [_without_quoted(F.col("value"), q).alias(f"bare{i}") for i, q in enumerate(quotes)]
    narrow = lines.select("file", "block", "row", marks[0].alias("backslashed"), marks[1].alias("doubled"), *bare)
    counts = []
    for i, (s, q) in enumerate(pairs):
        own = F.col(f"bare{quotes.index(q)}")
        n = F.length(own) - F.length(F.replace(own, F.lit(s), F.lit("")))
        counts.append(F.struct(F.lit(i).alias("candidate"), (n / len(s) + 1).cast("int").alias("n_fields")))
    return (
        narrow.select("file", "block", "row", "backslashed", "doubled", F.explode(F.array(*counts)).alias("c"))
        .groupBy("file", "block", "c.candidate", "c.n_fields")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.min("row").alias("row"),
            F.count_if("backslashed").alias("backslashed"),
            F.count_if("doubled").alias("doubled"),
        )
    )


def histograms(spark: SparkSession, path, options: dict[str, str] | None = None) -> DataFrame:
    """(file, first_line, candidate, n_fields, lines, backslashed, doubled): one scan of the lines.

    ``candidate`` numbers :func:`_candidates`; ``backslashed`` and ``doubled``
    count the lines that escape a quote one way or the other. The counts, a few
    rows a file and block, are kept; the first lines are looked up by their places.
    """
    options = options or {}
    ensure_checkpoint_dir(spark)
    counted = _counted(_lines(spark, path, options), _candidates(options)).checkpoint()
    first = counted.groupBy("file").agg(F.min(F.struct("block", "row")).alias("at")).select("file", "at.block", "at.row")
    first = _lines(spark, path, options).join(F.broadcast(first), ["file", "block", "row"]).select("file", F.col("value").alias("first_line"))
    sums = [F.sum(c).alias(c) for c in ("lines", "backslashed", "doubled")]
    return counted.groupBy("file", "candidate", "n_fields").agg(*sums).join(first, "file")


def _choose(rows: list, pairs: list[tuple[str, str]], options: dict[str, str]) -> Dialect:
    """The candidate whose commonest number of fields (above one) covers most lines; then more fields; then the order."""
    lines: dict[int, dict[int, int]] = {}
    for r in rows:
        own = lines.setdefault(r["candidate"], {})
        own[r["n_fields"]] = own.get(r["n_fields"], 0) + r["lines"]
    best, best_score = 0, (0.0, 0)
    for i in range(len(pairs)):
        total = sum(lines.get(i, {}).values())
        n, count = max(((n, c) for n, c in lines.get(i, {}).items() if n > 1), key=lambda x: (x[1], x[0]), default=(1, 0))
        score = (count / total if total else 0.0, n if count else 0)
        if score > best_score:
            best, best_score = i, score
    sep, quote = pairs[best]
    first = [r for r in rows if r["candidate"] == rows[0]["candidate"]]
    backslashed, doubled = (sum(r[c] for r in first) for c in ("backslashed", "doubled"))
    return Dialect(sep, quote, options.get("escape", quote if quote and doubled > backslashed else "\\"))


def is_value(text: str) -> bool:
    """Whether a field of a first line could be a value rather than a name."""
    return not text.strip() or any(p.match(text) for p in (_NUMBER, _MOMENT, _TRUTH))


def file_groups(spark: SparkSession, path, options: dict[str, str] | None = None) -> list[FileGroup]:
    """Files by header and dialect; files whose first line may be values by dialect and number of fields.

    The driver sees one line a distinct header and the file names that Spark lists itself.
    """
    options = options or {}
    pairs = _candidates(options)
    found = histograms(spark, path, options)
    sums = [F.sum(c).alias(c) for c in ("lines", "backslashed", "doubled")]
    by_line: dict[str, list] = {}
    for r in found.groupBy("first_line", "candidate", "n_fields").agg(*sums).collect():
        by_line.setdefault(r["first_line"], []).append(r)
    files = found.groupBy("first_line").agg(F.sort_array(F.collect_set("file")).alias("files")).collect()
    header = str(options.get("header", "auto")).lower()
    groups: dict[tuple, FileGroup] = {}
    for r in sorted(files, key=lambda r: r["files"]):
        line = r["first_line"]
        dialect = _choose(by_line[line], pairs, options)
        names = tuple(dialect.fields(line))
        valued = header == "false" or header == "auto" and any(map(is_value, names))
        key = (dialect, len(names) if valued else tuple(n.strip().lower() for n in names), valued)
        group = groups.setdefault(key, FileGroup(dialect, None if valued else names))
        group.files += map(as_path, r["files"])
        group.first_lines.add(line)
    return list(groups.values())


def fits(name: str, kind: T.DataType) -> bool:
    """Whether a field of the first line is a value of the column's type."""
    if re.fullmatch(r"_c\d+", name):  # an empty field
        return True
    if isinstance(kind, T.IntegralType):
        return bool(_INTEGER.match(name))
    if isinstance(kind, T.NumericType):
        return bool(_NUMBER.match(name))
    if isinstance(kind, T.DateType):
        return bool(_DATE.match(name))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return bool(_MOMENT.match(name))
    if isinstance(kind, T.BooleanType):
        return bool(_TRUTH.match(name))
    return True


def holds_values(below: T.StructType) -> bool:
    """Whether the names (read from the first line) fit the types below: then the line is a row."""
    typed = [f for f in below if not isinstance(f.dataType, T.StringType)]
    return bool(typed) and all(fits(f.name, f.dataType) for f in typed)


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the text of both (string holds all)."""
    if a == b:
        return a
    numeric = [isinstance(x, T.NumericType) for x in (a, b)]
    if all(numeric):
        whole = [isinstance(x, T.IntegralType) for x in (a, b)]
        if all(whole):
            return T.LongType()
        decimals = [T.DecimalType(19, 0) if isinstance(x, T.IntegralType) else x for x in (a, b)]
        if all(isinstance(x, T.DecimalType) for x in decimals):
            scale = max(x.scale for x in decimals)
            digits = max(x.precision - x.scale for x in decimals)
            return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else T.DoubleType()
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def united(schemas: list[T.StructType]) -> T.StructType:
    """All columns by name (case does not matter, the first spelling stays), in order of appearance."""
    columns: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema:
            known = columns.get(f.name.lower())
            columns[f.name.lower()] = T.StructField(known.name, join_types(known.dataType, f.dataType)) if known else f
    return T.StructType(list(columns.values()))


def _by_position(frame: DataFrame, columns: list[T.StructField], target: T.StructType) -> DataFrame:
    """``frame``, whose columns are ``columns`` in order, with the columns of ``target``."""
    place = {f.name.lower(): i for i, f in enumerate(columns)}
    plain = frame.toDF(*[f"c{i}" for i in range(len(columns))])
    return plain.select(
        *[
            (F.col(f"c{place[f.name.lower()]}") if f.name.lower() in place else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target
        ]
    )


def read_detected(spark: SparkSession, path, options: dict[str, str], schema: T.StructType | None) -> DataFrame | None:
    """Every file read by its dialect and header, columns united by name; None for an input without lines."""
    groups = file_groups(spark, path, options)
    if not groups:
        return None

    def reader(group: FileGroup, header: bool, own: T.StructType | None):
        opts = {k: v for k, v in options.items() if k.lower() not in ("sep", "delimiter", "quote", "escape", "header", "inferschema")}
        opts |= group.dialect.options() | {"header": str(header).lower()}
        made = spark.read.options(**opts)
        return made.schema(own) if own is not None else made.option("inferSchema", options.get("inferSchema", "true"))

    def files(group: FileGroup):
        return path if len(groups) == 1 else group.files

    if schema is not None:
        known = {f.name.lower(): f for f in schema}
        parts = []
        for group in groups:
            names = [n.strip().lower() for n in group.names or ()]
            by_name = bool(names) and set(names) <= known.keys() and len(set(names)) == len(names)
            own = T.StructType([known[n] for n in names]) if by_name else schema
            # Without names the columns are taken by position; a first line that may hold values is one only when asked.
            frame = reader(group, group.names is not None or str(options.get("header", "true")).lower() != "false", own).csv(files(group))
            parts.append(_by_position(frame, list(own), schema))
    else:
        inferred: list[tuple[FileGroup, bool, T.StructType]] = []
        for group in groups:
            header = group.names is not None or len(group.first_lines) == 1 and str(options.get("header", "auto")).lower() == "auto"
            found = reader(group, header, None).csv(files(group))
            if header and group.names is None and holds_values(found.schema):
                header, found = False, reader(group, False, None).csv(files(group))
            if len(groups) == 1:
                return found
            inferred.append((group, header, found.schema))
        target = united([s for _, _, s in inferred])
        types = {f.name.lower(): f.dataType for f in target}
        parts = []
        for group, header, found in inferred:
            # The text is read as the joined type at once: a value never goes through a narrower one.
            own = T.StructType([T.StructField(f.name, types[f.name.lower()]) for f in found])
            parts.append(_by_position(reader(group, header, own).csv(files(group)), list(own), target))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
