"""Ingest manifest: format detection (S7), intake validation (S8), table slugs.

The manifest of a landing area is a DataFrame built from the ``binaryFile``
source with the ``content`` column pruned away, so listing millions of files
reads only their metadata. Magic bytes are read only for files whose name
does not decide the format, by executors, 4 KiB per file.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.naming import slug_column
from strata.sources.readers import CSV, EXCEL, JSON, PARQUET

# Fixed values (reference's intake rules): accepted extensions, 4 KiB head for magic bytes, parquet magic "PAR1", and the messages.
ALLOWED_EXTENSIONS = (".csv", ".json", ".parquet", ".pq", ".xls", ".xlsx")
HEAD_BYTES = 4096
PARQUET_MAGIC = b"PAR1"
MSG_INVALID_NAME = "Invalid filename."
MSG_EXTENSION = "Extension not allowed. Allowed: ['.csv', '.json', '.parquet', '.pq', '.xls', '.xlsx']"
MSG_NO_EXTENSION = "File must have an extension."
# Our own decision: legacy .xls has no reader here, so it is refused up front.
MSG_XLS = "Legacy .xls workbooks are not supported; save the sheet as .xlsx."

# Fixed values (format by extension).
EXTENSION_FORMATS = {
    ".csv": CSV,
    ".json": JSON,
    ".parquet": PARQUET,
    ".pq": PARQUET,
    ".xlsx": EXCEL,
    ".xls": EXCEL,
}

# Fixed value (characters that a stored file name must not have).
_UNSAFE = r"[^a-zA-Z0-9._\-]"


def size_message(max_bytes: int) -> str:
    return f"File exceeds {max_bytes // (1024 * 1024)} MB limit"


def _rules(name: Column, size: Column, max_bytes: int | None) -> list[tuple[Column, str]]:
    """S8 as one ordered table of (refused when, reason); the first that holds counts."""
    ext = _extension(safe_name(name))
    rules = [
        (name.isNull() | (name == "") | name.contains("..") | name.startswith("/"), MSG_INVALID_NAME),
        (ext == "", MSG_NO_EXTENSION),
        (~ext.isin(*ALLOWED_EXTENSIONS), MSG_EXTENSION),
        (ext == ".xls", MSG_XLS),
    ]
    return rules if max_bytes is None else [*rules, (size > max_bytes, size_message(max_bytes))]


def safe_name(name: Column) -> Column:
    """The last part of a name with unsafe characters replaced."""
    return F.regexp_replace(F.element_at(F.split(name, "/"), -1), _UNSAFE, "_")


def _evaluate(row: tuple, schema: str, *columns: Column):
    spark = SparkSession.active()
    return spark.createDataFrame([row], schema).select(*columns).first()


def detect_format(filename: str, head: bytes = b"") -> str:
    """S7 for one file: the extension decides, else the first bytes, else CSV."""
    columns = (_format_by_extension(_extension(F.trim("name"))), _format_by_head(F.col("head")))
    by_name, by_head = _evaluate((filename, head), "name STRING, head BINARY", *columns)
    return by_name or by_head


def validate_filename(filename: str, size: int | None = None, max_bytes: int | None = None):
    """S8 for one name: ``(True, safe_name)`` or ``(False, reason)``; the same rules as the manifest's."""
    columns = (validate_column(F.col("name"), F.col("size"), max_bytes), safe_name(F.col("name")))
    reason, safe = _evaluate((filename, size), "name STRING, size BIGINT", *columns)
    return (False, reason) if reason else (True, safe)


def _format_by_head(head: Column) -> Column:
    """Format by the first bytes: the Parquet magic, an opening bracket, else CSV."""
    text = F.ltrim(F.regexp_replace(F.decode(head, "ISO-8859-1"), r"^\s+", ""))
    return (
        F.when(F.substring(head, 1, len(PARQUET_MAGIC)) == F.lit(PARQUET_MAGIC), PARQUET)
        .when(F.substring(text, 1, 1).isin("{", "["), JSON)
        .otherwise(CSV)
    )


def detect_format_of_path(spark: SparkSession, path: str) -> str:
    """S7 for a path given to F2 or F4: its own extension, else what its files say.

    A folder's files must agree: by their extensions, or, if none has one, by
    the first bytes that Spark's own reader sees. Errors are not hidden.
    """
    own = EXTENSION_FORMATS.get(os.path.splitext(path.rstrip("/").lower())[1])
    if own:
        return own
    files = list_files(spark, path).filter("length > 0")
    by_name = _format_by_extension(_extension(F.element_at(F.split("path", "/"), -1)))
    kinds = [r[0] for r in files.select(by_name).distinct().collect()]  # at most the known formats
    if kinds == [None]:
        content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        heads = content.filter("length > 0").select(_format_by_head(F.substring("content", 1, HEAD_BYTES)))
        kinds = [r[0] for r in heads.distinct().collect()]
    if not kinds:
        return CSV
    if len(kinds) > 1:
        raise ValueError(f"{path} mixes formats: {sorted(str(k) for k in kinds)}")
    return kinds[0]


# ---------------------------------------------------------------- manifest


def _extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))


def _format_by_extension(ext: Column) -> Column:
    out = F.lit(None).cast("string")
    for suffix, kind in EXTENSION_FORMATS.items():
        out = F.when(ext == suffix, F.lit(kind)).otherwise(out)
    return out


def list_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """``(path, length, modificationTime)`` for every file under ``root``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(root)
        .select("path", "length", "modificationTime")
    )


def sniff_formats(paths: DataFrame) -> DataFrame:
    """``(path, sniffed_format)`` by the first bytes, read through Spark's file systems.

    A file that cannot be read fails the job; it never becomes a CSV file.
    """
    spark = paths.sparkSession
    names = [r[0] for r in paths.select("path").distinct().collect()]  # files without a known extension
    if not names:
        return spark.createDataFrame([], "path STRING, sniffed_format STRING")
    content = spark.read.format("binaryFile").load(names)
    return content.select("path", _format_by_head(F.substring("content", 1, HEAD_BYTES)).alias("sniffed_format"))


def job_id_column(path: Column, modified: Column) -> Column:
    """Deterministic UUID-shaped id of one file version (path + modification time),
    so a re-run of the same file lands on the same run-history partition."""
    h = F.sha2(F.concat_ws("|", path, F.unix_micros(modified).cast("string")), 256)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )


def validate_column(name: Column, size: Column, max_bytes: int | None = None) -> Column:
    """S8 as an expression: NULL when accepted, else the reason. No size limit by default."""
    out = F.lit(None).cast("string")
    for refused, reason in reversed(_rules(name, size, max_bytes)):
        out = F.when(refused, F.lit(reason)).otherwise(out)
    return out


def manifest(files: DataFrame, max_bytes: int | None = None, sniff: bool = True) -> DataFrame:
    """S7 + S8 + T8 over a file listing ``(path, length, modificationTime)``.

    Output: ``path, name, safe_name, length, modificationTime, job_id, format,
    accepted, reject_reason, slug``. The format comes from the extension; for
    names without a known extension the magic bytes decide (when ``sniff``).
    """
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    safe = safe_name(name)
    base = files.select(
        "path",
        name.alias("name"),
        safe.alias("safe_name"),
        "length",
        "modificationTime",
        job_id_column(F.col("path"), F.col("modificationTime")).alias("job_id"),
        _format_by_extension(_extension(safe)).alias("name_format"),
        validate_column(name, F.col("length"), max_bytes).alias("reject_reason"),
    )
    if sniff:
        unresolved = sniff_formats(base.filter(F.col("name_format").isNull()))
        base = base.join(unresolved, "path", "left")
        fmt = F.coalesce(F.col("name_format"), F.col("sniffed_format"))
    else:
        fmt = F.col("name_format")
    return base.select(
        "path",
        "name",
        "safe_name",
        "length",
        "modificationTime",
        "job_id",
        fmt.alias("format"),
        F.col("reject_reason").isNull().alias("accepted"),
        "reject_reason",
        slug_column(F.col("safe_name"), F.col("job_id")).alias("slug"),
    )
