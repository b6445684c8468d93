"""Dataset readers (S1-S6) and format dispatch.

Any Hadoop file-system path works (``file:``, ``s3a://``, ``gs://``, ``hdfs://``),
as a single file, a directory or a glob; Spark splits the scan across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.sources import csv_dialect, json_layout

PARQUET, CSV, JSON, EXCEL = "parquet", "csv", "json", "excel"

# Fixed values (format names and aliases accepted by the reference).
FORMAT_ALIASES = {
    "parquet": PARQUET,
    "csv": CSV,
    "json": JSON,
    "excel": EXCEL,
    "xlsx": EXCEL,
    "xls": EXCEL,
}

# Fixed CSV defaults (reference's): header on, types inferred, one record per line.
CSV_DEFAULTS = {"header": "true", "inferSchema": "true", "multiLine": "false"}


def normalize_format(fmt: str) -> str:
    """Canonical format name; unknown names raise ``ValueError``."""
    key = (fmt or "").lower().strip()
    if key not in FORMAT_ALIASES:
        raise ValueError(f"Unsupported format: {fmt}")
    return FORMAT_ALIASES[key]


def _reader(spark: SparkSession, schema: str | None):
    return spark.read.schema(schema) if schema else spark.read


def read_csv(
    spark: SparkSession, path: str, options: dict[str, str] | None = None, schema: str | None = None
) -> DataFrame:
    """S2. Delimiter, quote, escape and header are found per file from one scan of
    the lines; files whose headers name other columns, or the same ones in another
    order, are united by name, each column with the least type that holds all of
    it. Given options (``sep``, ``quote``, ``escape``, ``header``) are taken as they are.

    Type inference reads the input once more; for very large input pass ``schema``
    (a DDL string; columns go by name where a header has those names, else by
    position). ``detect=false`` skips the scan of the lines: comma, header, one
    layout for all files.
    """
    opts = {"multiLine": CSV_DEFAULTS["multiLine"], **(options or {})}
    detect = str(opts.pop("detect", "true")).lower() != "false"
    typed = StructType.fromDDL(schema) if schema else None
    found = csv_dialect.read_detected(spark, path, opts, typed) if detect else None
    if found is not None:
        return found
    opts = {**CSV_DEFAULTS, **opts}
    if schema:
        opts.pop("inferSchema", None)
    return _reader(spark, schema).options(**opts).csv(path)


def read_json(
    spark: SparkSession, path: str, options: dict[str, str] | None = None, schema: str | None = None
) -> DataFrame:
    """S3 with layout detection (D1) per file: a folder may hold files of JSON
    lines and files of one document; see :mod:`strata.sources.json_layout`. Pass
    ``multiLine`` to the reader to skip the detection."""
    opts = dict(options or {})
    if "multiLine" in opts:
        return _reader(spark, schema).options(**opts).json(path)
    return json_layout.read_detected(spark, path, opts, schema)


def load(
    spark: SparkSession,
    path: str,
    fmt: str,
    options: dict[str, str] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Read ``path`` as ``fmt`` (csv, json, parquet, excel/xlsx/xls).

    ``schema`` (DDL) skips type inference for CSV/JSON.
    """
    kind = normalize_format(fmt)
    if kind == PARQUET:
        return _reader(spark, schema).options(**(options or {})).parquet(path)
    if kind == CSV:
        return read_csv(spark, path, options, schema)
    if kind == JSON:
        return read_json(spark, path, options, schema)
    from strata.sources.excel import read_excel

    return read_excel(spark, path)
