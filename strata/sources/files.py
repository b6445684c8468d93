"""Names of files, and named files written from executors (one per row of ``(path, content)``).

Used to land whole files (a workbook, a JSON document) whose name and layout a
Spark writer cannot choose. Each task writes its own rows through the Arrow
file-system layer, so nothing passes through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def as_path(uri: str) -> str:
    """A path for Spark's readers that names just the file of ``_metadata.file_path`` (a URI)."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its terms: any store that Spark writes to."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder, if it is there."""
    system, jpath = _file_system(spark, path)
    system.delete(jpath, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder (none, if it is not there)."""
    system, jpath = _file_system(spark, path)
    if not system.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(jpath) if s.isDirectory())


def move_into(spark: SparkSession, staging: str, target: str) -> None:
    """Moves the data files below ``staging`` to the same places below ``target``, then deletes ``staging``.

    Spark's writers share one temporary folder a target, so two of them must not
    append to it at a time; moved files come side by side (their names are unique).
    """
    system, source = _file_system(spark, staging)
    below = len(system.makeQualified(source).toUri().getPath())
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = system.listFiles(source, True)
    while files.hasNext():
        found = files.next().getPath()
        if found.getName().startswith(("_", ".")):
            continue
        to = path(target + found.toUri().getPath()[below:])
        system.mkdirs(to.getParent())
        if not system.rename(found, to):
            raise OSError(f"cannot move {found} to {to}")
    system.delete(source, True)


def _split(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        local = uri[len("file:") :]
        while local.startswith("//"):
            local = local[1:]
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(uri)


def _write_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sizes = []
        for path, content in zip(pdf["path"], pdf["content"]):
            filesystem, inner = _split(path)
            parent = inner.rsplit("/", 1)[0]
            filesystem.create_dir(parent, recursive=True)
            with filesystem.open_output_stream(inner) as out:
                out.write(bytes(content))
            sizes.append(len(content))
        yield pd.DataFrame({"path": pdf["path"], "bytes": sizes})


def write_files(files: DataFrame) -> DataFrame:
    """Lazily write ``files(path STRING, content BINARY)``; returns ``(path, bytes)``."""
    return files.select("path", "content").mapInPandas(_write_partition, "path STRING, bytes BIGINT")
