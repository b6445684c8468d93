"""JSON layouts: lines, and documents cut into records in parallel.

*Layout.* Files are read as lines; what the JSON parser itself says about the
first record of a file decides. If the parser takes every line, nothing more is
read. A file whose first record it rejects, though it begins like an object or
an array, is a document. Files larger than a split are looked at before, by
their first characters, so that no line of many gigabytes is ever built.

*Documents* (one array, one pretty-printed object, several one after the other)
are cut at every object that no other object encloses. A document is read in
blocks, the splits of Spark's text reader. What a block does to the state of a
parser (inside or outside a string, braces open) is a small map, whatever comes
before the block; a scan over the maps of a file gives the state at the start
of every block, and then all blocks cut their records at once. Records that
reach over the ends of blocks are put together from their parts. The records
are written as JSON lines to the shared checkpoint folder, so everything after
it reads lines. Values outside any object (numbers in an array, say) are no
records; texts are UTF-8.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir
from strata.sources.files import as_path

#: Maps of blocks that are broadcast; more of them are joined by a shuffle.
BROADCAST_BLOCKS = 200_000
#: Large files whose first characters are asked for in one job.
HEADS_PER_JOB = 64
_BAD = "__rejected"
_OPEN, _CLOSE, _QUOTE, _BACKSLASH = 123, 125, 34, 92
#: Line ends can only stand between values; a record becomes one line.
_ONE_LINE = bytes(32 if b in (10, 13) else b for b in range(256))


# ------------------------------------------------------------ layout


def _file():
    return F.col("_metadata.file_path")


def _bytes(size: str) -> int:
    """Spark's notation of sizes: 134217728b, 128m, 1g."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([bkmgt]?)b?\s*", size.lower()).groups()
    return int(number) << 10 * "bkmgt".index(unit or "b")


def _large_documents(spark: SparkSession, path) -> list[str]:
    """Files larger than a split that begin like a document."""
    limit = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    paths = [path] if isinstance(path, str) else path
    sizes = spark.read.format("binaryFile").load(paths).filter(F.col("length") > limit)
    large = [as_path(r[0]) for r in sizes.select(_file()).collect()]  # as many as there are files of several splits
    found = []
    for at in range(0, len(large), HEADS_PER_JOB):
        heads = None
        for name in large[at : at + HEADS_PER_JOB]:
            # One row: the read stops after the first piece.
            head = spark.read.option("lineSep", "}").text(name).limit(1).select(F.lit(name).alias("file"), F.ltrim("value").alias("head"))
            heads = head if heads is None else heads.union(head)
        begins = F.regexp_replace("head", r"^[\s\x{FEFF}]+", "")
        document = begins.startswith("[") | begins.startswith("{") & begins.rlike(r"[\r\n]")
        found += [r["file"] for r in heads.filter(document).collect()]
    return found


def rejected_first(spark: SparkSession, path, options: dict[str, str]) -> list[str]:
    """Files whose first record is no JSON line, though it begins like an object or an array."""
    rows = spark.read.options(**options).schema(f"__none string, {_BAD} string").option("columnNameOfCorruptRecord", _BAD).json(path)
    at = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    begins = F.substring(F.regexp_replace(_BAD, r"^[\s\x{FEFF}]+", ""), 1, 1)
    rows = rows.select(_file().alias("file"), at.alias("at"), "__none", F.coalesce(begins, F.lit("good")).alias("begins"))
    # Blank lines say nothing. The reader refuses to give the rejected text alone, so the other column is counted too.
    first = rows.groupBy("file").agg(
        F.min_by("begins", F.when(F.col("begins") != "", F.col("at"))).alias("begins"), F.count("__none").alias("n")
    )
    first = first.filter(F.col("n") >= 0)
    return sorted(as_path(r["file"]) for r in first.filter(F.col("begins").isin("[", "{")).collect())


def document_files(spark: SparkSession, path, options: dict[str, str] | None = None) -> list[str]:
    """The files of ``path`` that hold documents rather than lines."""
    large = _large_documents(spark, path)
    rest = [f for f in _names(spark, path) if f not in set(large)] if large else path
    return sorted(large + (rejected_first(spark, rest, options or {}) if rest else []))


def _names(spark: SparkSession, path) -> list[str]:
    """The files that Spark lists for ``path``."""
    paths = [path] if isinstance(path, str) else path
    return [as_path(r[0]) for r in spark.read.format("binaryFile").load(paths).select(_file()).collect()]


# ------------------------------------------------------------ blocks


def _braces(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(places of braces, +1 or -1, quotes before each, all quotes); escaped quotes do not count."""
    quotes = np.flatnonzero(raw == _QUOTE)
    slashes = raw == _BACKSLASH
    if len(quotes) and slashes.any():
        # The run of backslashes before a quote: an odd one escapes it.
        plain = np.where(slashes, -1, np.arange(len(raw)))
        last = np.maximum.accumulate(plain)
        before = np.where(quotes > 0, quotes - 1 - last[np.maximum(quotes - 1, 0)], 0)
        quotes = quotes[before % 2 == 0]
    places = np.flatnonzero((raw == _OPEN) | (raw == _CLOSE))
    return places, np.where(raw[places] == _OPEN, 1, -1), np.searchsorted(quotes, places), len(quotes)


class BlockMap:
    """What a block does to a parser that enters it outside (0) or inside (1) a string."""

    def __init__(self):
        self.inside, self.depth, self.lowest = [0, 1], [0, 0], [0, 0]

    def feed(self, raw: bytes) -> None:
        _, steps, quotes, n = _braces(np.frombuffer(raw, np.uint8))
        for start in (0, 1):
            counted = steps[(quotes + self.inside[start]) % 2 == 0]
            if len(counted):
                depths = self.depth[start] + np.cumsum(counted)
                self.lowest[start] = min(self.lowest[start], int(depths.min()))
                self.depth[start] = int(depths[-1])
            self.inside[start] = (self.inside[start] + n) % 2


class Cutter:
    """Cuts the records of one block, entered in a known state."""

    def __init__(self, inside: int, depth: int):
        self.inside, self.depth = inside, depth
        self.open: list[bytes] = []
        self.own = depth <= 0  # whether the open record began in this block

    def feed(self, raw: bytes) -> tuple[bytes | None, list[bytes]]:
        """(the rest of a record that began in an earlier block, whole records)."""
        raw = raw.translate(_ONE_LINE)
        places, steps, quotes, n = _braces(np.frombuffer(raw, np.uint8))
        outside = (quotes + self.inside) % 2 == 0
        places, steps = places[outside], steps[outside]
        depths = self.depth + np.cumsum(steps)
        starts = places[(steps > 0) & (depths == 1)].tolist()
        ends = (places[(steps < 0) & (depths == 0)] + 1).tolist()
        tail, whole, at = None, [], 0
        if self.depth > 0:
            if not ends:
                self.open.append(raw)
            else:
                self.open.append(raw[: ends[0]])
                closed = b"".join(self.open)
                if self.own:
                    whole.append(closed)
                else:
                    tail = closed
                self.open, self.own, at = [], True, 1
        if self.depth <= 0 or ends:
            whole += [raw[s:e] for s, e in zip(starts, ends[at:])]
            if len(starts) > len(ends) - at:
                self.open = [raw[starts[-1] :]]
        self.depth = int(depths[-1]) if len(depths) else self.depth
        self.inside = (self.inside + n) % 2
        return tail, whole


def _pieces(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, block, value): the text of all files in order, cut after every closing brace."""
    return (
        spark.read.option("lineSep", "}").text(files)
        .select(_file().alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    )


def _runs(batch, columns: list[int]):
    """Stretches of a batch that belong to one block: (their first row, their bytes)."""
    import pyarrow as pa

    n = batch.num_rows
    file, block = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    values = batch.column(columns[-1]).cast(pa.binary()).to_pylist()
    start = 0
    for at in range(1, n + 1):
        if at == n or block[at] != block[start] or file[at] != file[start]:
            yield start, (file[start], block[start]), b"}".join(values[start:at]) + b"}"
            start = at


def block_maps(pieces: DataFrame) -> DataFrame:
    """One row per block: the state after it, its change of depth and its lowest depth, for both ways to enter it."""
    import pyarrow as pa

    names = ["file", "block", "inside", "depth", "lowest"]

    def run(batches):
        key, state = None, None

        def row():
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (state.inside, state.depth, state.lowest)]
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), *lists], names=names)

        for batch in batches:
            for _, own, raw in _runs(batch, [2]):
                if own != key:
                    if state is not None:
                        yield row()
                    key, state = own, BlockMap()
                state.feed(raw)
        if state is not None:
            yield row()

    return pieces.mapInArrow(run, "file string, block long, inside array<long>, depth array<long>, lowest array<long>")


def _scan(maps: pd.DataFrame) -> pd.DataFrame:
    """The state in which every block of a file is entered, and the block in which the open record began."""
    rows, inside, depth, opener = [], 0, 0, -1
    for m in maps.sort_values("block").itertuples():
        rows.append((m.file, m.block, inside, depth, opener if depth > 0 else -1))
        if depth <= 0 or depth + m.lowest[inside] <= 0:
            opener = m.block
        depth += int(m.depth[inside])
        inside = int(m.inside[inside])
    return pd.DataFrame(rows, columns=["file", "block", "inside", "depth", "opener"])


def block_starts(maps: DataFrame) -> DataFrame:
    """(file, block, inside, depth, opener): a scan over the maps of each file, one small row a block."""
    return maps.groupBy("file").applyInPandas(_scan, "file string, block long, inside int, depth long, opener long")


def _cut(pieces: DataFrame) -> DataFrame:
    """(opener, block, file, value): records (opener null), and parts of records by the block that their record began in."""
    import pyarrow as pa

    names = ["file", "opener", "block", "value"]

    def rows(found):
        files, openers, blocks, values = zip(*found)
        return pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(openers, pa.int64()), pa.array(blocks, pa.int64()), pa.array(values, pa.binary()).cast(pa.string())],
            names=names,
        )

    def run(batches):
        key, cutter, opener = None, None, -1

        def left():
            """The part of a record that is still open when its block ends."""
            if cutter is None or not cutter.open:
                return []
            return [(key[0], key[1] if cutter.own else opener, key[1], b"".join(cutter.open))]

        for batch in batches:
            entered = batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for first, own, raw in _runs(batch, [5]):
                found = []
                if own != key:
                    found += left()
                    key, opener = own, entered[2][first]
                    cutter = Cutter(entered[0][first], entered[1][first])
                tail, whole = cutter.feed(raw)
                if tail is not None:
                    found.append((key[0], opener, key[1], tail))
                found += [(key[0], None, key[1], r) for r in whole]
                if found:
                    yield rows(found)
        if found := left():
            yield rows(found)

    return pieces.mapInArrow(run, "file string, opener long, block long, value string")


def cut_documents(spark: SparkSession, files: list[str]) -> list[str]:
    """Writes the records of document files as JSON lines; gives the folders that hold them."""
    pieces = _pieces(spark, files)
    folder = f"{ensure_checkpoint_dir(spark)}/json-records-{uuid.uuid4().hex}"
    block_starts(block_maps(pieces)).write.parquet(f"{folder}/starts")
    starts = spark.read.parquet(f"{folder}/starts")
    if starts.count() <= BROADCAST_BLOCKS:
        entered = pieces.join(F.broadcast(starts), ["file", "block"])
    else:
        numbered = pieces.withColumn("row", F.monotonically_increasing_id())
        entered = numbered.join(starts.hint("shuffle_merge"), ["file", "block"]).sortWithinPartitions("file", "block", "row")
    cut = _cut(entered.select("file", "block", "inside", "depth", "opener", "value"))
    part = F.to_json(F.struct("file", "opener", "block", "value"))
    whole = F.col("opener").isNull()
    kinds = cut.select(F.when(whole, F.col("value")).otherwise(part).alias("value"), F.when(whole, "records").otherwise("parts").alias("kind"))
    kinds.write.partitionBy("kind").text(f"{folder}/cut")
    parts = cut_parts(spark, folder)
    parts.groupBy("file", "opener").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "value"))), lambda p: p["value"]), "").alias("value")
    ).select("value").write.text(f"{folder}/joined")  # a group holds the parts of one record
    return [p for p in (f"{folder}/cut/kind=records", f"{folder}/joined") if _exists(spark, p)]


def cut_parts(spark: SparkSession, folder: str) -> DataFrame:
    schema = "file string, opener long, block long, value string"
    path = f"{folder}/cut/kind=parts"
    return spark.read.schema(schema).json(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def _exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.schema("value string").text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_detected(spark: SparkSession, path, options: dict[str, str], schema: str | None) -> DataFrame:
    """Lines and documents of ``path``, all records by one schema."""

    def reader():
        made = spark.read.options(**options)
        return made.schema(schema) if schema else made

    bad = options.get("columnNameOfCorruptRecord", spark.conf.get("spark.sql.columnNameOfCorruptRecord"))
    large = _large_documents(spark, path)
    names = _names(spark, path) if large else []
    rest = [f for f in names if f not in set(large)] if large else path
    lines = reader().json(rest) if rest else None
    # The parser has seen every line for the types: without a rejected one there is no document.
    suspected = lines is not None and (schema is not None or bad in lines.columns)
    documents = large + (rejected_first(spark, rest, options) if suspected else [])
    if not documents:
        return lines
    other = [f for f in names or _names(spark, path) if f not in set(documents)]
    return reader().json(other + cut_documents(spark, documents))
