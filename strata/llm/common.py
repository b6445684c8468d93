"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from strata.session import ensure_checkpoint_dir

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's own settings (4.1) for a write: its shuffle files go when it ends; texts reach Python in small batches.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
}


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage at a place all executors see, so that a lost executor
    rereads files and iterative plans stay short. Nothing reads the shuffle
    files of the write afterwards, so Spark removes them when it ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = {key: spark.conf.get(key, None) for key in _WRITING}
    for key, value in _WRITING.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def worker_state(key: str, make: Callable):
    """An object that lives as long as the Python worker (tasks reuse it)."""
    holder = sys.modules.setdefault("_strata_worker_state", types.ModuleType("_strata_worker_state"))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)


# ------------------------------------------------------------ word hashes

_SEED = 20240229


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words with good avalanche (two multiply-xorshift rounds)."""
    x = x.copy()
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class WordHasher:
    """64-bit hashes of the words of a text, computed over its UTF-8 bytes.

    Bytes go through a table of random 64-bit numbers (A-Z and a-z share
    theirs when ``lower``), and a polynomial in an odd base is summed modulo
    2**64; a prefix sum gives each word's value in one vectorised pass.
    """

    def __init__(self, lower: bool = True):
        rng = np.random.default_rng(_SEED)
        self.codes = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if lower:
            self.codes[65:91] = self.codes[97:123]
        self.base = int(rng.integers(1, 2**60)) * 8 + 5
        self.inverse = pow(self.base, -1, 2**64)
        self._powers = np.ones(1, np.uint64)
        self._inverses = np.ones(1, np.uint64)

    @staticmethod
    def _grow(base: int, n: int) -> np.ndarray:
        out = np.full(n, np.uint64(base), np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    #: Words of more bytes are hashed by themselves; powers cover one chunk.
    CHUNK = 1 << 16

    def spans(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte offsets (start, end) of the words."""
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = (raw != 32) & (raw - np.uint8(9) > 4)  # 9 to 13
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        return edge[::2], edge[1::2]

    def words(self, text: str | None) -> np.ndarray:
        """One hash per word, in order."""
        return self._hashed((text or "").encode("utf-8", "surrogatepass"))[0]

    def groups(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(hashes of the words of some neighbouring texts, number of words of each), for all texts in order.

        Texts are laid end to end, about CHUNK bytes at once (or one text of more).
        """
        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        first = size = 0
        for i in range(1, len(raws) + 1):
            size += len(raws[i - 1]) + 1
            if i == len(raws) or size + len(raws[i]) > self.CHUNK:
                hashes, start = self._hashed(b"\n".join(raws[first:i]))
                stops = np.cumsum([len(x) + 1 for x in raws[first:i]])
                yield hashes, np.diff(np.searchsorted(start, stops), prepend=0)
                first, size = i, 0

    def _hashed(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first byte of every word."""
        raw = np.frombuffer(data, np.uint8)
        start, end = self.spans(raw)
        if not len(start):
            return np.zeros(0, np.uint64), start
        if len(self._powers) < len(raw) + 1:
            n = max(self.CHUNK, 2 * len(raw))
            self._powers = self._grow(self.base, n)
            self._inverses = self._grow(self.inverse, n)
        sums = np.zeros(len(raw) + 1, np.uint64)
        values = sums[1:]
        self.codes.take(raw.astype(np.intp), out=values, mode="clip")  # clip: no copy of ``out``
        values *= self._powers[: len(raw)]
        np.cumsum(values, out=values)
        return _mix((sums[end] - sums[start]) * self._inverses[start] + (end - start).astype(np.uint64)), start


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words; with fewer words the whole sequence is one; none without words."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - n + 1 + k])
        out = _mix(out + np.uint64(n))
    return out


# ------------------------------------------------------------ wanted rows

#: Bits in the map of wanted ids: so many per id, and at most so many in all (64 MB).
MAP_BITS_PER_ID = 12
MAX_MAP_BITS = 1 << 29


#: Words of 64 bits in a row of the broadcast map.
_MAP_ROW = 64


def likely_rows(rows: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose ``key`` is among ``ids`` (materialised, one column of that name), and a few others.

    For whole rows that are joined next: a bit map with MAP_BITS_PER_ID bits
    per id drops all but about one in MAP_BITS_PER_ID of the rows that no id
    asks for. It is broadcast, of a size that is known and bounded (more than 40
    million ids fill it more and more), and built and looked up by Spark, so that
    nothing passes through Python; the join that follows decides.
    """
    from pyspark.sql import functions as F

    bits = min(MAX_MAP_BITS, 1 << max(10, (MAP_BITS_PER_ID * max(1, ids.count()) - 1).bit_length()))
    size = min(_MAP_ROW, bits // 64)
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    marks = ids.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(`{key}`), 64) AS int))").alias("m"))
    every = rows.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("m"))
    words = marks.union(every).withColumn("_map_row", F.expr(f"w DIV {size}"))
    words = words.groupBy("_map_row", "w").agg(F.bit_or("m").alias("m"))
    map_rows = words.groupBy("_map_row").agg(F.sort_array(F.collect_list(F.struct("w", "m")))["m"].alias("_map_words"))  # ``size`` words
    placed = rows.withColumn("_map_place", place)
    word = F.expr(f"_map_words[CAST(shiftright(_map_place, 6) % {size} AS int)]")
    asked = F.expr(f"shiftright(_map_place, 6) DIV {size}") == F.col("_map_row")
    return (
        placed.join(F.broadcast(map_rows), asked)
        .filter(F.getbit(word, (F.col("_map_place") % 64).cast("int")) == 1)
        .select(*[placed[f"`{c}`"] for c in rows.columns])
    )


def wanted_rows(rows: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose ``key`` is among ``ids`` (distinct, one column of that name); others are dropped before the shuffle."""
    # Not a semi join: Spark would move that below the map's join, and all rows would be shuffled.
    return likely_rows(rows, ids, key).join(ids, key).select(*[f"`{c}`" for c in rows.columns])


# ------------------------------------------------------------ components


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component_id): the smallest node reachable, for nodes with an edge.

    Label propagation with pointer jumping: every round each node takes the
    smallest label among itself and its neighbours, then its label's label.
    All joins and aggregates are distributed; labels are written to the shared
    folder each round so plans do not grow. Empty edges give an empty result.
    """
    from pyspark.sql import functions as F

    both = materialise(
        edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
        .union(edges.select(F.col(b).alias("node"), F.col(a).alias("other")))
        .filter("node <> other")
        .distinct(),
        "edges",
    )
    labels = materialise(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels"
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        step = materialise(
            step.join(jump, "mid", "left").select("node", "old", F.coalesce(F.least("mid", "far"), "mid").alias("label")),
            "labels",
        )
        labels = step.select("node", "label")
        if step.filter("old <> label").isEmpty():
            return labels.select("node", F.col("label").alias("component_id"))


def merged_components(label: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component_id) after ``label`` (of :func:`components`) takes more (a, b) links.

    Only links between different components become edges, one a pair of components.
    """
    from pyspark.sql import functions as F

    def of(end: str) -> DataFrame:
        return label.select(F.col("node").alias(end), F.col("component_id").alias(f"c{end}"))

    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    ends = ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).filter("a <> b")
    more = components(ends)
    moved = more.select(F.col("node").alias("component_id"), F.col("component_id").alias("to"))
    known = label.join(moved, "component_id", "left").select("node", F.coalesce("to", "component_id").alias("component_id"))
    return known.union(more.join(label, "node", "left_anti"))


# ------------------------------------------------------------ texts in Arrow

#: Rows that a text function gets at once.
BLOCK = 256


def map_texts(df: DataFrame, make: Callable, fields: str, keep: list[str], text: str = "text", many: bool = False) -> DataFrame:
    """``keep`` columns of every row with columns computed from its text (null: empty).

    ``make()`` runs once per task and gives a function from a list of texts to
    one list per field (DDL in ``fields``). With ``many`` the first list has
    the row's number for each result row, for functions with any number of
    rows per text. Kept columns that a field is named like are left out.
    """
    import pyarrow as pa
    from pyspark.sql import functions as F
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    added = StructType.fromDDL(fields) if hasattr(StructType, "fromDDL") else _parse_datatype_string(fields)
    names = {f.name.lower() for f in added}
    kept = [c for c in keep if c.lower() not in names]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"))
    schema = StructType(source.schema.fields[:-1] + added.fields)
    arrow_types = list(to_arrow_schema(added).types)
    n_kept, out_names = len(kept), schema.names

    def run(batches):
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                columns = work([t or "" for t in part.column(n_kept).to_pylist()])
                own = [part.column(i) for i in range(n_kept)]
                if many:
                    index = pa.array(columns[0], pa.int64())
                    own, columns = [c.take(index) for c in own], columns[1:]
                yield pa.RecordBatch.from_arrays(
                    own + [pa.array(c, t) for c, t in zip(columns, arrow_types, strict=True)], names=out_names
                )

    return source.mapInArrow(run, schema)


def sliding(values: np.ndarray, width: int, least: np.ufunc = np.minimum) -> np.ndarray:
    """The least (or greatest, with np.maximum) of every ``width`` neighbours, by doubling."""
    if len(values) < width:
        return values[:0]
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out, done = least(out[:-step], out[step:]), done + step
    return out
