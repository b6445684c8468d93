"""Document fingerprints: every shingle hash below a fixed fraction of all hashes.

A text's shingles are its runs of SHINGLE code points (the whole text, if it
has fewer). The fingerprint keeps the distinct 48-bit hashes below
2**48 / SCALE, so its size follows the text's, fingerprints of parts merge to
that of the whole, and two very unequal texts can be compared: among the hashes
below the bound, the share of the smaller text's that the larger one has too
estimates containment.

Short texts would keep too few: every fingerprint has its FLOOR smallest
hashes at least (all, if there are fewer). It states the bound below which it
is complete, and two fingerprints are compared below the smaller bound.

``edited_texts`` replaces the end of every text by the beginning of the next
one in the order of ids. Texts are shuffled once, by ranges of the order; every
range also gets the first row of the one after it, and a task holds two texts
at a time.

Cases: a null or empty text has no hashes (an empty fingerprint, complete; its
likeness to another empty one is 1, to others 0) and lends no characters;
rows are ordered by id (null first), rows of equal ids by a hash of their text
and their text, so a common id is dealt to many ranges; equal rows are
neighbours; a single row is its own next one; very long texts are hashed in
parts; other columns do not matter (``fingerprints`` passes those named in
``keep`` through); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strata.llm.common import map_texts, materialise, table

SHINGLE = 20
#: One in SCALE hashes is kept, and the FLOOR smallest ones.
SCALE = 32
FLOOR = 64
BITS = 48
_LIMIT = (1 << BITS) // SCALE
#: The bound of a fingerprint that has all hashes of its text.
COMPLETE = (1 << BITS) - 1
#: Characters that are hashed at once; memory does not follow the length of a text.
CHUNK = 1 << 18
_MULTIPLIER = 0x9E3779B97F4A7C15
_FINISH = 0xD6E8FEB86659FD93


def shingle_hashes(text: str, n: int = SHINGLE) -> np.ndarray:
    """Distinct 48-bit hashes of the runs of n code points, ascending (all of them)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = min(n, len(points))
    if not n:
        return np.zeros(0, np.int64)
    parts = []
    for at in range(0, len(points) - n + 1, CHUNK):
        part = points[at : at + CHUNK + n - 1].astype(np.uint64)
        parts.append(np.unique(_run_hashes(part, n)))
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def _run_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """A polynomial over n code points by doubling: runs of 1, 2, 4 … are put together to n."""
    mixed = (points + np.uint64(n)) * np.uint64(_FINISH)
    mixed ^= mixed >> np.uint64(29)
    out, size, power, width = None, 0, mixed, 1
    while True:
        if n & width:
            # ``out`` covers ``size`` points, ``power`` the ``width`` points after them.
            shift = np.uint64(pow(_MULTIPLIER, width, 1 << 64))
            out = power if out is None else out[: len(power) - size] * shift + power[size:]
            size += width
        if width * 2 > n:
            break
        shift = np.uint64(pow(_MULTIPLIER, width, 1 << 64))
        power = power[: len(power) - width] * shift + power[width:]
        width *= 2
    out = out[: len(points) - n + 1].copy()
    out ^= out >> np.uint64(32)
    out *= np.uint64(_FINISH)
    out ^= out >> np.uint64(32)
    return (out >> np.uint64(64 - BITS)).astype(np.int64)


def sketch(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """(bound, kept hashes) of distinct ascending hashes: complete up to and with the bound."""
    if len(hashes) <= FLOOR:
        return COMPLETE, hashes
    kept = hashes[: max(int(np.searchsorted(hashes, _LIMIT)), FLOOR)]
    return (COMPLETE if len(kept) == len(hashes) else max(_LIMIT - 1, int(kept[-1]))), kept


def encoded(bound: int, hashes: np.ndarray) -> str:
    """The bound and the hashes, 8 characters each."""
    values = np.concatenate(([bound], hashes)).astype(">u8")
    return base64.b64encode(values.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def decoded(fingerprint: str) -> tuple[int, np.ndarray]:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 6)
    values = np.zeros((len(raw), 8), np.uint8)
    values[:, 2:] = raw
    values = values.view(">u8").astype(np.int64).ravel()
    return int(values[0]), values[1:]


def fingerprint(text: str | None) -> str:
    return encoded(*sketch(shingle_hashes(text or "")))


def merged(*fingerprints: str) -> str:
    """The fingerprint of all shingles together."""
    bounds, hashes = zip(*map(decoded, fingerprints))
    bound, union = min(bounds), np.unique(np.concatenate(hashes))
    if bound == COMPLETE:
        return encoded(*sketch(union))
    union = union[union <= bound]
    kept = union[: max(int(np.searchsorted(union, _LIMIT)), FLOOR)]
    return encoded(bound if len(kept) == len(union) else max(_LIMIT - 1, int(kept[-1])), kept)


def _below(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> tuple[int, int, int]:
    """Hashes of a, of b and of both below the smaller bound."""
    bound = min(a[0], b[0])
    x, y = (h[: int(np.searchsorted(h, bound, side="right"))] for h in (a[1], b[1]))
    return len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Estimated share of the shingles of either text that both have."""
    n_a, n_b, both = _below(a, b)
    return both / (n_a + n_b - both) if n_a + n_b else 1.0


def containment(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Estimated share of the shingles of a that b has too (1, if a has none)."""
    n_a, _, both = _below(a, b)
    return both / n_a if n_a else 1.0


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` with the fingerprint of every whole text."""
    return map_texts(docs, lambda: lambda texts: [[fingerprint(t) for t in texts]], "fingerprint string", keep, text)


def containments(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``pairs`` of fingerprints with a_in_b, b_in_a and likeness; null where one is null."""

    @F.pandas_udf("a_in_b double, b_in_a double, likeness double")
    def compared(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        rows = []
        for p, q in zip(x, y):
            if p is None or q is None:
                rows.append((None, None, None))
                continue
            p, q = decoded(p), decoded(q)
            rows.append((containment(p, q), containment(q, p), likeness(p, q)))
        return pd.DataFrame(rows, columns=["a_in_b", "b_in_a", "likeness"], dtype=float)

    return pairs.withColumn("_c", compared(F.col(a), F.col(b))).select(
        *pairs.columns, *[F.col(f"_c.{c}").alias(c) for c in ("a_in_b", "b_in_a", "likeness")]
    )


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of the next one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_FIELDS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _result(text: str, following: str, own: tuple, after: tuple) -> tuple:
    """The columns of _FIELDS; ``own`` and ``after`` are the sketches of both texts."""
    changed = edited(text, following)
    other = own if changed == text else sketch(shingle_hashes(changed))
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return len(text), digest, encoded(*own), encoded(*other), likeness(own, other), likeness(own, after)


class Ranges:
    """Deals (id, hash) to numbered ranges of the order, null ids first.

    Ids are cut at quantiles. An id that is several of them is dealt to all
    its ranges by hash, null ids likewise to theirs, so a common id does not
    fill one range; every range is one stretch of the order (id, hash).
    """

    def __init__(self, cuts: list[int], null_ranges: int):
        self.cuts, self.null_ranges = np.array(cuts, np.int64), null_ranges
        self.n = null_ranges + len(cuts) + 1

    @classmethod
    def of(cls, rows: DataFrame, n: int) -> Ranges:
        """About ``n`` ranges of equally many rows: quantiles of the ids from one pass over them."""
        shares = [i / n for i in range(1, n)] or [0.5]
        found = rows.agg(
            F.count(F.lit(1)).alias("rows"), F.count("__id").alias("known"), F.percentile_approx("__id", shares, max(10_000, 10 * n)).alias("cuts")
        ).first()
        nulls = found["rows"] - found["known"]
        return cls(found["cuts"] or [], -(-n * nulls // found["rows"]) if nulls else 0)

    def of_rows(self, ids: pd.Series, known: pd.Series, hashes: pd.Series) -> np.ndarray:
        """Range numbers; ``ids`` has any number where ``known`` is false (a null would turn longs into floats)."""
        known = known.to_numpy(bool)
        share = (hashes.to_numpy(np.int64).astype(np.float64) + 2.0**63) / 2.0**64
        out = np.zeros(len(ids), np.int64)
        values = ids[known].to_numpy(np.int64)
        low, high = (np.searchsorted(self.cuts, values, side=side) for side in ("left", "right"))
        out[known] = self.null_ranges + low + np.minimum(share[known] * (high - low + 1), high - low).astype(np.int64)
        out[~known] = np.minimum(share[~known] * self.null_ranges, max(self.null_ranges - 1, 0)).astype(np.int64)
        return out


def edited_fingerprints(docs: DataFrame, order: str = "doc_id", text: str = "text") -> DataFrame:
    """(order, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    rows = docs.select(F.col(order).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    ranges = Ranges.of(rows, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    @F.pandas_udf("int")
    def at(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for ids, known, hashes in batches:
            yield pd.Series(ranges.of_rows(ids, known, hashes))

    rows = rows.withColumn("__hash", F.xxhash64("__text"))
    rows = rows.withColumn("__at", at(F.coalesce(F.col("__id").cast("long"), F.lit(0)), F.col("__id").isNotNull(), "__hash"))
    # The first row of every range follows the last one of the range before it: one row a range.
    first = rows.groupBy("__at").agg(F.min(F.struct("__id", "__hash")).alias("f")).select("__at", "f.*")
    first = materialise(first, "firsts")
    same = F.broadcast(first.select(F.col("__at").alias("a"), F.col("__id").alias("i"), F.col("__hash").alias("h")))
    meets = (F.col("__at") == F.col("a")) & F.col("__id").eqNullSafe(F.col("i")) & (F.col("__hash") == F.col("h"))
    heads = rows.join(same, meets).groupBy("__at", "__id", "__hash").agg(F.min("__text").alias("__text"))
    filled = sorted(r[0] for r in first.select("__at").collect())  # numbers of ranges
    result = StructType.fromDDL(_FIELDS)
    schema = StructType([StructField(order, rows.schema["__id"].dataType), *result.fields])
    if not filled:
        return spark.createDataFrame([], schema)
    before = spark.createDataFrame(list(zip(filled, filled[-1:] + filled[:-1])), "__at int, before int")
    heads = heads.join(F.broadcast(before), "__at").select("__id", "__text", "__hash", F.col("before").alias("__at"), F.lit(1).alias("__after"))
    heads = materialise(heads, "heads")
    both = rows.withColumn("__after", F.lit(0)).unionByName(heads)
    dealt = both.repartitionById(ranges.n, "__at").sortWithinPartitions("__at", "__after", "__id", "__hash", "__text")
    arrow = to_arrow_schema(schema)

    def batch(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types, strict=True)], names=schema.names)

    def run(batches):
        held = None  # the row before: (id, text, sketch)
        for each in batches:
            found = []
            for own, words, after in zip(*(each.column(k).to_pylist() for k in range(3))):
                one = sketch(shingle_hashes(words))
                if held is not None:
                    found.append((held[0], *_result(held[1], words, held[2], one)))
                held = None if after else (own, words, one)
                if len(found) == 256:
                    yield batch(found)
                    found = []
            if found:
                yield batch(found)

    return dealt.select("__id", "__text", "__after").mapInArrow(run, schema)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
