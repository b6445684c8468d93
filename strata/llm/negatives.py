"""Hard-negative mining over anchor-candidate tiles of Strassen products.

Anchors and candidates are packed into blocks of integer vectors; a block of
anchors meets every block of candidates, and Strassen's recursion (seven
products of half the size instead of eight, sides padded with zeros to even
lengths) gives all scores of the tile. It only adds, subtracts and multiplies, so int64
arithmetic, which is exact modulo 2**64, gives every score that fits a long; where
a tile's components are so large that one might not fit, the same recursion
runs over Python's integers.

Two passes of tiles: the first keeps a heap of the best same-label rows of
every anchor, the second, for every positive, a heap of the best rows of
another label whose score lies in the positive's window. A task merges the
heaps of its tiles before it hands them on; heaps of tasks merge by a window.

The candidates are dealt round-robin to SLICES_PER_SLOT slices per task slot of
the cluster, so copies, common labels and common vectors spread; anchors go to
every slice, a fixed number of times however many candidates there are.

Cases: rows with a null id, label or vector, an empty vector, or null or
non-finite components take no part; components that would not fit a long take
the nearest long; rows only meet vectors of their length and never rows of
their own id; other rows count as often as they come, and repeated anchors are
mined one by one; scores beyond a long count as the nearest long; windows of negative positives
are empty; fewer rows than asked for give fewer results; an empty table gives
an empty result; other columns do not matter.
"""

from __future__ import annotations

from heapq import nsmallest

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import materialise, table

SCALE = 256
ANCHOR_EVERY = 50
LABEL_SHIFT_EVERY, LABELS = 7, 10
POSITIVES, NEGATIVES = 5, 3
#: A negative's score, in hundredths of the positive's: from LOW to HIGH.
LOW, HIGH = 50, 95
#: Rows in a block of anchors and of candidates; sides below LEAF are multiplied plainly.
ANCHOR_BLOCK, BLOCK = 256, 2_048
LEAF = 32
SLICES_PER_SLOT = 2
#: Heap entries that a task holds before it hands them on.
HELD = 2_000_000
_LONG = np.iinfo(np.int64)


# ------------------------------------------------------------ products


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two integer matrices by Strassen's recursion."""
    n, k, m = *a.shape, b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    a, b = (np.pad(x, ((0, x.shape[0] % 2), (0, x.shape[1] % 2))) for x in (a, b))
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * j), p1.dtype)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def tile_scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of all rows (int64); those beyond a long are the nearest one."""
    size = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (anchors, candidates)]
    if size[0] * size[1] * anchors.shape[1] < 2**63:
        return strassen(anchors, candidates.T)
    exact = strassen(anchors.astype(object), candidates.T.astype(object))
    return np.clip(exact, -_LONG.max, _LONG.max).astype(np.int64)


# ------------------------------------------------------------ blocks


def integer_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): the rows that take part, labels shifted, integer components."""
    doubles = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    usable = F.forall("d", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % LABEL_SHIFT_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    return (
        vectors.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
        .select(F.col("vec_id").cast("long").alias("vec_id"), shifted.alias("label"), doubles.alias("d"))
        .filter((F.size("d") > 0) & usable)
        .select("vec_id", "label", F.transform("d", lambda x: F.floor(x * SCALE)).alias("v"))
    )


def _packed(rows: DataFrame, size: int, extra: list[str]) -> DataFrame:
    """Rows in blocks of equal vector length, ordered by vec_id inside: (slice, dim, ids, labels, data, *extra).

    ``slice`` is the number of the task; further int64 or list columns are packed as they are.
    """
    import pyarrow as pa
    from pyspark import TaskContext

    names = ["slice", "dim", "ids", "labels", "data", *extra]
    kinds = {"anchor": "binary", "low": "array<array<long>>", "high": "array<array<long>>"}

    def run(batches):
        at = TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size).to_pydict()
                lengths = np.array([len(v) for v in part["v"]])
                for dim in np.unique(lengths).tolist():
                    own = sorted(np.flatnonzero(lengths == dim).tolist(), key=part["vec_id"].__getitem__)
                    columns = [pa.array([at], pa.int32()), pa.array([dim], pa.int32())]
                    for c in ("vec_id", "label", "v"):
                        columns.append(pa.array([np.array([part[c][k] for k in own], np.int64).tobytes()], pa.binary()))
                    for c in extra:
                        values = [part[c][k] for k in own]
                        if kinds[c] == "binary":
                            columns.append(pa.array([np.array(values, np.int64).tobytes()], pa.binary()))
                        else:
                            columns.append(pa.array([values], pa.list_(pa.list_(pa.int64()))))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = "slice int, dim int, ids binary, labels binary, data binary"
    return rows.mapInArrow(run, ", ".join([fields, *[f"{c} {kinds[c]}" for c in extra]]))


def _tiles(anchors: DataFrame, candidates: DataFrame, extra: list[str], slices: int) -> DataFrame:
    """Every block of anchors beside every block of candidates of its vector length."""
    n = anchors.count()
    blocks = _packed(anchors.repartition(max(1, -(-n // ANCHOR_BLOCK))), ANCHOR_BLOCK, extra).drop("slice")
    blocks = blocks.select(
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "dim",
        *[F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "data")], *extra,
    )
    tiles = candidates.join(blocks, ["slice", "dim"])
    return tiles.select("dim", "ids", "labels", "data", "a_ids", "a_labels", "a_data", *extra)


def _arrays(row: dict) -> tuple[np.ndarray, ...]:
    """Scores of a tile, ids and labels of its candidates, ids and labels of its anchors."""
    ids, labels, a_ids, a_labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "a_ids", "a_labels"))
    a, c = (np.frombuffer(row[x], np.int64).reshape(-1, row["dim"]) for x in ("a_data", "data"))
    return tile_scores(a, c), ids, labels, a_ids, a_labels


# ------------------------------------------------------------ heaps


class Heaps:
    """For every key the k best (score, id): highest score, then smallest id. Heaps of one key merge."""

    def __init__(self, k: int):
        self.k, self.best, self.size = k, {}, 0

    def add(self, key, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offers rows; at most k of them, in order."""
        if not len(ids):
            return
        offered = [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())]
        known = self.best.get(key)
        if known is None:
            self.best[key] = offered
            self.size += len(offered)
        else:
            self.best[key] = nsmallest(self.k, known + offered)
            self.size += len(self.best[key]) - len(known)

    def take(self) -> list[tuple]:
        rows = [(*key, -s, i) for key, heap in self.best.items() for s, i in heap]
        self.best, self.size = {}, 0
        return rows


def _heaped(tiles: DataFrame, k: int, offer, keys: list[str]) -> DataFrame:
    """(*keys, score, vec_id): the heaps that tasks are left with; ``offer(heaps, row)`` works a tile."""
    import pyarrow as pa

    names = [*keys, "score", "vec_id"]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    def run(batches):
        heaps = Heaps(k)
        for each in batches:
            for at in range(each.num_rows):
                offer(heaps, each.slice(at, 1).to_pylist()[0])
                if heaps.size > HELD:
                    yield batch(heaps.take())
        if heaps.size:
            yield batch(heaps.take())

    return tiles.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _ranked(heaps: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The heaps of all tasks merged, with rank from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _offer_positives(heaps: Heaps, row: dict) -> None:
    scores, ids, labels, a_ids, a_labels = _arrays(row)
    numbers = np.frombuffer(row["anchor"], np.int64)
    for at in range(len(a_ids)):
        own = np.flatnonzero((labels == a_labels[at]) & (ids != a_ids[at]))
        best = own[np.argsort(-scores[at, own], kind="stable")[: heaps.k]]  # candidates come by id
        heaps.add((int(numbers[at]),), scores[at, best], ids[best])


def _offer_negatives(heaps: Heaps, row: dict) -> None:
    scores, ids, labels, a_ids, a_labels = _arrays(row)
    numbers = np.frombuffer(row["anchor"], np.int64)
    for at, (lows, highs) in enumerate(zip(row["low"], row["high"])):
        other = np.flatnonzero((labels != a_labels[at]) & (ids != a_ids[at]) & (scores[at] >= min(lows)) & (scores[at] <= max(highs)))
        other = other[np.argsort(-scores[at, other], kind="stable")]
        falling = -scores[at, other]
        for turn, (low, high) in enumerate(zip(lows, highs)):
            first = int(np.searchsorted(falling, -high))
            best = other[first : min(first + heaps.k, int(np.searchsorted(falling, -low, side="right")))]
            heaps.add((int(numbers[at]), turn), scores[at, best], ids[best])


# ------------------------------------------------------------ mining


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` and ``anchors`` have vec_id, label and v (:func:`integer_rows`).
    """
    slices = SLICES_PER_SLOT * rows.sparkSession.sparkContext.defaultParallelism
    candidates = materialise(_packed(rows.repartition(slices), BLOCK, []), "candidates")
    asked = materialise(anchors.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    found = _heaped(_tiles(asked, candidates, ["anchor"], slices), positives, _offer_positives, ["anchor"])
    best = materialise(_ranked(found, ["anchor"], positives).select("anchor", "score", "vec_id", "rank"), "positives")

    # low % and high % of a positive's score, rounded inwards; decimals hold hundreds of longs.
    score = F.col("score").cast("decimal(38,0)")
    lowest, highest = F.ceil(score * low / 100).cast("long"), F.floor(score * high / 100).cast("long")
    windows = best.select("anchor", F.struct("rank", lowest.alias("low"), highest.alias("high")).alias("w"))
    windows = windows.filter("w.low <= w.high").groupBy("anchor").agg(F.sort_array(F.collect_list("w")).alias("w"))
    open_ones = asked.join(windows, "anchor").select(
        "vec_id", "label", "v", "anchor", F.col("w.low").alias("low"), F.col("w.high").alias("high"), F.col("w.rank").alias("turns")
    )
    open_ones = materialise(open_ones, "windows")
    tiles = _tiles(open_ones.drop("turns"), candidates, ["anchor", "low", "high"], slices)
    found = _ranked(_heaped(tiles, negatives, _offer_negatives, ["anchor", "turn"]), ["anchor", "turn"], negatives)
    found = found.join(open_ones.select("anchor", F.col("vec_id").alias("anchor_id"), "turns"), "anchor").select(
        "anchor", "anchor_id", F.get("turns", F.col("turn").cast("int")).alias("positive_rank"),
        F.col("rank").alias("negative_rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    known = best.select("anchor", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(known, ["anchor", "positive_rank"]).select(
        "anchor_id", "positive_id", F.col("negative_rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = integer_rows(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return hard_negatives(rows, rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0))


ORACLE_SQL = f"""
WITH x AS (SELECT row_number() OVER () AS n, vec_id,
    CASE WHEN vec_id % {LABEL_SHIFT_EVERY} = 0 THEN (CAST(label AS BIGINT) + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
s AS (SELECT a.n, a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, x.v), lambda p: CAST(p[1] AS HUGEINT) * p[2])) AS BIGINT) AS score
  FROM x a JOIN x ON a.vec_id <> x.vec_id AND len(a.v) = len(x.v) WHERE a.vec_id % {ANCHOR_EVERY} = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS turn FROM s WHERE same),
w AS (SELECT p.n, p.anchor_id, p.turn, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.n = s.n AND NOT s.same WHERE p.turn <= {POSITIVES}
  AND {LOW} * CAST(p.score AS HUGEINT) <= 100 * CAST(s.score AS HUGEINT) AND 100 * CAST(s.score AS HUGEINT) <= {HIGH} * CAST(p.score AS HUGEINT)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY n, turn ORDER BY negative_score DESC, negative_id) AS INT) AS rank FROM w)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= {NEGATIVES}
"""
