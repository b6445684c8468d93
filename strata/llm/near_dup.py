"""Near-duplicate documents: circulant MinHash, banding, exact verification.

*Signature.* A document is its set of word shingles. One permutation places
the shingles on a ring of 2**20 positions; the second permutation, shifted
around the ring by k, gives coordinate k as the least value over the
document's positions. So two permutations make all coordinates, and the K
values of a shingle lie side by side in one table.

*Candidates.* Documents with equal sets are one class from here on. The
classes' signatures are cut into bands; classes that agree in a whole band (or
two neighbouring ones) share a bucket. With 32 bands of 5 rows, two sets at
0.8 share no bucket with a chance of 3e-6.

*Verification.* Comparisons are exact, on the full sets (as 64-bit hashes).
First every class is compared with the smallest class (the hub) of each of its
buckets it is still apart from, never with all others; the links found join
classes to components.
All that share a bucket with a hub are its family. Two of a family that may
still lack their link cannot both be in the hub's component; so what is left is
to compare the *strays* of a family, which are not in its hub's component, with
its members, where they share a bucket that holds several components. That is done in blocks of bounded size: a task gets one block of
strays and one of members, counts all common shingles by a matrix product and
gives only what joins components. So no link is lost, no list of pairs is made,
and copies in the hub's component cost one comparison, with their nearest hub.

Cases: without words or text the set is empty, linked with nothing; a null id
takes part in no link and is kept with a null component; equal rows are one
class, and of rows with equal ids each is reported by its own text (its
component is that of its text); other columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import WordHasher, components, map_texts, materialise, merged_components, shingles, table, wanted_rows, worker_state

#: Words per shingle and the least similarity, in percent.
SHINGLE_WORDS = 5
MIN_PERCENT = 80
BANDS, ROWS = 32, 5
RING_BITS = 20
_SEED = 77
#: Shingles in a block of strays or members (or one document of more).
BLOCK_SHINGLES = 65_536
#: Shingles counted in one matrix product.
_COLUMNS = 8_192


class Circulant:
    """Signatures from one permutation placing shingles and one circularly shifted."""

    def __init__(self, coordinates: int = BANDS * ROWS, bits: int = RING_BITS):
        ring = np.random.default_rng(_SEED).permutation(1 << bits).astype(np.uint32)
        self.table = np.lib.stride_tricks.sliding_window_view(np.concatenate([ring, ring[:coordinates]]), coordinates)
        self.shift = np.uint64(64 - bits)
        self.coordinates = coordinates

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """The least value over the set's positions, for every shift."""
        at = ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        out = np.full(self.coordinates, np.iinfo(np.uint32).max, np.uint32)
        for k in range(0, len(at), 2048):
            np.minimum(out, self.table[at[k : k + 2048]].min(axis=0), out=out)
        return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, then one per two neighbouring bands."""
    parts = signature.reshape(BANDS, ROWS).astype(np.uint64)
    bands = _fold(np.concatenate([np.arange(BANDS, dtype=np.uint64)[:, None], parts], axis=1))
    pairs = _fold(np.stack([bands[0::2], bands[1::2]], axis=1))
    return np.concatenate([bands, pairs]).view(np.int64)


def _fold(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every row."""
    out = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        out = (out ^ column) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return out


def word_set(text: str, n: int) -> np.ndarray:
    """Sorted hashes of the distinct n-word shingles of a text."""
    return np.unique(shingles(worker_state("word_hasher", WordHasher).words(text), n))


def _set_hash(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_hash, bands) of every row."""

    def make():
        circulant = worker_state("circulant", Circulant)

        def work(texts):
            sizes, hashes, bands = [], [], []
            for t in texts:
                found = word_set(t, n)
                sizes.append(len(found))
                hashes.append(_set_hash(found))
                bands.append(band_keys(circulant.signature(found)) if len(found) else [])
            return sizes, hashes, bands

        return work

    keyed = docs.withColumn("text_hash", F.xxhash64("text"))
    return map_texts(keyed, make, "n_shingles long, set_hash binary, bands array<long>", ["doc_id", "text_hash"])


def shingle_sets(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, set_hash, shingles) with the sorted distinct shingle hashes."""

    def work(texts):
        found = [word_set(t, n) for t in texts]
        return [_set_hash(f) for f in found], [f.view(np.int64) for f in found]

    return map_texts(docs, lambda: work, "set_hash binary, shingles array<long>", ["doc_id"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("n", common)
        .filter(100 * F.col("n") >= percent * (F.size("sa") + F.size("sb") - F.col("n")))
        .select("a", "b")
    )


def _common(strays: list[np.ndarray], members: list[np.ndarray]) -> np.ndarray:
    """How many values each stray shares with each member."""
    out = np.zeros((len(strays), len(members)))
    left, right = np.concatenate(strays), np.concatenate(members)
    shared = np.intersect1d(left, right)
    sides = []
    for values, parts in ((left, strays), (right, members)):
        at = np.minimum(np.searchsorted(shared, values), max(len(shared) - 1, 0))
        hit = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])[hit]
        order = np.argsort(at[hit], kind="stable")
        sides.append((owner[order], at[hit][order]))
    for first in range(0, len(shared), _COLUMNS):
        both = []
        for (owner, at), parts in zip(sides, (strays, members), strict=True):
            lo, hi = np.searchsorted(at, [first, first + _COLUMNS])
            dense = np.zeros((len(parts), _COLUMNS), np.float32)
            dense[owner[lo:hi], at[lo:hi] - first] = 1
            both.append(dense)
        out += both[0] @ both[1].T
    return out


def _stars(found: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of numbers that connect what the matrix ``found`` of links connects, at most one a row and column.

    ``left`` and ``right`` are the numbers of the rows and columns; all that a row
    reaches, over any number of links, is paired with that row's number.
    """
    roots, others = [], []
    rows, columns = found.any(axis=1), found.any(axis=0)  # those not reached yet
    while rows.any():
        root = int(rows.argmax())
        new_rows = np.array([root])
        while len(new_rows):
            rows[new_rows] = False
            new_columns = np.flatnonzero(found[new_rows].any(axis=0) & columns)
            columns[new_columns] = False
            reached = np.flatnonzero(found[:, new_columns].any(axis=1) & rows)
            others += [right[new_columns], left[reached]]
            roots.append(np.full(len(new_columns) + len(reached), left[root]))
            new_rows = reached
    if not roots:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(roots), np.concatenate(others)


def _stray_links(family: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) links of components of strays with components of members of their families.

    ``family``: (hub, rep, stray, c). Blocks are hash slices of about
    BLOCK_SHINGLES shingles; every stray block meets every member block.
    """
    sized = sets.select("rep", F.size("shingles").alias("n"))
    family = family.join(sized, "rep")
    blocks = (
        family.groupBy("hub")
        .agg(
            F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("members"),
            F.ceil(F.sum(F.when(F.col("stray"), F.col("n"))) / BLOCK_SHINGLES).cast("int").alias("strays"),
        )
        .filter("strays > 0")
    )
    rows = family.join(blocks, "hub").withColumn("slice", F.xxhash64("rep"))
    own = F.pmod(F.col("slice"), F.col("members")).cast("int")
    members = rows.select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("strays") - 1)).alias("sb"), own.alias("mb"), "rep", "c", F.lit(False).alias("stray")
    )
    own = F.pmod(F.col("slice"), F.col("strays")).cast("int")
    strays = rows.filter("stray").select(
        "hub", own.alias("sb"), F.explode(F.sequence(F.lit(0), F.col("members") - 1)).alias("mb"), "rep", "c", F.lit(True).alias("stray")
    )
    filled = members.union(strays).join(sets, "rep")

    def links(block: pd.DataFrame) -> pd.DataFrame:
        s, m = block[block["stray"]], block[~block["stray"]]
        out = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        if not len(s) or not len(m):
            return out
        common = _common(list(s["shingles"]), list(m["shingles"]))
        sizes = s["shingles"].map(len).to_numpy()[:, None] + m["shingles"].map(len).to_numpy()[None, :]
        found = (100 * common >= percent * (sizes - common)) & (s["c"].to_numpy()[:, None] != m["c"].to_numpy()[None, :])
        a, b = _stars(found, s["c"].to_numpy(), m["c"].to_numpy())
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return filled.groupBy("hub", "sb", "mb").applyInPandas(links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, n: int = SHINGLE_WORDS, percent: int = MIN_PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    ``text_hash`` is xxhash64 of the text: rows of one id may have several texts.
    """
    docs = docs.select("doc_id", "text")
    seen = materialise(sketches(docs, n), "sketches")
    # A class is a set, whoever has it: it has a number, and the smallest id with the set is its owner.
    classes = materialise(
        seen.filter("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("set_hash")
        .agg(F.min("doc_id").alias("owner"), F.min_by("bands", "doc_id").alias("bands"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "classes",
    )
    buckets = classes.select("rep", F.explode("bands").alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).filter("hub < top")
    members = materialise(
        buckets.join(hubs.select("bucket", "hub"), "bucket").filter("rep <> hub").select("bucket", "hub", "rep"), "members"
    )
    pairs = materialise(members.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    involved = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    involved = materialise(classes.join(involved, "rep", "left_semi").select("rep", "set_hash", F.col("owner").alias("doc_id")), "involved")
    texts = wanted_rows(docs, materialise(involved.select("doc_id").distinct(), "owners"))
    sets = shingle_sets(texts, n).join(involved, ["doc_id", "set_hash"])
    # Rows of one id and set are alike; the grouping has the keys of the join, so sets are dealt out once.
    sets = sets.groupBy("doc_id", "set_hash").agg(F.first("rep").alias("rep"), F.first("shingles").alias("shingles"))
    sets = materialise(sets.select("rep", "shingles"), "sets")
    # Every class is compared with one of its hubs first, then with those that it is still apart from:
    # the links of a large group stay as many as its classes, however its buckets cut it.
    nearest = materialise(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "nearest")
    seats = components(materialise(_verified(nearest, sets, percent), "links"))
    of_a, of_b = (seats.select(F.col("node").alias(x), F.col("component_id").alias(f"c{x}")) for x in "ab")
    rest = pairs.join(nearest, ["a", "b"], "left_anti").join(of_a, "a", "left").join(of_b, "b", "left")
    rest = materialise(rest.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"), "rest")
    seats = materialise(merged_components(seats, materialise(_verified(rest, sets, percent), "links")), "seats")

    label = seats.withColumnRenamed("component_id", "c")
    of_hub = label.select(F.col("node").alias("hub"), F.col("c").alias("ch"))
    of_rep = label.select(F.col("node").alias("rep"), F.col("c").alias("cr"))
    seated = members.join(of_rep, "rep", "left").select("bucket", "hub", "rep", F.coalesce("cr", "rep").alias("c"))
    seated = materialise(seated, "seated")
    # Only buckets whose members, hub aside, are still apart may hide a link.
    apart = seated.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("bucket")
    family = (
        seated.join(apart, "bucket", "left_semi")
        .select("hub", "rep", "c")
        .distinct()
        .join(of_hub, "hub", "left")
        .select("hub", "rep", "c", (F.col("c") != F.coalesce("ch", "hub")).alias("stray"))
    )
    more = materialise(_stray_links(materialise(family, "family"), sets, percent), "links")
    joined = merged_components(seats, more)
    owned = classes.select("set_hash", "rep", "owner").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    smallest = owned.filter("component_id IS NOT NULL").groupBy("component_id").agg(F.min("owner").alias("smallest"))
    label = owned.join(smallest, "component_id", "left").select("set_hash", F.coalesce("smallest", "owner").alias("component_id"))
    with_set = F.when(F.expr("doc_id IS NOT NULL AND n_shingles > 0"), F.col("set_hash"))
    return (
        seen.select("doc_id", "text_hash", "n_shingles", with_set.alias("set_hash"))
        .join(label, "set_hash", "left")
        .select("doc_id", "text_hash", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def op3_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), n=2).drop("text_hash")
