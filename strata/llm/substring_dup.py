"""Near-duplicate passages across documents by compact windows.

*Windows.* A text is its sequence of 5-word shingles. Under one hash function
all subsequences with the same least shingle form *compact windows*: the
Cartesian tree over the hashes gives, for every place that is the least of
some range, the widest range around it. Ranges shorter than a passage are
cut off, so a text of n words has about ``2 n / MIN_WORDS`` windows a function.
Any passage repeated elsewhere lies in a window of the same key in both texts,
under every function; one changed to similarity s under a share s of them.

*Interval join.* Windows meet by key. Each is paired with the first window of
its key (the smallest document), never with all others, when the ranges that
both reach around the least shingle can hold a passage; the windows of one
document pair are folded to the functions that agree.

*Verification.* A pair whose first text's marks (a bit for every shingle) show
that no passage can be shared is left out; both texts of the others are compared: ranges whose shingles occur
in the other text, changes allowed, and whose shingle sets have a Jaccard
similarity of at least 0.8 with a matching range, at any place, are passages;
so are all runs of 50 words that both texts have. The first
window of a key may share no more than a common phrase with the others. So
windows whose place lies in no passage found so far meet twice again, by key
and the words some way to the right, then to the left: one of these lies in
the passage too, and phrases fall apart.

*Exact rest.* Runs of 50 words whose least shingle is a shared key under every
function, and which lie in no passage found of their document, meet by the hash
of the whole run, with all others of that run. So every exact repeat of 50 words
is found, whatever the windows met. A changed passage is found when one of its
windows meets its partner in the rounds before.

Result: one row per passage occurrence: doc_id, first and stop (words, end
exclusive), class_id (the document it was found in first), hits (functions that
agree), kept (whether it is the first place). Documents without a repeated
passage have no row.

Cases: null ids, null or empty texts and texts of fewer words than a passage
have no row; rows with equal ids are one document, with the text of the first
of them by order of text; a passage repeated only inside one document is none;
other columns do not matter.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, WordHasher, _mix, likely_rows, map_texts, materialise, shingles, sliding, table, wanted_rows, worker_state

SHINGLE_WORDS = 5
#: Words of the shortest passage, and the least similarity.
MIN_WORDS = 50
MIN_SIMILARITY = 0.8
#: Hash functions; a pair is compared when one of them agrees, as functions may
#: meet different first documents.
FUNCTIONS = 4
_SEEDS = np.random.default_rng(5).integers(1, 2**63, FUNCTIONS, dtype=np.uint64)
#: Base of the hash of a run of shingles.
_BASE = 0x5851F42D4C957F2D
#: At similarity s, two ranges of one length share 2 s / (1 + s) of their shingles.
_SHARE = 2 * MIN_SIMILARITY / (1 + MIN_SIMILARITY)
#: Shingles that a window's reach is told for, on either side.
_REACH = 65_535
#: How far from a window's place its right and left context lie. Places of a
#: passage have one of the two inside it.
CONTEXT = 12
#: Shingles whose windows are found at once, about.
LINE = 32_768
#: Shingles of first documents that a task of the comparison keeps, about.
KNOWN = 4_000_000
#: Ranges around the same least shingle may differ by changes to the passage.
_SLACK = 0.75


def compact_windows(hashes: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(place, first, last) of the widest ranges, at least ``width`` long, around their least hash.

    Equal least hashes of a range give one window; the ranges between them go on.
    """
    ranks = np.unique(hashes, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
    return list(zip(*(x.tolist() for x in _windows_between(ranks, width)), strict=True))


def _windows_between(hashes: np.ndarray, width: int, edges: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, firsts and lasts of the compact windows of texts laid end to end, with a place between two of them (``edges``).

    A place has a window if it is the least of some ``width`` neighbours. What ends
    its range on either side is smaller and the least of as many, so that only
    these places are compared. The first of equal places of a range has its
    window. A hash of 0 counts as 1, which has the same key.
    """
    order = np.maximum(hashes, 1)
    if edges is not None:
        order[edges] = 0
    low = sliding(order, width)
    if not len(low):
        return (np.zeros(0, np.int64),) * 3
    beside = np.zeros(width - 1, low.dtype)
    least = np.flatnonzero((sliding(np.concatenate((beside, low, beside)), width, np.maximum) == order) | (order == 0))
    # An edge before and after all.
    value = np.concatenate(([0], order[least], [0])).astype(order.dtype)
    place = np.concatenate(([-1], least, [len(hashes)]))
    all_places = np.flatnonzero(value)
    before = _first_below(value, all_places, -1, np.greater)
    own = all_places[value[before[all_places]] < value[all_places]]
    after = _first_below(value, all_places, 1, np.greater_equal)
    return place[own], place[before[own]] + 1, place[after[own]] - 1


def _first_below(value: np.ndarray, asked: np.ndarray, step: int, passes: np.ufunc) -> np.ndarray:
    """For the ``asked`` places the next one, in the direction of ``step``, that their value does not pass.

    What a passed place passes is passed as well, so all skip at once what those they have reached have skipped.
    """
    to = np.arange(len(value)) + step
    while len(asked):
        asked = asked[passes(value[to[asked]], value[asked])]
        to[asked] = to[to[asked]]
    return to


def text_shingles(texts: list[str]) -> list[np.ndarray]:
    """The shingles of every text; none with fewer words."""
    out = []
    for words, counts in worker_state("word_hasher", WordHasher).groups(texts):
        line = shingles(words, SHINGLE_WORDS)
        stops = np.cumsum(counts)
        # Those that reach into the next text are left out.
        out += [line[a : max(a, b - SHINGLE_WORDS + 1)] if b - a >= SHINGLE_WORDS else line[:0] for a, b in zip((stops - counts).tolist(), stops.tolist(), strict=True)]
    return out


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, key, place, reach) of all compact windows of every text under every function.

    ``reach`` packs four 16-bit numbers: hashes of the left and the right
    context (0: outside the text), and the shingles to the left and the right.
    """
    need = MIN_WORDS - SHINGLE_WORDS + 1

    def make():
        def work(texts):
            found = text_shingles(texts)
            wide = np.array([i for i, x in enumerate(found) if len(x) >= need], np.int64)
            sizes = np.array([len(found[i]) for i in wide], np.int64)
            groups = np.split(wide, np.flatnonzero(np.diff(np.cumsum(sizes) // LINE)) + 1)
            parts = [together(found, some) for some in groups if len(some)]
            return tuple(map(np.concatenate, zip(*parts, strict=True))) if parts else (np.zeros(0, np.int64),) * 4

        def together(found, wide):
            edge = np.zeros(CONTEXT, np.uint64)
            # The texts' shingles end to end, with a context's length of places between.
            line = np.concatenate([part for i in wide for part in (found[i], edge)])
            sizes = np.array([len(found[i]) + CONTEXT for i in wide])
            stops = np.cumsum(sizes)
            edges = (stops[:, None] - np.arange(1, CONTEXT + 1)).ravel()
            context = (line >> np.uint64(49)).astype(np.int64) | 1
            context[edges] = 0
            context = np.concatenate([edge.astype(np.int64), context])
            rows, keys, places, reaches = [], [], [], []
            for k in range(FUNCTIONS):
                hashes = _mix(line ^ _SEEDS[k])
                at, first, last = _windows_between(hashes, need, edges)
                text = np.searchsorted(stops, at, "right")
                rows.append(wide[text])
                # The function's number takes the place of the last bits.
                keys.append(((hashes[at] & ~np.uint64(7)) | np.uint64(k)).view(np.int64))
                places.append(at - (stops - sizes)[text])
                left, right = np.minimum(at - first, _REACH), np.minimum(last - at, _REACH)
                reaches.append(context[at] << 48 | context[at + 2 * CONTEXT] << 32 | left << 16 | right)
            return tuple(map(np.concatenate, (rows, keys, places, reaches)))

        return work

    return map_texts(docs.filter("doc_id IS NOT NULL"), make, "key long, place int, reach long", ["doc_id"], many=True)


def _reach(name: str, bits: int) -> Column:
    return F.shiftright(F.col(name), bits).bitwiseAND(F.lit(0xFFFF))


def _shared(found: DataFrame) -> DataFrame:
    """The windows whose key more than one document has.

    One exchange by key, in one scan of the texts: the rows themselves carry the
    least and the greatest document of their key. A document has few windows of a
    key among its many, so a passage of a third of all documents is still a small
    part of all windows.
    """
    own = Window.partitionBy("key")
    ends = found.withColumn("lo", F.min("doc_id").over(own)).withColumn("hi", F.max("doc_id").over(own))
    return ends.filter("lo < hi").drop("lo", "hi")


def _candidates(found: DataFrame, by: list[str]) -> DataFrame:
    """(a, b, function) of windows and the first window of their group, if both can hold a passage."""
    first = (
        found.groupBy(*by)
        .agg(F.min(F.struct("doc_id", "reach")).alias("w"), F.max("doc_id").alias("top"))
        .filter("w.doc_id < top")
        .select(*by, F.col("w.doc_id").alias("a"), F.col("w.reach").alias("other"))
    )
    common = F.least(_reach("reach", 16), _reach("other", 16)) + F.least(_reach("reach", 0), _reach("other", 0)) + 1
    return (
        found.join(first, by)
        .filter((F.col("a") != F.col("doc_id")) & (common >= _SLACK * (MIN_WORDS - SHINGLE_WORDS + 1)))
        .select("a", F.col("doc_id").alias("b"), F.col("key").bitwiseAND(F.lit(7)).alias("function"))
    )


def segments(mask: np.ndarray, need: int) -> list[tuple[int, int]]:
    """Ranges [first, stop) of at least ``need`` places with enough true ones.

    The range of all true places is split at its widest gap, and the parts
    again, until a part has its share.
    """
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    true = np.concatenate(([0], np.cumsum(end - begin)))
    out, todo = [], [(0, len(begin))] if len(begin) else []
    while todo:
        lo, hi = todo.pop()
        first, stop = int(begin[lo]), int(end[hi - 1])
        if stop - first < need:
            continue
        if true[hi] - true[lo] >= _SHARE * (stop - first):
            out.append((first, stop))
            continue
        cut = lo + 1 + int(np.argmax(begin[lo + 1 : hi] - end[lo : hi - 1]))
        todo += [(lo, cut), (cut, hi)]
    return sorted(out)


def _among(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Whether each number of x (below ``n``) is in y."""
    table = np.zeros(n, bool)
    table[y] = True
    return table[x]


def _similarity(a: np.ndarray, b: np.ndarray, n: int) -> float:
    left, right = np.zeros(n, bool), np.zeros(n, bool)
    left[a] = True
    right[b] = True
    common = np.count_nonzero(left & right)
    return common / np.count_nonzero(left | right) if common else 0.0


def _runs(found: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` shingles (a prefix sum over powers of an odd base)."""
    if len(found) < width:
        return found[:0]
    powers, inverses = worker_state("run_powers", lambda: [np.ones(1, np.uint64)] * 2)
    if len(powers) < len(found):
        powers, inverses = (WordHasher._grow(x, 2 * len(found)) for x in (_BASE, pow(_BASE, -1, 2**64)))
        worker_state("run_powers", list)[:] = powers, inverses
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(found) * powers[: len(found)], dtype=np.uint64)))
    return _mix((sums[width:] - sums[:-width]) * inverses[: len(found) - width + 1])


def _exact(a: np.ndarray, b: np.ndarray, need: int) -> list[tuple[int, int, int, int]]:
    """Ranges that together cover every run of ``need`` shingles of b that a has anywhere."""
    left, right = _runs(a, need), _runs(b, need)
    if not len(left) or not len(right):
        return []
    order = np.argsort(left, kind="stable")
    at = np.minimum(np.searchsorted(left[order], right), len(left) - 1)
    place = order[at]
    hits = np.flatnonzero(left[place] == right)
    out, k = [], 0
    while k < len(hits):
        i, p = int(hits[k]), int(place[hits[k]])
        n = min(len(left) - p, len(right) - i)
        other = np.flatnonzero(left[p : p + n] != right[i : i + n])
        n = int(other[0]) if len(other) else n
        out.append((p, p + n - 1 + need, i, i + n - 1 + need))
        k = int(np.searchsorted(hits, i + n))
    return out


def passages(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(first, stop) in a and (first, stop) in b, in words, of near-duplicate passages.

    The ranges of b that a's shingles fill, and for each all ranges of a that its
    shingles fill, narrow each other until they are similar enough; what cannot
    be narrowed is split at its widest gap. Exact repeats that lie in no such
    range of b are added, so each of them is covered.
    """
    need = MIN_WORDS - SHINGLE_WORDS + 1
    whole = (0, len(a), 0, len(b))
    known, code = np.unique(np.concatenate((a, b)), return_inverse=True)
    n, ca, cb = len(known), code[: len(a)], code[len(a) :]
    shared = _among(cb, ca, n)
    out, todo, seen = [], [whole], {whole}
    while todo:
        fa, sa, fb, sb = now = todo.pop()
        for f, s in segments(shared if now == whole else _among(cb[fb:sb], ca[fa:sa], n), need):
            for g, t in segments(_among(ca[fa:sa], cb[fb + f : fb + s], n), need):
                found = (fa + g, fa + t, fb + f, fb + s)
                if _similarity(ca[found[0] : found[1]], cb[found[2] : found[3]], n) >= MIN_SIMILARITY:
                    out.append(found)
                    continue
                for part in _halves(ca, cb, found, n) if found == now else [found]:
                    if part not in seen:
                        seen.add(part)
                        todo.append(part)
    if sliding(shared, need, np.logical_and).any():  # else no run of b is in a
        out += [x for x in _exact(a, b, need) if not any(f <= x[2] and x[3] <= s for _, _, f, s in out)]
    return sorted({(fa, sa + SHINGLE_WORDS - 1, fb, sb + SHINGLE_WORDS - 1) for fa, sa, fb, sb in out})


def _halves(a: np.ndarray, b: np.ndarray, found: tuple[int, int, int, int], n: int) -> list[tuple[int, int, int, int]]:
    """The two parts beside the widest gap of either range; ranges without gaps have equal sets."""
    fa, sa, fb, sb = found
    gaps = []
    for side, mask in ((0, _among(a[fa:sa], b[fb:sb], n)), (1, _among(b[fb:sb], a[fa:sa], n))):
        true = np.flatnonzero(mask)
        if len(true) > 1:
            k = int(np.argmax(np.diff(true)))
            gaps.append((int(true[k + 1] - true[k]), side, int(true[k]) + 1, int(true[k + 1])))
    width, side, stop, first = max(gaps, default=(1, 0, 0, 0))
    if width == 1:
        return []
    if side:
        return [(fa, sa, fb, fb + stop), (fa, sa, fb + first, sb)]
    return [(fa, fa + stop, fb, sb), (fa + first, sa, fb, sb)]


#: Bits a shingle in a document's marks. A passage has 8 of 9 shingles in the other text, so of its disjoint
#: runs of 46 shingles one lacks at most 10: fewer than 46 * 2 / 9.
_MARK_BITS = 4
_NEED = MIN_WORDS - SHINGLE_WORDS + 1
_FEWEST = _NEED - 10


def _marks(found: np.ndarray) -> bytes:
    """A bit for every shingle, at a place its hash names."""
    bits = np.zeros(-(-_MARK_BITS * len(found) // 64) * 64, np.uint8)
    if len(bits):
        bits[(found >> np.uint64(20)) % np.uint64(len(bits))] = 1
    return np.packbits(bits).tobytes()


def _may_share(marks: bytes, found: np.ndarray) -> bool:
    """False only if no range of ``found`` can be a passage of the text that has these marks."""
    if not marks or len(found) < _NEED:
        return False
    bits = np.unpackbits(np.frombuffer(marks, np.uint8))
    hits = np.concatenate(([0], np.cumsum(bits[(found >> np.uint64(20)) % np.uint64(len(bits))], dtype=np.int64)))
    return int((hits[_NEED:] - hits[:-_NEED]).max()) >= _FEWEST


def marked(texts: DataFrame) -> DataFrame:
    """(doc_id, marks) of every text: half a byte a shingle."""
    return map_texts(texts, lambda: lambda part: [[_marks(found) for found in text_shingles(part)]], "marks binary", ["doc_id"])


def _texts_of(pairs: DataFrame, end: str, texts: DataFrame) -> DataFrame:
    """(a or b, text) of the documents at that end of the pairs, and of a few others: the rest need not travel."""
    return likely_rows(texts, pairs.select(F.col(end).alias("doc_id"))).select(F.col("doc_id").alias(end), "text")


def likely(pairs: DataFrame, texts: DataFrame, marks: DataFrame) -> DataFrame:
    """The (a, b, hits) pairs that may share a passage, by the marks of a and the text of b.

    Marks leave out no pair that :func:`passages` finds something in, so only
    the others' texts need not travel to each other.
    """
    joined = (
        pairs.join(marks.select(F.col("doc_id").alias("a"), "marks"), "a")
        .join(_texts_of(pairs, "b", texts), "b")
        .select("a", "b", "hits", "marks", "text")
    )

    import pyarrow as pa

    def run(batches):
        last, found = None, None  # pairs come by b
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids, marks, texts = (part.column(i).to_pylist() for i in (1, 3, 4))
                new = [i for i, b in enumerate(ids) if b != (ids[i - 1] if i else last)]
                fresh = dict(zip(new, text_shingles([texts[i] or "" for i in new]), strict=True))
                keep = []
                for i in range(len(ids)):
                    found = fresh.get(i, found)
                    keep.append(_may_share(marks[i], found))
                last = ids[-1]
                yield part.select(["a", "b", "hits"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long, hits long")


_PASSAGE = "fa int, sa int, fb int, sb int"


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, hits, fa, sa, fb, sb) of the passages of all (a, b, hits) pairs."""
    joined = (
        pairs.join(_texts_of(pairs, "a", texts).withColumnRenamed("text", "ta"), "a")
        .join(_texts_of(pairs, "b", texts), "b")
        .select("a", "b", "hits", "ta", "text")
    )

    import pyarrow as pa

    names = ["a", "b", "hits", "fa", "sa", "fb", "sb"]

    def run(batches):
        known: dict[int, np.ndarray] = {}  # shingles of the first documents met last
        last, own, held = None, None, 0  # pairs come by b
        for batch in batches:
            cols = [batch.column(i) for i in range(5)]
            for start in range(0, batch.num_rows, 256):
                a, b, hits, ta, tb = (c.slice(start, 256).to_pylist() for c in cols)
                if held > KNOWN:
                    known.clear()
                    held = 0
                firsts = {x: i for i, x in enumerate(a) if x not in known}
                new = [i for i, x in enumerate(b) if x != (b[i - 1] if i else last)]
                both = text_shingles([ta[i] or "" for i in firsts.values()] + [tb[i] or "" for i in new])
                for x, found in zip(firsts, both):  # noqa: B905
                    known[x] = found.copy()
                    held += len(found)
                fresh = dict(zip(new, both[len(firsts) :], strict=True))
                last = b[-1]
                out = [[] for _ in names]
                for i in range(len(a)):
                    own = fresh.get(i, own)
                    for found in passages(known[a[i]], own):
                        for column, value in zip(out, (a[i], b[i], hits[i], *found), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, [pa.int64()] * 3 + [pa.int32()] * 4, strict=True)], names=names
                )

    return joined.mapInArrow(run, f"a long, b long, hits long, {_PASSAGE}")


def _rows(found: DataFrame) -> DataFrame:
    """One row per passage occurrence from (a, b, hits, fa, sa, fb, sb), in one pass over them."""

    def place(doc: str, first: str, stop: str) -> Column:
        return F.struct(F.col(doc).alias("doc_id"), F.col(first).alias("first"), F.col(stop).alias("stop"), "a", "hits")

    return found.select(F.inline(F.array(place("b", "fb", "sb"), place("a", "fa", "sa"))))


def _uncovered(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Windows whose place lies in no passage of their document."""
    spans = rows.groupBy("doc_id", "first").agg(F.max("stop").alias("stop")).select(F.col("doc_id").alias("d"), "first", "stop")
    inside = (F.col("doc_id") == F.col("d")) & (F.col("place") >= F.col("first")) & (F.col("place") < F.col("stop"))
    return found.join(spans, inside, "left_anti")


def _open_runs(texts: DataFrame, shared: DataFrame, rows: DataFrame, covered: bool) -> DataFrame:
    """(doc_id, run) of the runs of 50 words that may be repeated: all least shingles are shared keys.

    ``covered``: those that lie in a passage found, else those that do not.
    """
    keys = shared.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))  # of one text
    spans = rows.groupBy("doc_id").agg(F.collect_set(F.struct("first", "stop")).alias("spans"))
    if covered:
        texts = likely_rows(texts, rows.select("doc_id").distinct())
    joined = texts.join(keys, "doc_id").join(spans, "doc_id", "inner" if covered else "left").select("doc_id", "text", "keys", "spans")
    need = MIN_WORDS - SHINGLE_WORDS + 1

    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = text_shingles([t or "" for t in part.column(1).to_pylist()])
                # A least shingle that is a shared key of another document is one of its own document too.
                keys = part.column(2).flatten().to_numpy(zero_copy_only=False)
                sizes = np.array([max(0, len(x) - need + 1) for x in found])
                stops = np.cumsum([len(x) for x in found])
                # The places of the line of all shingles where a run begins.
                begins = np.repeat(stops - [len(x) for x in found] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                line = np.concatenate(found)
                wanted = np.ones(len(begins), bool)
                for k in range(FUNCTIONS if len(begins) else 0):
                    least = sliding(_mix(line ^ _SEEDS[k]), need)[begins]
                    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))  # neighbours mostly have the same one
                    known = np.isin(((least[first] & ~np.uint64(7)) | np.uint64(k)).view(np.int64), keys)
                    wanted &= np.repeat(known, np.diff(first, append=len(least)))
                own = []
                edges = np.cumsum(sizes)
                for i, spans in enumerate(part.column(3).to_pylist()):
                    mine = wanted[edges[i] - sizes[i] : edges[i]]
                    inside = np.zeros(len(mine), bool)
                    for span in spans or ():
                        inside[span["first"] : max(span["first"], span["stop"] - MIN_WORDS + 1)] = True
                    mine = mine & (inside if covered else ~inside)
                    own.append(np.unique(_runs(found[i], need)[mine]).view(np.int64) if mine.any() else np.zeros(0, np.int64))
                index = np.repeat(np.arange(len(own)), [len(x) for x in own])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(index, pa.int64())), pa.array(np.concatenate(own), pa.int64())], names=["doc_id", "run"]
                )

    return joined.mapInArrow(run, "doc_id long, run long")


def _exact_pairs(texts: DataFrame, shared: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b, hits) of documents with an equal run of 50 words that lies in no passage of one of them yet.

    All documents of a run have all of it, so comparing them with the first one is enough.
    """
    alone = materialise(_open_runs(texts, shared, rows, False), "runs")
    several = wanted_rows(_open_runs(texts, shared, rows, True), materialise(alone.select("run").distinct(), "open"), "run")
    runs = materialise(alone.withColumn("alone", F.lit(True)).union(several.select("doc_id", "run", F.lit(False))), "runs")
    first = (
        runs.groupBy("run")
        .agg(F.min(F.struct("doc_id", "alone")).alias("w"), F.max("doc_id").alias("top"))
        .filter("w.doc_id < top")
        .select("run", F.col("w.doc_id").alias("a"), F.col("w.alone").alias("first_alone"))
    )
    return (
        runs.join(first, "run")
        .filter("a <> doc_id AND (alone OR first_alone)")
        .select("a", F.col("doc_id").alias("b"))
        .distinct()
        .withColumn("hits", F.lit(FUNCTIONS).cast("long"))
    )


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, first, stop, class_id, hits, kept) of the repeated passages of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    shared = materialise(_shared(windows(docs)), "windows")
    involved = shared.select("doc_id").distinct()
    texts = materialise(
        wanted_rows(docs, materialise(involved, "involved")).groupBy("doc_id").agg(F.min("text").alias("text")), "texts"
    )
    marks = materialise(marked(texts), "marks")
    rows, left, tested = None, shared, None
    for context in (None, "right", "left", "exact"):
        groups = ["key"]
        if context in ("right", "left"):
            left = _uncovered(left, rows).withColumn("context", _reach("reach", 32 if context == "right" else 48))
            left, groups = left.filter("context <> 0"), ["key", "context"]
        if context == "exact":
            pairs = _exact_pairs(texts, shared, rows)
        else:
            pairs = _candidates(left, groups).groupBy("a", "b").agg(F.size(F.collect_set("function")).cast("long").alias("hits"))
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        new = materialise(_rows(verified(materialise(likely(pairs, texts, marks), "likely"), texts)), "passages")
        rows = new if rows is None else rows.union(new)
        tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))
    return (
        rows.groupBy("doc_id", "first", "stop", F.col("a").alias("class_id"))
        .agg(F.max("hits").alias("hits"))
        .withColumn("kept", F.col("doc_id") == F.col("class_id"))
    )


_WORDS = re.compile(WORD)


def without_passages(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the passages that an earlier document has; all rows and columns stay."""
    cut = found.filter("NOT kept").groupBy("doc_id").agg(F.collect_list(F.struct("first", "stop")).alias("_cut"))  # of one text

    @F.pandas_udf("string")
    def trimmed(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for text, spans in zip(texts, cuts):  # noqa: B905
            if text is None or spans is None or not len(spans):
                out.append(text)
                continue
            keep = np.ones(len(text), bool)
            words = [m.span() for m in _WORDS.finditer(text)]
            for s in spans:
                if s["first"] < len(words):
                    last = min(s["stop"], len(words))
                    keep[words[s["first"]][0] : words[last][0] if last < len(words) else len(text)] = False
            edge = np.flatnonzero(np.diff(np.concatenate(([False], keep, [False])).astype(np.int8)))
            out.append("".join(text[a:b] for a, b in zip(edge[::2], edge[1::2])))  # noqa: B905
        return pd.Series(out, dtype=object)

    return docs.join(cut, "doc_id", "left").withColumn("text", trimmed("text", "_cut")).select(*docs.columns)


def op9_substring_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
