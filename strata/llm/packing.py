"""Packing documents into fixed windows by non-negative least squares.

1. One pass over the texts gives every document's token ids; the ids are cut
   into full windows and a remainder, and each piece keeps its place, length
   and checksum. Nothing but these small rows goes on.
2. The histogram of remainder lengths (fewer than ``window`` numbers, whatever
   the corpus) comes to the driver. Shallow combinations of lengths that fill a
   window exactly are enumerated, and non-negative least squares gives how
   often to repeat each so that together they use the histogram up.
3. Repeat counts are rounded down to what the histogram has, and the residual
   is packed greedily (largest first, then the largest that still fits),
   again as combinations with repeat counts.
4. Pieces of equal length are numbered (within hash slices, so that no length
   is numbered in one task), and a piece's number says which repetition of
   which combination it belongs to.

Cases: a null or empty text is one piece (its end id only); ties are broken by
document and place; repeated rows are packed as often as they come; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import map_texts, materialise, table, worker_state
from strata.llm.pretokens import NOT_PLAIN, WORD_LEVEL, load_tokenizer

WINDOW = 2048
END_ID = 1
#: Slices per shuffle partition in which pieces of one length are numbered.
SLICES = 64
#: Combinations offered to the least squares, at most (they are enumerated by
#: falling abundance of their lengths; the rest is packed greedily).
COMBINATIONS = 6_000

PIECE_FIELDS = "start long, length long, ids_crc32 long, doc_tokens long"


#: Words in each of the two generations that a worker remembers, of at most so many characters.
CACHE_WORDS = 150_000
CACHE_CHARS = 64
#: Separators that Python's ``split`` knows and the tokenizer does not.
_CONTROL = "\x1c\x1d\x1e\x1f"
_ASCII_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def _byte_level() -> dict[int, str]:
    """The published character of every byte (printable ones stand for themselves)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Token ids (little-endian) of words, which no token of a word-level BPE reaches beyond.

    White space separates pre-tokens and special strings hold none, so a text's
    ids are those of its words. A plain word is cut into lower-case pre-tokens here,
    and the tokenizer's model gives their ids; others go through the tokenizer whole.
    Two generations of words and pre-tokens are remembered.
    """

    _BYTE_LEVEL = _byte_level()

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.new, self.old, self.long = tokenizer, tokenizer.model, {}, {}, []
        self.raw = [i.to_bytes(4, "little") for i in range(max(tokenizer.get_vocab().values()) + 1)]

    def results(self, texts: list[str]) -> list[bytes]:
        words = [_ASCII_SPACE.split(t) if any(c in t for c in _CONTROL) else t.split() for t in texts]
        if len(self.new) > CACHE_WORDS:
            self.old, self.new = self.new, {}
        self._learn(set().union(*words))
        out = [b"".join(map(self.new.__getitem__, w)) for w in words]
        for w in self.long:
            self.new.pop(w, None)
        self.long = []
        return out

    def _learn(self, words: set[str]) -> None:
        """Makes ``new`` hold the words: from ``old``, from their pre-tokens, or encoded."""
        new, old, rest = self.new, self.old, []
        missing = words - new.keys()
        again = missing & old.keys()
        new.update(zip(again, map(old.__getitem__, again), strict=True))
        missing -= again
        for w in missing:
            low, ascii_only = w.lower(), w.isascii()
            if ascii_only and w.isalpha():  # one pre-token
                ids = new.get(low)
                new[w] = self._remembered(low) if ids is None else ids
            elif NOT_PLAIN.search(w) or "<|" in w or not ascii_only and NOT_PLAIN.search(low):  # only the tokenizer knows
                rest.append(w)
            else:
                parts = WORD_LEVEL.findall(low)
                new[w] = b"".join([new[p] if p in new else self._remembered(p) for p in parts])
        for w, each in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            new[w] = np.array(each.ids, "<u4").tobytes()
        self.long += [w for w in missing if len(w) > CACHE_CHARS]

    def _remembered(self, pretoken: str) -> bytes:
        """Ids of a lower-case pre-token that ``new`` does not hold (as a word it is itself)."""
        ids = self.old.get(pretoken)
        if ids is None:
            seen = pretoken if pretoken.isascii() else pretoken.encode().decode("latin-1").translate(self._BYTE_LEVEL)
            raw = self.raw
            ids = b"".join([raw[t.id] for t in self.model.tokenize(seen)])
        if len(pretoken) > CACHE_CHARS:
            self.long.append(pretoken)
        self.new[pretoken] = ids
        return ids


def cut_pieces(docs: DataFrame, path: str, keep: list[str], window: int = WINDOW, text: str = "text") -> DataFrame:
    """One row per piece: full windows from the start, then the remainder."""

    def make():
        words = worker_state(f"words:{path}", lambda: WordIds(load_tokenizer(path)))
        end = np.array([END_ID], "<u4").tobytes()

        def cut(texts):
            row, start, length, crc, total = [], [], [], [], []
            for i, raw in enumerate(words.results(texts)):
                raw += end
                n = len(raw) // 4
                for at in range(0, n, window):
                    piece = raw[4 * at : 4 * (at + window)]
                    row.append(i)
                    start.append(at)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
            return row, start, length, crc, total

        return cut

    return map_texts(docs, make, PIECE_FIELDS, keep, text, many=True)


# ------------------------------------------------------------ the plan


def combinations(counts: np.ndarray, window: int, limit: int = COMBINATIONS) -> list[tuple[int, ...]]:
    """Falling tuples of 1 to 4 present lengths whose sum is ``window``.

    Pairs are all enumerated; triples and quadruples take their first lengths
    in order of abundance until ``limit`` combinations are found.
    """
    present = np.flatnonzero(counts)
    has = counts > 0
    out = {(int(window),)} if window < len(has) and has[window] else set()
    out |= {tuple(sorted((int(a), int(window - a)), reverse=True)) for a in present if 0 < window - a < len(has) and has[window - a]}
    order = present[np.argsort(-counts[present], kind="stable")]
    for depth in (3, 4):
        for a in order:
            if len(out) >= (limit // 2 if depth == 3 else limit):
                break
            seconds = present if depth == 3 else order[:16]
            for b in seconds:
                left = window - a - b
                if left <= 0:
                    continue
                if depth == 3:
                    if left < len(has) and has[left]:
                        out.add(tuple(sorted((int(a), int(b), int(left)), reverse=True)))
                    continue
                c = present[present < left]
                c = c[has[left - c]][:8]
                out |= {tuple(sorted((int(a), int(b), int(x), int(left - x)), reverse=True)) for x in c}
    return sorted(out)[:limit] if len(out) > limit else sorted(out)


def repeat_counts(combos: list[tuple[int, ...]], counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares ``min |A x - counts|`` by accelerated projected gradient."""
    row = np.concatenate([np.array(c) for c in combos])
    col = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    target = counts.astype(float)

    def times(x):
        return np.bincount(row, x[col], len(target))

    def back(r):
        return np.bincount(col, r[row], len(combos))

    v = np.ones(len(combos))  # largest eigenvalue of A'A by the power method
    for _ in range(20):
        v = back(times(v))
        size = np.linalg.norm(v)
        v /= size
    step = 1 / (1.05 * size)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(times(y) - target))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(counts: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """(combination of lengths, repetitions) that use every piece of the histogram once."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def take(combo: tuple[int, ...], n: int) -> None:
        if n > 0:
            np.subtract.at(left, np.array(combo), n)
            out.append((combo, int(n)))

    def most(combo) -> int:
        lengths, uses = np.unique(np.array(combo), return_counts=True)
        return int((left[lengths] // uses).min())

    combos = combinations(left, window)
    if combos:
        x = repeat_counts(combos, left)
        for k in np.argsort(-x, kind="stable"):
            take(combos[k], min(int(x[k]), most(combos[k])))
        for combo in combos:  # what rounding left over
            take(combo, most(combo))
    while left.any():
        combo, room = [], window
        free = left.copy()
        while room > 0:
            fits = np.flatnonzero(free[: room + 1])
            if not len(fits):
                break
            size = int(fits[-1])
            n = min(room // size, int(free[size]))
            if combo:
                n = 1  # fill up with ever smaller ones
            combo += [size] * n
            free[size] -= n
            room -= size * n
        take(tuple(combo), most(combo))
    return out


def slots(planned: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """For each length the ranges of piece numbers and where they go.

    The pieces ``first .. first + n - 1`` of a length lie in the sequences
    ``sequence ..`` at ``offset``, one in each.
    """
    used: dict[int, int] = {}
    rows = []
    sequence = 0
    for combo, n in planned:
        offset = 0
        for size in combo:
            first = used.get(size, 0)
            rows.append((size, first, n, sequence, offset))
            used[size] = first + n
            offset += size
        sequence += n
    return pd.DataFrame(rows, columns=["length", "first", "n", "sequence", "offset"]).sort_values(["length", "first"])


# ------------------------------------------------------------ assignment


def numbered(pieces: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Adds ``number``: 0, 1, ... within equal ``by``, without one task per group.

    Rows are numbered within hash slices; a slice's first number is the sum of
    the slices before it (at most SLICES rows per group are summed).
    """
    sliced = pieces.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(SLICES)))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        sliced.groupBy(*by, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*by, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    )
    inside = Window.partitionBy(*by, "_slice").orderBy(*order)
    return (
        sliced.withColumn("_row", F.row_number().over(inside))
        .join(firsts, [*by, "_slice"])
        .withColumn("number", F.col("_first") + F.col("_row") - 1)
        .drop("_slice", "_row", "_first")
    )


def pack(pieces: DataFrame, order: list[str], window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 .. window.

    ``order``: columns that tell the pieces apart (equal rows may swap places).
    """
    histogram = np.zeros(window + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most ``window`` rows
        histogram[r["length"]] = r["count"]
    where = pieces.sparkSession.sparkContext.broadcast(  # bounded: ranges of at most ``window`` lengths
        {int(k): v[["first", "sequence", "offset"]].to_numpy() for k, v in slots(plan(histogram, window)).groupby("length")}
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        lengths, numbers = length.to_numpy(), number.to_numpy()
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            ranges = where.value[int(size)]
            k = np.searchsorted(ranges[:, 0], numbers[at], "right") - 1
            sequence[at] = ranges[k, 1] + numbers[at] - ranges[k, 0]
            offset[at] = ranges[k, 2]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    out = numbered(pieces, ["length"], order).withColumn("_place", place("length", "number"))
    return out.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """The pieces of every document with their place in the packed sequences."""
    pieces = materialise(cut_pieces(docs, path, ["doc_id"], window), "pieces")
    return pack(pieces, ["doc_id", "start", "ids_crc32"], window)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
