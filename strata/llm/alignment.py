"""Cross-tokenizer alignment by sparse products of token-byte incidence matrices.

Two tokenizers cut the same bytes. Row i of the incidence matrix A has a one
for every byte of A's i-th token, B likewise. Gustavson's row-by-row product
A Bᵀ then holds the number of bytes that an A and a B token share (*overlap
links*), the product of the token-group matrices links the tokens of one group
(*shared-group links*); groups are the stretches between byte offsets where
tokens of both end. Links that end together are the overlap links whose two
tokens end at the same byte.

A single blank between two other characters is a token start for both
tokenizers: byte-level pre-tokens never go from other characters to white
space, and no piece has a blank after another character (checked when the model
is loaded). So texts are cut there, the products run over batches of different
stretches, and every worker remembers the recent ones.

Two tokens can only end together if the bytes of one are a suffix of the
other's, so the id pairs that can be linked follow from the two vocabularies
(some hundred thousand, whatever the corpus). They are numbered; counts of a
corpus are one bounded vector.

Cases: null and empty texts, and texts whose token bytes of A or B differ from
the blank and the text (a literal U+2581, say), have no tokens: zeros and empty
values; very long stretches without blanks are aligned but not remembered;
repeated rows are counted as often as they come; extra columns named in
``keep`` pass through, unless a result column has their name; an empty table
gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import map_texts, materialise, table, worker_state
from strata.llm.pretokens import load_tokenizer

BLANK = "▁"
#: A blank between two characters that are no white space.
CUT = re.compile(r" (?<=\S )(?=\S)")
#: Stretches in each of the two generations that a worker remembers, of at most so many characters.
CACHE_STRETCHES = 200_000
CACHE_CHARS = 64
#: Characters of stretches whose matrices are multiplied at once.
BATCH_CHARS = 1 << 19


class CSR:
    """A sparse matrix of counts by rows: ``indices[indptr[i]:indptr[i + 1]]`` are the columns of row i."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, n_columns: int):
        self.indptr, self.indices, self.data, self.n_columns = indptr, indices, data, n_columns

    @classmethod
    def of_rows(cls, rows: np.ndarray, columns: np.ndarray, n_rows: int, n_columns: int) -> CSR:
        """Ones at (row, column), given in row order."""
        indptr = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n_rows)))).astype(np.int64)
        return cls(indptr, columns.astype(np.int64), np.ones(len(columns), np.int64), n_columns)

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> CSR:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.n_columns)))).astype(np.int64)
        return CSR(indptr, self.rows()[order], self.data[order], len(self.indptr) - 1)

    def __matmul__(self, other: CSR) -> CSR:
        """Gustavson: row i of the product sums the rows of ``other`` that row i names.

        All rows go through at once: the rows of ``other`` are laid out entry
        by entry, and what falls on one (row, column) is added up.
        """
        sizes = np.diff(other.indptr)[self.indices]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(other.indptr[self.indices], sizes) + within
        keys = np.repeat(self.rows(), sizes) * other.n_columns + other.indices[at]
        values = np.repeat(self.data, sizes) * other.data[at]
        keys, where = np.unique(keys, return_inverse=True)
        data = np.zeros(len(keys), np.int64)
        np.add.at(data, where, values)
        rows = keys // max(other.n_columns, 1)
        indptr = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(self.indptr) - 1)))).astype(np.int64)
        return CSR(indptr, keys - rows * other.n_columns, data, other.n_columns)


def byte_incidence(sizes: np.ndarray) -> CSR:
    """Tokens of the given sizes, one after the other, against bytes."""
    n = int(sizes.sum())
    return CSR.of_rows(np.repeat(np.arange(len(sizes)), sizes), np.arange(n), len(sizes), n)


def group_incidence(ends: np.ndarray, cuts: np.ndarray) -> CSR:
    """Tokens (by their ends) against the groups between the cuts."""
    return CSR.of_rows(np.arange(len(ends)), np.searchsorted(cuts, ends), len(ends), len(cuts))


def overlap_links(a_sizes: np.ndarray, b_sizes: np.ndarray) -> CSR:
    """A tokens against B tokens: the number of bytes they share."""
    return byte_incidence(a_sizes) @ byte_incidence(b_sizes).transposed()


def shared_group_links(a_sizes: np.ndarray, b_sizes: np.ndarray) -> CSR:
    """A tokens against B tokens: a one for tokens of one group."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return group_incidence(a_ends, cuts) @ group_incidence(b_ends, cuts).transposed()


def _byte_values() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for (the published rule)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class TokenPair:
    """The two tokenizers, the bytes of their tokens and the id pairs that can end together."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a, self.b = load_tokenizer(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        value = _byte_values()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(value[c] for c in entry) if all(c in value for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces):
            raise ValueError("a piece has a blank after another character")
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        self.n_ids = max(len(self.a_bytes), len(self.b_bytes))
        self.shown = [f"{i}{mark}" for mark in ",|;" for i in range(self.n_ids)]
        self.pairs = self._pairs()

    def _pairs(self) -> np.ndarray:
        """Sorted keys (a << 32 | b) of the id pairs whose bytes are a suffix one of the other."""
        by_bytes: tuple[dict[bytes, list[int]], ...] = ({}, {})
        for known, texts in zip(by_bytes, (self.a_bytes, self.b_bytes)):
            for i, text in enumerate(texts):
                if text:
                    known.setdefault(text, []).append(i)
        a_ids, b_ids = by_bytes
        keys = set()
        for text, own in a_ids.items():
            for at in range(len(text)):
                keys.update(i << 32 | j for i in own for j in b_ids.get(text[at:], ()))
        for text, own in b_ids.items():
            for at in range(len(text)):
                keys.update(i << 32 | j for i in a_ids.get(text[at:], ()) for j in own)
        return np.sort(np.fromiter(keys, np.int64, len(keys)))

    def align(self, stretches: list[str]) -> list[tuple[str, bytes, int, int, int] | None]:
        """Per stretch (a blank comes before it): groups, numbers of the linked id pairs (int32), tokens of A and B, groups.

        None where the token bytes are not those of the stretch.
        """
        out: list[tuple[str, bytes, int, int, int] | None] = [None] * len(stretches)
        # Stretches between two cuts are encoded as one text, others by themselves.
        plain = [k for k, s in enumerate(stretches) if s and not (s[0].isspace() or s[-1].isspace() or BLANK in s)]
        joined = " ".join([stretches[k] for k in plain])
        a, b = (self._encode([joined]) if plain else ([[]], [[]]))
        if plain and not self._fits(a[0], b[0], joined):
            if len(plain) > 1:
                half = len(plain) // 2
                for part in (plain[:half], plain[half:]):
                    for k, found in zip(part, self.align([stretches[k] for k in part]), strict=True):
                        out[k] = found
            plain, a, b = [], [[]], [[]]
        alone = [k for k, s in enumerate(stretches) if s and (s[0].isspace() or s[-1].isspace() or BLANK in s)]
        if alone:
            for k, x, y in zip(alone, *self._encode([stretches[k] for k in alone]), strict=True):
                if self._fits(x, y, stretches[k]):
                    plain.append(k)
                    a[0].extend(x)
                    b[0].extend(y)
        if plain:
            ends = np.cumsum([len(stretches[k].encode()) + 1 for k in plain])
            for k, found in zip(plain, self._linked(np.array(a[0]), np.array(b[0]), ends), strict=True):
                out[k] = found
        return out

    def _encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        encoded = self.a.encode_batch_fast([" " + s for s in texts], add_special_tokens=False)
        return [e.ids for e in encoded], self.b.encode(texts, num_threads=1)

    def _fits(self, a: list[int], b: list[int], text: str) -> bool:
        raw = (" " + text).encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw

    def _linked(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray):
        """Results of stretches that lie one after the other, to the given ends, on one line of bytes."""
        a_sizes, b_sizes = self.a_sizes[a], self.b_sizes[b]
        a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
        shared = overlap_links(a_sizes, b_sizes)
        i, j = shared.rows(), shared.indices
        linked = a_ends[i] == b_ends[j]
        i, j = i[linked], j[linked]
        cuts = a_ends[i]
        numbers = np.searchsorted(self.pairs, a[i] << 32 | b[j]).astype("<i4").tobytes()
        # Group by group the A tokens, then the B tokens; what follows an id depends on whether it is the last.
        groups = [group_incidence(x, cuts).indices for x in (a_ends, b_ends)]
        order = np.argsort(np.concatenate((groups[0] * 2, groups[1] * 2 + 1)), kind="stable")
        a_kinds, b_kinds = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_kinds[i], b_kinds[j] = 1, 2
        codes = np.concatenate((a_kinds * self.n_ids + a, b_kinds * self.n_ids + b))[order]
        texts = list(map(self.shown.__getitem__, codes.tolist()))
        to = [np.searchsorted(x, ends, side="right") for x in (a_ends, b_ends, cuts)]
        n_a, n_b, n = (np.diff(x, prepend=0).tolist() for x in to)
        first = last = 0
        for x, y, z in zip(n_a, n_b, n):
            until = first + x + y
            yield "".join(texts[first:until])[:-1], numbers[4 * last : 4 * (last + z)], x, y, z
            first, last = until, last + z


class StretchCache:
    """Alignments of recent stretches in two generations, so that frequent ones stay."""

    def __init__(self, pair: TokenPair):
        self.pair, self.new, self.old = pair, {}, {}

    def results(self, texts: list[list[str]]) -> list[list]:
        if len(self.new) > CACHE_STRETCHES:
            self.old, self.new = self.new, {}
        missing, chars, long = [], 0, []
        for s in set().union(*texts) - self.new.keys():
            if s in self.old:
                self.new[s] = self.old[s]
                continue
            missing.append(s)
            chars += len(s)
            if len(s) > CACHE_CHARS:
                long.append(s)
            if chars > BATCH_CHARS:
                self._learn(missing)
                missing, chars = [], 0
        self._learn(missing)
        out = [list(map(self.new.__getitem__, t)) for t in texts]
        for s in long:
            del self.new[s]
        return out

    def _learn(self, stretches: list[str]) -> None:
        if stretches:
            self.new.update(zip(stretches, self.pair.align(stretches), strict=True))


def aligned(docs: DataFrame, path_a: str, path_b: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` with n_a, n_b, n_groups, n_links, groups and links of every whole text.

    ``path_a``: a byte-level BPE of the tokenizers library, given a blank and
    the text; ``path_b``: a SentencePiece BPE that adds the blank itself.
    ``groups`` lists A and B ids as ``a1,a2|b1;a3|b2``, ``links`` the numbers
    (little-endian int32, see ``TokenPair.pairs``) of the id pairs that end together.
    """

    def make():
        key = f"alignment:{path_a}:{path_b}"
        cache = worker_state(key, lambda: StretchCache(TokenPair(path_a, path_b)))

        def work(texts):
            rows = []
            for found in cache.results([CUT.split(t) if t else [] for t in texts]):
                if not found or None in found:
                    rows.append((0, 0, 0, 0, "", b""))
                    continue
                groups, links, n_a, n_b, n = zip(*found)
                rows.append((sum(n_a), sum(n_b), sum(n), sum(n), ";".join(groups), b"".join(links)))
            return list(map(list, zip(*rows))) if rows else [[]] * 6

        return work

    fields = "n_a long, n_b long, n_groups long, n_links long, groups string, links binary"
    return map_texts(docs, make, fields, keep, text)


def pair_counts(links: DataFrame, n_pairs: int, column: str = "links") -> np.ndarray:
    """How many links hold every id pair: a vector of ``n_pairs``, which follows from the vocabularies."""
    import pyarrow as pa

    def run(batches):
        counts = np.zeros(n_pairs, np.int64)
        for batch in batches:
            numbers = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4")
            counts += np.bincount(numbers, minlength=n_pairs)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen])], names=["pair", "n"])

    counted = links.select(column).mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(n_pairs, np.int64)
    rows = counted.toPandas()  # at most n_pairs rows
    out[rows["pair"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def best_of_b(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its B id."""
    b = pairs & 0xFFFFFFFF
    highest = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, b, counts)
    return counts == highest[b]


def with_counts(links: DataFrame, pairs: np.ndarray, counts: np.ndarray, column: str = "links") -> DataFrame:
    """``links`` with n_best and count_sum in place of the link numbers."""
    import pyarrow as pa
    from pyspark.sql.types import LongType, StructType

    shared = links.sparkSession.sparkContext.broadcast((counts, best_of_b(pairs, counts)))
    kept = [c for c in links.columns if c != column]
    source = links.select(*kept, column)
    schema = StructType(source.schema.fields[:-1]).add("n_best", LongType()).add("count_sum", LongType())

    def run(batches):
        counts, best = shared.value
        for batch in batches:
            numbers = [np.frombuffer(v, "<i4") for v in batch.column(len(kept)).to_pylist()]
            sums = [int(counts[x].sum()) for x in numbers]
            bests = [int(np.count_nonzero(best[x])) for x in numbers]
            columns = [batch.column(k) for k in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bests, pa.int64()), pa.array(sums, pa.int64())], names=schema.names)

    return source.mapInArrow(run, schema)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    rows = aligned(table(spark, sf_dir, "documents"), *paths, ["doc_id"])
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    rows = rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "links")
    rows = materialise(rows, "alignment")
    pairs = TokenPair(*paths).pairs
    return with_counts(rows, pairs, pair_counts(rows, len(pairs)))
