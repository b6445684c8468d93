"""SentencePiece encoding and decoding of BPE models, exact, by backtracking.

A merge-type encoding is the only sequence of pieces in which every piece, and
every pair of neighbours, comes out again when its text is merged anew. So it
can be built from left to right: take the longest piece that matches here
(Aho-Corasick gives the longest match at every place), step to its shorter
prefixes while it does not agree with the piece before it, and go back one
piece when none is left. A bit per place remembers where no continuation
exists, so every place is left for good at most once and the time is linear in
the text.

No piece reaches across the start of a run of blanks, or from letters to other
characters (both checked when the model is loaded), so texts are cut there and
each worker keeps the encodings of recent units in a bounded cache. Characters outside the vocabulary become
byte pieces.

Cases: a null or empty text has no ids and decodes to the empty string;
repeated rows give repeated results; extra columns named in ``keep`` pass
through, unless a result column has their name.
"""

from __future__ import annotations

import hashlib
import re
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import map_texts, table, worker_state

BLANK = "▁"
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
#: Units: a run of blanks with the letters or the other characters after it.
UNITS = re.compile(
    f"{BLANK}+(?:[{_LETTERS}]+|[^{_LETTERS}{BLANK}\n]+)?|[{_LETTERS}]+|[^{_LETTERS}{BLANK}\n]+|\n"
)
#: Units in each of the two generations that a worker remembers.
CACHE_UNITS = 200_000
CACHE_CHARS = 64
#: Pairs of pieces whose agreement a worker remembers.
CACHE_PAIRS = 500_000


class PieceModel:
    """The vocabulary of a SentencePiece BPE model file, with encode and decode."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.texts = [model.id_to_piece(i) for i in range(n)]
        self.scores = [model.get_score(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        self.byte_ids = {int(self.texts[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.silent = {i for i in range(n) if model.is_control(i)}
        self.unknown = {i for i in range(n) if model.is_unknown(i)}
        self.ids = {self.texts[i]: i for i in range(n) if not special[i] and i not in self.byte_of}
        self.characters = {t for t in self.ids if len(t) == 1}
        self._check()
        self.pairs: dict[int, bool] = {}
        # Only pieces that their own text merges to can stand in an encoding.
        usable = [i for text, i in self.ids.items() if self.merge(text) == [i]]
        self.matcher = ahocorasick.Automaton()
        for i in usable:
            self.matcher.add_word(self.texts[i], (len(self.texts[i]), i))
        self.matcher.make_automaton()
        known = {self.texts[i]: i for i in usable}
        self.shorter = [-1] * n
        for text, i in known.items():
            self.shorter[i] = next((known[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in known), -1)
        self.size = [len(t) for t in self.texts]

    def _check(self) -> None:
        for text in self.ids:
            if len(text) > 1 and len(UNITS.findall(text)) > 1:
                raise ValueError(f"piece {text!r} reaches across a unit")
            if not self.characters.issuperset(text):
                raise ValueError(f"piece {text!r} has a character that is no piece")
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")

    def merge(self, text: str) -> list[int]:
        """Merges the characters of a short text: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                found = self.ids.get(parts[k] + parts[k + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, at = self.scores[found], k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def agree(self, left: int, right: int) -> bool:
        """Whether the two pieces come out again when their joined text is merged."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(self.texts[left] + self.texts[right]) == [left, right]
        return known

    def _run(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces, by backtracking."""
        n = len(text)
        # Matches come by their ends: the last one kept for a start is the longest.
        longest = [-1] * n
        for end, (size, piece) in self.matcher.iter(text):
            longest[end - size + 1] = piece
        failed = 0 if n < 64 else bytearray(n // 8 + 1)
        shorter, sizes, pairs = self.shorter, self.size, self.pairs
        out: list[int] = []
        at, piece, last = 0, longest[0], -1
        while at < n:
            while piece >= 0:
                end = at + sizes[piece]
                bit = failed >> end if n < 64 else failed[end >> 3] >> (end & 7)
                if not bit & 1:
                    if last < 0:
                        break
                    known = pairs.get(last << 32 | piece)
                    if self.agree(last, piece) if known is None else known:
                        break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                at, last = end, piece
                piece = longest[at] if at < n else -1
                continue
            if not out:
                raise ValueError("no encoding: a character is missing from the vocabulary")
            if n < 64:
                failed |= 1 << at
            else:
                failed[at >> 3] |= 1 << (at & 7)
            left = out.pop()
            at -= sizes[left]
            piece, last = shorter[left], out[-1] if out else -1
        return out

    def unit(self, text: str) -> list[int]:
        """Ids of one unit; characters outside the vocabulary become their bytes."""
        if self.characters.issuperset(text):
            return self._run(text)
        out: list[int] = []
        for known, run in groupby(text, self.characters.__contains__):
            if known:
                out += self._run("".join(run))
            else:
                out += [self.byte_ids[b] for b in "".join(run).encode()]
        return out

    def units(self, text: str) -> list[str]:
        return UNITS.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for u in self.units(text) for i in self.unit(u)]

    def pieces_text(self, ids: list[int]) -> str:
        """The text of ids inside a sequence (byte pieces joined, bad bytes replaced)."""
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i in self.unknown:
                out.append(" ⁇ ")
            elif i not in self.silent:
                out.append(self.texts[i].replace(BLANK, " "))
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of a whole sequence: the blank put before it is taken away again."""
        text = self.pieces_text(ids)
        return text[1:] if text.startswith(" ") else text


class UnitCache(dict):
    """(ids joined by commas, what they decode to, number of ids) of recent units.

    Two generations: a full one becomes the old one, from which units that come
    up again move back, so that frequent units stay.
    """

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model
        self.old: dict[str, tuple[str, str, int]] = {}
        self.large: list[str] = []

    def __missing__(self, unit: str) -> tuple[str, str, int]:
        entry = self.old.get(unit)
        if entry is None:
            ids = self.model.unit(unit)
            entry = ",".join(map(str, ids)), self.model.pieces_text(ids), len(ids)
            if len(unit) > CACHE_CHARS:
                self.large.append(unit)
        self[unit] = entry
        return entry

    def encode_decode(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids joined by commas, decoded text)."""
        units = self.model.units(text)
        if not units:
            return 0, "", ""
        ids, texts, sizes = zip(*map(self.__getitem__, units), strict=True)
        for unit in self.large:
            self.pop(unit, None)
        self.large.clear()
        if len(self) > CACHE_UNITS:
            self.old = dict(self)
            self.clear()
        return sum(sizes), ",".join(ids), "".join(texts)[1:]


def encode_decode(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` with n_tokens, ids (joined by commas) and decoded of every whole text."""
    return _mapped(docs, path, keep, text, "n_tokens long, ids string, decoded string", lambda s: s)


def _mapped(docs, path, keep, text, fields, give) -> DataFrame:
    def make():
        cache = worker_state(f"pieces:{path}", lambda: UnitCache(PieceModel(path)))

        def work(texts):
            n_tokens, ids, decoded = [], [], []
            for t in texts:
                n, joined, out = cache.encode_decode(t)
                n_tokens.append(n)
                ids.append(give(joined))
                decoded.append(give(out))
            return n_tokens, ids, decoded

        return work

    return map_texts(docs, make, fields, keep, text)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return _mapped(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        ["doc_id"],
        "text",
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
        _sha256,
    )
