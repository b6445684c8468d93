"""Pre-tokens of texts and bounded per-worker caches of what a tokenizer makes of them.

Both byte-level and word-level BPE encode each pre-token by itself, so a text's
result is the concatenation of its pre-tokens' results. Texts are cut here
with the standard ``re`` module where its character classes are certain to
agree with the tokenizer's (``PLAIN`` characters, no special token inside);
any other text goes through the tokenizers library whole.
"""

from __future__ import annotations

import os
import re
import unicodedata

#: Entries that a worker's cache holds besides the pinned ones, then it starts anew.
CACHE_ENTRIES = 300_000
#: Pre-tokens of more characters are encoded but not cached.
CACHE_CHARS = 64

_LATIN = [chr(c) for c in (*range(9, 14), *range(32, 127), *range(0xA1, 0x250)) if c != 0x130]
_LETTER = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "L")
_NUMBER = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "N")
_SPACE = r"\x09-\x0d\x20"
#: Characters whose classes, case and composition no Unicode version changes.
NOT_PLAIN = re.compile("[^" + "".join(re.escape(c) for c in _LATIN) + "]")

#: The published pre-token patterns (fixed values), over the classes above.
BYTE_LEVEL = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
WORD_LEVEL = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class PreTokenCache:
    """What ``encode`` (list of pre-tokens to list of results) gives, by pre-token."""

    def __init__(self, encode, pinned: dict | None = None):
        self.encode = encode
        self.pinned = pinned or {}
        self.known = dict(self.pinned)

    def results(self, texts: list[list[str]]) -> list[list]:
        """For each list of pre-tokens the list of results."""
        if len(self.known) > len(self.pinned) + CACHE_ENTRIES:
            self.known = dict(self.pinned)
        missing = list(set().union(*texts) - self.known.keys()) if texts else []
        known, extra = self.known, {}
        if missing:
            found = dict(zip(missing, self.encode(missing), strict=True))
            extra = {k: v for k, v in found.items() if len(k) > CACHE_CHARS}
            known.update((k, v) for k, v in found.items() if len(k) <= CACHE_CHARS)
        if extra:
            known = known | extra
        get = known.__getitem__
        return [list(map(get, text)) for text in texts]
