"""Token ids of whole texts with a public byte-level BPE file (no training).

``encode_ids`` gives exactly ``Tokenizer.encode(text, add_special_tokens=False)``
but remembers the ids of words it has met. Byte-level BPE never merges across
pre-tokens, and a space always starts a new pre-token when no two white-space
characters touch, so such a text can be encoded space-separated unit by unit.
Texts with touching white space, or with the string of an added token, are encoded
whole by the library. The memory is
bounded: a full table takes no new entries (frequent words come first).
"""

from __future__ import annotations

import gc
import re
import struct
from collections.abc import Iterable, Iterator

import regex

TOKENIZER_FILE = "byte_bpe_50k.json"
END_ID = 0
CACHE_ENTRIES = 800_000
MAX_UNIT = 200  # characters; longer units are encoded without being remembered

# The pre-token pattern of byte-level BPE; a fixed value of the format.
_PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_TOUCHING = re.compile(r"\s\s")
_POINTS = frozenset(".,;:!?")
_ENCODERS: dict[tuple[str, int], "WordEncoder"] = {}


def default_tokenizer_path() -> str:
    """The installed public tokenizer file; callers may pass any other path."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def _byte_alphabet() -> dict[int, str]:
    """The byte-to-character table of byte-level BPE: printable Latin-1 stays, the rest moves above 255."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(moved)}


class _PreTokens(dict):
    """Pre-token -> little-endian uint32 ids, filled on a miss."""

    def __init__(self, tokenizer, limit: int):
        super().__init__()
        self.model, self.limit, self.alphabet = tokenizer.model, limit, _byte_alphabet()

    def encode(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.alphabet))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        out = self.encode(word)
        if len(self) < self.limit and len(word) <= MAX_UNIT:
            self[word] = out
        return out


class _Units(dict):
    """Unit after a space -> ids of the space and the unit; splits a new unit into pre-tokens."""

    def __init__(self, tokenizer, limit: int):
        super().__init__()
        self.bare, self.limit = _PreTokens(tokenizer, limit // 4), limit - limit // 4
        self.space, self.tokenize = self.bare.alphabet[32], tokenizer.model.tokenize

    def __missing__(self, unit: str) -> bytes:
        if unit.isalpha():
            if unit.isascii():
                ids = [t.id for t in self.tokenize(self.space + unit)]
                out = struct.pack(f"<{len(ids)}I", *ids)
            else:
                out = self.bare.encode(" " + unit)
        elif unit[-1:] in _POINTS and unit[:-1].isalpha():
            out = self[unit[:-1]] + self.bare[unit[-1]]
        else:
            out = b"".join(self[p[1:]] if p[0] == " " and p[1:].isalpha() else self.bare[p] for p in _PRE_TOKEN.findall(" " + unit))
        if len(self) < self.limit and len(unit) <= MAX_UNIT:
            self[unit] = out
        return out


class WordEncoder:
    """One per Python worker and tokenizer file; reused over tasks."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Unit-wise encoding holds for plain byte-level BPE alone; anything else is encoded whole.
        self.by_unit = isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) \
            and self.tokenizer.normalizer is None and not self.tokenizer.pre_tokenizer.add_prefix_space
        self.units = _Units(self.tokenizer, entries) if self.by_unit else None

    def ids(self, text: str | None) -> bytes:
        """Ids as little-endian uint32 bytes; null and empty texts have none."""
        if not text:
            return b""
        if not self.by_unit or _TOUCHING.search(text) or any(a in text for a in self.added):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        first, *rest = text.split(" ")
        head = b"".join(map(self.units.bare.__getitem__, _PRE_TOKEN.findall(first))) if first else b""
        return head + b"".join(map(self.units.__getitem__, rest))

    def ids_of(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """``ids`` of each text. The cycle collector, which would walk the word memory again and again, rests meanwhile;
        nothing made here is cyclic."""
        collecting = gc.isenabled()
        gc.disable()
        try:
            yield from map(self.ids, texts)
        finally:
            if collecting:
                gc.enable()


def encoder(path: str, entries: int = CACHE_ENTRIES) -> WordEncoder:
    """The worker's encoder for ``path`` (its word memory lives as long as the worker)."""
    key = (path, entries)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, entries)
    return _ENCODERS[key]
