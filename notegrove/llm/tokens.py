"""Token ids of whole texts by a public word BPE, with bounded caches per task.

The tokenizer lower-cases, drops white space and never joins across it, so the ids of a text
are those of its space-separated chunks in turn. Each chunk's ids are kept as bytes; a chunk
that is new is cut into the tokenizer's own pieces, whose ids are kept too. Texts to which
that reasoning doesn't apply (unnormalised, odd separators, added tokens like <|endoftext|>)
are encoded whole.
"""

from __future__ import annotations

import struct
import unicodedata
from functools import lru_cache
from os.path import commonprefix

import regex

CACHE_ENTRIES = 400_000
LONG_CHUNK = 64
# The tokenizer's own pre-token pattern.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Split by str.split() but not by the tokenizer; lower-cased by context in Python only.
ODD = regex.compile("[\x1c-\x1fΣİ]")
PLAIN_ENDS = frozenset(",.;:!?")


class WordTokens:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # Added tokens stand for one id wherever they are, white space or not; in any case of
        # letters, for one may be looked for after lower-casing.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(map(regex.escape, added)) or r"(?!)", regex.IGNORECASE)
        start = commonprefix(added)
        self.start = start if start.lower() == start.upper() else ""
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if not text.isascii() and (ODD.search(text) or not unicodedata.is_normalized("NFC", text)) or text.isascii() and not text.isprintable() and ODD.search(text):
            return self._whole(text)
        if self.start in text and self.added.search(text):
            return self._whole(text)
        get, out = self.chunks.get, []
        for chunk in text.split():
            ids = get(chunk)
            out.append(self._chunk(chunk) if ids is None else ids)
        return b"".join(out)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: str) -> bytes:
        low = chunk.lower()
        if not low.isascii() and not unicodedata.is_normalized("NFC", low):
            return self._whole(chunk)
        if low.isalpha():
            pieces = (low,)
        elif low[-1] in PLAIN_ENDS and low[:-1].isalpha():
            pieces = (low[:-1], low[-1])
        else:
            pieces = PIECES.findall(low)
        ids = b"".join([self._piece(p) for p in pieces])
        if len(chunk) <= LONG_CHUNK:
            if len(self.chunks) >= CACHE_ENTRIES:
                self.chunks.clear()
            self.chunks[chunk] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            found = self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))
            ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
            if len(piece) <= LONG_CHUNK:
                if len(self.pieces) >= CACHE_ENTRIES:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One per worker process and file."""
    return WordTokens(path)
