"""Token ids of texts by the tokenizers library, each distinct word encoded once.

Byte-pair merges never cross white space, so a text can be cut there, and the ids of every chunk can be kept in a bounded
cache. A new chunk of letters, with closing punctuation or without, goes to the library's model in its one or two pieces;
any other chunk goes through the whole tokenizer. The result equals ``Tokenizer.encode``. Texts with unusual white space
or with the string of a special token go to the library whole.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Callable

import numpy as np
from tokenizers import Tokenizer

#: Chunks known when a text begins, and once more those known before: chunks in use are never forgotten.
CACHE_CHUNKS = 500_000

#: White space to ``str.split`` that the library's pattern does not take as such.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


#: Characters that close a word and stand in a piece of their own.
_CLOSING = ".,;:!?"

#: The visible character that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_VISIBLE = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}


def _visible(piece: str) -> str:
    return piece if piece.isascii() else piece.encode().decode("latin-1").translate(_VISIBLE)


class _Unusual(Exception):
    """A chunk that can not be treated alone."""


class _Known(dict):
    """Ids, as they lie in memory, of what was asked for; what is not there is made then, or taken from those known before."""

    def __init__(self, make: Callable[[str], bytes], older: dict[str, bytes]) -> None:
        self.make, self.older = make, older

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.make(key)
        self[key] = ids
        return ids

    def cleared(self, most: int) -> _Known:
        """Itself, or with ``most`` entries an empty one that still finds these."""
        if len(self) < most:
            return self
        self.older = {}
        return _Known(self.make, self)


class TextEncoder:
    """Encodes texts with the tokenizer in a file.

    Two kinds of vocabulary are known by their model: one that marks the ends of words and drops white space, and one that
    works on bytes and keeps a blank with the word after it.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.ends_words = bool(self.tokenizer.model.end_of_word_suffix)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.known = _Known(self._chunk_ids, {})
        self.known_pieces = _Known(self._piece_ids, {})

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _chunks(self, text: str) -> list[str] | None:
        """Chunks that the tokenizer treats alone; those of bytes begin with a line feed or have lost one blank."""
        if any(s in text for s in self.special):
            return None
        if self.ends_words:
            return None if any(s in text for s in _SEPARATORS) else text.split()
        return f"\n{text}".replace("\n", " \n").split(" ")[1:]

    def _core(self, chunk: str) -> tuple[str, str, str] | None:
        """A simple chunk as the piece before its word, the word's piece, and the closing one, as the vocabulary writes them."""
        if self.ends_words:
            if not chunk.isascii() and ("Σ" in chunk or not unicodedata.is_normalized("NFC", chunk)):
                return None
            before, blank, word = "", "", chunk.lower()
        elif chunk[0] == "\n":
            before, blank, word = "\u010a", "", chunk[1:]
        else:
            before, blank, word = "", "\u0120", chunk
        core = word.rstrip(_CLOSING)
        if not core.isalpha():
            return None
        closing = word[len(core) :]
        return before, blank + (core if core.isascii() else _visible(core)), closing

    def _piece_ids(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _chunk_ids(self, chunk: str) -> bytes:
        parts = self._core(chunk) if chunk else None
        if parts is not None:
            before, core, closing = parts
            pieces = self.known_pieces
            ids = pieces[before] + pieces[core] if before else pieces[core]
            return ids + pieces[closing] if closing else ids
        if not self.ends_words:
            bare = chunk.removeprefix("\n")
            if bare.split() != [bare]:  # more than one white space side by side, or one that is neither a blank nor a line feed
                raise _Unusual
            if bare == chunk:
                chunk = f" {chunk}"
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of a text as unsigned 32-bit integers; none for null."""
        if not text:
            return np.zeros(0, np.uint32)
        chunks = self._chunks(text)
        if chunks is None:
            return self._whole(text)
        self.known, self.known_pieces = self.known.cleared(CACHE_CHUNKS), self.known_pieces.cleared(CACHE_CHUNKS // 2)
        try:
            ids = np.frombuffer(b"".join(map(self.known.__getitem__, chunks)), np.uint32)
        except _Unusual:
            return self._whole(text)
        return ids if self.ends_words else ids[1:]  # less the line feed put before the text


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker's encoder for a file; kept, with its cache, for the tasks that follow."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]
