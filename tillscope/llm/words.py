"""Words and shingles of Arrow text columns as arrays of 64-bit hashes.

A word is a run of characters other than U+0000-002F, U+003A-0060 and U+007B-007F once A-Z is lower-cased. All of these
are single bytes in UTF-8, so cutting bytes cuts the same words. Columns are worked through in pieces of about
``PIECE`` bytes, so temporary arrays stay small for texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20

BATCH = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[0x00:0x30] = _IS_WORD[0x3A:0x61] = _IS_WORD[0x7B:0x80] = False
_VALUE = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, PIECE + 1)
        for name, base in (("up", _STEP), ("down", _BACK)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words of a column: ``data[starts[i]:ends[i]]`` is word i; row r has words ``first[r]`` to ``first[r + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def text(self, begin: int, end: int) -> str:
        """Words ``begin`` to ``end`` joined by blanks."""
        data = self.data
        return b" ".join(data[s:e].tobytes() for s, e in zip(self.starts[begin:end], self.ends[begin:end])).decode(
            "utf-8", "replace"
        )


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The words' hashes, from running sums over pieces that begin and end at words."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        begin = starts[i]
        j = max(int(np.searchsorted(ends, begin + PIECE, side="right")), i + 1)
        piece = data[begin : ends[j - 1]]
        up, down = _power_tables(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_VALUE[piece] * up[: len(piece)], out=sums[1:])
        a, b = starts[i:j] - begin, ends[i:j] - begin
        out[i:j] = mix((sums[b] - sums[a]) * down[a])
        i = j
    return out


def split_words(column: pa.Array) -> Words:
    """Words of every row; a null row has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    low, high = (int(offsets[0]), int(offsets[-1])) if len(column) else (0, 0)
    raw = np.frombuffer(column.buffers()[2], dtype=np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)
    data, bounds = _LOWER[raw], (offsets - low if len(column) else np.zeros(1, np.int64))
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _IS_WORD[data]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    begins[edges] = inside[1:-1][edges]
    last = bounds[1:][bounds[1:] > 0] - 1
    stops[last] = inside[1:-1][last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(data, starts, ends, _hashes(data, starts, ends), np.searchsorted(starts, bounds))


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of each run of ``width`` words inside a row."""
    n = len(words.hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total = total * _STEP + words.hashes[k : k + n]
    rows = words.rows()
    at = np.flatnonzero(rows[:n] == rows[width - 1 :])
    return at, mix(total[at] + np.uint64(width))


def small_batches(batches: Iterable[pa.RecordBatch], *columns: str, most: int = BATCH) -> Iterator[pa.RecordBatch]:
    """The same rows in batches with about ``most`` bytes of text in the columns named."""
    for batch in batches:
        sizes = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy().astype(np.int64) for c in columns)
        group = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(a, b - a)
