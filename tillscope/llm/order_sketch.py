"""Order MinHash sketches and banded alignment of texts' shingles.

A text is its sequence of shingles of five words. A sketch takes the three shingles with the smallest hashes, where the
k-th occurrence of a shingle counts as a shingle of its own, and keeps them in the order of the text. Texts agree in a
sketch if they share these shingles and their order, which tracks similarity under edits.
"""

from __future__ import annotations

import numpy as np

from tillscope.llm.words import Words, mix, shingles

WIDTH = 5
TAKEN = 3
PER_BAND = 2
BANDS = 24
SHORT_BANDS = 42
SHORT = 125
SIMILARITY = 0.8

_LABEL = np.uint64(0xD6E8FEB86659FD93)
_SPREAD = np.uint64(0xA0761D6478BD642F)
_CELLS = 1 << 19
_CANDIDATES = 20


def sequence(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows, and where each row's begin."""
    at, hashes = shingles(words, width)
    return hashes, np.searchsorted(at, words.first)


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Hashes that tell apart the occurrences of a shingle in a text."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if new.all():
        return mix(hashes)
    place = np.arange(len(ordered))
    occurrence = np.empty(len(ordered), dtype=np.uint64)
    occurrence[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return mix(hashes + occurrence * _LABEL)


def _smallest(values: np.ndarray, taken: int) -> np.ndarray:
    """Columns of the ``taken`` smallest values of each row, in ascending order of column."""
    rows, n = values.shape
    if n > 2 * _CANDIDATES:
        limit = np.uint64(min(int((1 << 64) * (_CANDIDATES / n)), (1 << 64) - 1))
        row, column = np.nonzero(values < limit)
        count = np.bincount(row, minlength=rows)
        if count.min() >= taken:
            order = np.lexsort((values[row, column], row))
            first = np.concatenate(([0], np.cumsum(count)[:-1]))
            chosen = order[first[:, None] + np.arange(taken)]
            return np.sort(column[chosen], axis=1)
    return np.sort(np.argsort(values, axis=1, kind="stable")[:, :taken], axis=1)


def bands_of(size: int) -> int:
    """Bands of a text with ``size`` shingles. Shingles are drawn without replacement, so short texts agree less often.

    Pairs with one text under 100 shingles have both under 125 and share all ``SHORT_BANDS``; the first ``BANDS`` are the same.
    """
    return SHORT_BANDS if size < SHORT else BANDS


def band_keys(hashes: np.ndarray, bands: int = BANDS, per_band: int = PER_BAND, taken: int = TAKEN) -> np.ndarray:
    """One key for each band of a text with the given shingles; texts with a key in common are candidates."""
    labels = labelled(hashes)
    taken = min(taken, len(labels))
    sketches = bands * per_band
    seeds = mix(np.arange(1, sketches + 1, dtype=np.uint64) * _LABEL)
    out = np.empty(sketches, dtype=np.uint64)
    step = max(1, _CELLS // len(labels))
    for t in range(0, sketches, step):
        values = (labels[None, :] ^ seeds[t : t + step, None]) * _SPREAD
        values ^= values >> np.uint64(32)
        chosen = labels[_smallest(values, taken)]
        key = np.zeros(len(chosen), dtype=np.uint64)
        for k in range(taken):
            key = mix(key * _SPREAD + chosen[:, k])
        out[t : t + step] = key
    out = out.reshape(bands, per_band)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(per_band):
        key = mix(key * _SPREAD + out[:, k])
    return key


def banded_alignment(x: list[int], y: list[int], band: int) -> int:
    """Most matches of an alignment of ``x`` and ``y`` that keeps within ``band`` of the diagonal.

    Rows are bits of one window that moves down with the columns (bit-parallel longest common subsequence): a cleared bit
    is a row where the count of matches rises.
    """
    places: dict[int, list[int]] = {}
    for i, value in enumerate(x):
        places.setdefault(value, []).append(i)
    n, width = len(x), 2 * band + 1
    full = (1 << width) - 1
    window, matches = full, 0  # bit r is row j - band + r
    for j, value in enumerate(y):
        if j:
            low = j - 1 - band
            if low >= 0 and not window & 1 and low < n:
                matches += 1
            window = (window >> 1) | (1 << (width - 1))
        mask = 0
        for i in places.get(value, ()):
            at = i - j + band
            if 0 <= at < width:
                mask |= 1 << at
        if mask:
            shared = window & mask
            window = ((window + shared) | (window - shared)) & full
    low = len(y) - 1 - band
    return matches + sum(1 for r in range(width) if 0 <= low + r < n and not window >> r & 1)


def similarity(x: np.ndarray, y: np.ndarray, least: float = SIMILARITY) -> float:
    """Shared shingles of the best alignment over all shingles of either text; 0 where it is surely under ``least``."""
    n, m = len(x), len(y)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    if n == m and (x == y).all():
        return 1.0
    needed = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))
    size = min(n, m)
    differ = np.flatnonzero(x[:size] != y[:size])
    head = int(differ[0]) if len(differ) else size
    differ = np.flatnonzero(x[n - size :][::-1] != y[m - size :][::-1])
    tail = min(int(differ[0]) if len(differ) else size, size - head)
    left, right = x[head : n - tail], y[head : m - tail]
    values, codes = np.unique(np.concatenate((left, right)), return_inverse=True)
    a = np.bincount(codes[: len(left)], minlength=len(values))
    b = np.bincount(codes[len(left) :], minlength=len(values))
    if head + tail + int(np.minimum(a, b).sum()) < needed:
        return 0.0
    found = head + tail
    if len(left) and len(right):
        band = max(n + m - 2 * needed, 1)
        found += banded_alignment(codes[: len(left)].tolist(), codes[len(left) :].tolist(), band)
    share = found / (n + m - found)
    return share if share >= least else 0.0
