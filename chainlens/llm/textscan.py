"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: bytes of text that are scanned together (a longer text is scanned alone)
SLICE = 1 << 22
_R = 0x9E3779B97F4A7C15


def byte_slices(col: pa.Array):
    """(first row, bytes, row offsets) of consecutive rows of a string column, null as empty."""
    col = col.fill_null("").cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(col.buffers()[2], np.uint8) if off[-1] else np.zeros(0, np.uint8)
    at = 0
    while at < len(col):
        end = max(at + 1, int(np.searchsorted(off, off[at] + SLICE, "right")) - 1)
        yield at, raw[off[at]:off[end]], off[at:end + 1] - off[at]
        at = end


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z and the capital letters of Latin-1 in lower case; the length stays."""
    up = (data >= 65) & (data <= 90)
    if len(data) > 1:
        up[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return data + (up * np.uint8(32))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of a splittable generator)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(r):
        p = np.full(n + 1, r, dtype=np.uint64)
        p[0] = 1
        return np.cumprod(p, dtype=np.uint64)
    return run(_R), run(pow(_R, -1, 1 << 64))


class Scanner:
    """Runs of bytes of equal class > 0 within a row: (start, end, row), and their hashes."""

    def __init__(self, classes: np.ndarray):
        self.classes = classes
        self._p = None

    def words(self, data: np.ndarray, offsets: np.ndarray):
        c = self.classes[data]
        edge = np.empty(len(c) + 1, dtype=bool)
        edge[0] = edge[-1] = True
        np.not_equal(c[1:], c[:-1], out=edge[1:-1])
        edge[offsets] = True
        cuts = np.nonzero(edge)[0]
        start, end = cuts[:-1], cuts[1:]
        is_word = c[start] > 0 if len(start) else np.zeros(0, bool)
        start, end = start[is_word], end[is_word]
        return start, end, np.searchsorted(offsets, start, "right") - 1

    def hashes(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self._p is None or len(self._p[0]) <= len(low):
            self._p = _powers(max(len(low), SLICE))
        p, inv = self._p
        h = np.zeros(len(low) + 1, dtype=np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * p[:len(low)], out=h[1:])
        return mix((h[end] - h[start]) * inv[start] + (end - start).astype(np.uint64))


def hash_of(word: str) -> int:
    """The hash that Scanner.hashes gives a (lower-case) word."""
    b = word.encode()
    total = sum((x + 1) * pow(_R, i, 1 << 64) for i, x in enumerate(b)) + len(b)
    return int(mix(np.array([total % (1 << 64)], dtype=np.uint64))[0])


def window_factors(width: int) -> tuple:
    return tuple(np.uint64(pow(_R, k + 1, 1 << 64) | 1) for k in range(width))


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` consecutive values."""
    n = max(0, len(h) - width + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k, f in enumerate(window_factors(width)):
        total += h[k:k + n] * f
    return mix(total)
