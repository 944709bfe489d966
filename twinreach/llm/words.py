"""Words of UTF-8 texts, found and hashed over the bytes of an Arrow column.

Everything is vectorised over runs of about SLICE bytes, so memory is
bounded by that or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# bytes of words after lower-casing: digits, a-z, all of non-ASCII
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
# bytes of words between white-space
NONBLANK = np.ones(256, dtype=bool)
NONBLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
MARKS = b'.,;:!?"()[]'
_MARK = np.zeros(256, dtype=bool)
_MARK[list(MARKS)] = True
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[0x30:0x3A] = _PLAIN[0x41:0x5B] = _PLAIN[0x61:0x7B] = True
# bytes of pieces between the blanks that every vocabulary splits at
PIECE = np.ones(256, dtype=bool)
PIECE[[0x20, 0x09, 0x0A, 0x0D]] = False
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
STEP = _RNG.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Words:
    """Words of some texts: start, end and text number of each, and hashes.
    ASCII is lower-cased first, unless ``lower`` is false.  With ``parted``
    a word also ends between an ASCII letter or digit and a mark of MARKS."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, kind: np.ndarray,
                 lower: bool = True, parted: bool = False):
        self.data = _LOWER[data] if lower else data
        self._raw = None
        inside = kind[self.data]
        before = np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        edges = bounds[:-1][bounds[:-1] < len(data)]
        before[edges] = False
        if parted:
            mark, plain = _MARK[self.data], _PLAIN[self.data]
            cut = (mark[1:] & plain[:-1]) | (plain[1:] & mark[:-1])
            before[1:] &= ~cut
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:], after[:-1] = False, inside[1:]
        after[edges[edges > 0] - 1] = False
        if parted:
            after[:-1] &= ~cut
        self.end = np.flatnonzero(inside & ~after) + 1
        self.text = np.searchsorted(bounds[1:], self.start, side="right")
        size = self.end - self.start
        if len(size) == 0:
            self.hash = np.empty(0, np.uint64)
            return
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        powers = np.cumprod(np.full(int(size.max()), _BASE, np.uint64))
        self.hash = mix(np.add.reduceat(_BYTE[self.data[inside]] * powers[place], first)
                         + size.astype(np.uint64))

    def raw(self) -> bytes:
        if self._raw is None:
            self._raw = self.data.tobytes()
        return self._raw

    def joined(self, first: int, last: int) -> str:
        """The words from ``first`` up to ``last``, lower-cased, one blank apart."""
        raw = self.raw()
        return b" ".join(raw[s:e] for s, e in zip(
            self.start[first:last].tolist(), self.end[first:last].tolist())).decode("utf-8")

    def grams(self, k: int) -> np.ndarray:
        """Hash of every run of ``k`` words, across texts too."""
        n = max(0, len(self.hash) - k + 1)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h += self.hash[j:j + n] * STEP[j]
        return mix(h + np.uint64(k))


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) of runs of about ``size`` bytes, a row at least."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        bounds = offsets[row:end + 1]
        yield row, data[bounds[0]:bounds[-1]], bounds - bounds[0]
        row = end
