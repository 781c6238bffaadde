"""Words, lines and shingles of many texts at once, as numpy arrays over one byte buffer.

A text column arrives as one Arrow buffer of UTF-8.  White space and line breaks are single bytes
there, so positions of words and lines come from a few array operations over the whole buffer, and a
64-bit polynomial hash of any span comes from two prefix sums.  No Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once, so that the arrays over them stay in a core's cache; a longer
#: single text is a slice of its own.
SLICE_BYTES = 1 << 18

# White space that ends a word, [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_UNDO = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = max(n, 4 * SLICE_BYTES) + 1
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 1 << 23:
            _powers[base] = have
    return have[: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one-to-one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_array(column) -> pa.Array:
    """A text column without nulls (null: empty) and with 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_string array and the offsets of its texts in them, from 0."""
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def slices(texts: pa.Array, limit: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``limit`` bytes of text, or one row."""
    limit = limit or SLICE_BYTES
    _, off = buffers(texts)
    start, n = 0, len(texts)
    while start < n:
        end = int(np.searchsorted(off, off[start] + limit, "right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte values weighted by position: entry i is over the first i bytes."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.multiply(_BYTE[data], _power(_BASE, len(data))[: len(data)], out=out[1:])
    return np.add.accumulate(out, out=out)


def moved(values: np.ndarray, places: np.ndarray, back: bool = False) -> np.ndarray:
    """Weighted sums as if their bytes began ``places`` further on (or back)."""
    most = int(places.max()) if len(places) else 0
    return values * _power(_UNDO if back else _BASE, most)[places]


def finished(sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes from the weighted sums of spans that begin at 0, and their sizes."""
    return mix(sums ^ (sizes.astype(np.uint64) << np.uint64(48)))


class Spans:
    """Positions of words or lines in a buffer, and hashes of spans."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self._prefix: np.ndarray | None = None

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and for each text the range of its words."""
        return self._runs(~SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all lines, split at line feeds only; empty lines are left out."""
        return self._runs(self.data != 10)

    def _runs(self, inside: np.ndarray):
        n = len(inside)
        if n == 0:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(len(self.offsets), np.int64)
        cut = np.zeros(n + 1, bool)
        cut[self.offsets] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | cut[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | cut[1:n]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One 64-bit hash per span: equal bytes give equal hashes."""
        if len(starts) == 0:
            return np.zeros(0, np.uint64)
        if self._prefix is None:
            self._prefix = byte_sums(self.data)
        return finished(moved(self._prefix[ends] - self._prefix[starts], starts, back=True), ends - starts)


def windows(hashes: np.ndarray, ranges: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, and the index of each run's first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(_BASE) + hashes[k : k + n]
    owner = np.repeat(np.arange(len(ranges) - 1), np.diff(ranges))
    at = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return mix(total[at]), at


def per_text(values: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Sums of values over each text's range."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[ranges[1:]] - total[ranges[:-1]]


def repeated(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks: values found before in the same text (by position), and values found twice or more."""
    n = len(hashes)
    later, twice = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        key = mix(hashes ^ mix(owner.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        later[order[1:]] = same
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
    return later, twice
