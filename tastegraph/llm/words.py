"""Words and word n-grams of whole Arrow text columns as NumPy arrays of 64-bit hashes.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D (``[^\\x20\\x09-\\x0D]+``);
in UTF-8 those bytes never occur inside a longer character. Texts are worked on in blocks
of whole documents, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21
_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 1 << 64, 256, dtype=np.uint64)
_BYTE[SPACE] = 0
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_STEP = _U(0x9E3779B97F4A7C15)
_GRAM = _U(0xD6E8FEB86659FD93)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    values = values ^ (values >> _U(32))
    values = values * _U(0xD6E8FEB86659FD93)
    values = values ^ (values >> _U(29))
    values = values * _U(0xBF58476D1CE4E5B9)
    return values ^ (values >> _U(32))


def powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(max(1, count), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Block:
    """Bytes and words of consecutive texts.

    ``first`` and ``count`` say which words belong to which row; ``begin`` and ``end``
    are byte places of a word in ``data``, ``edges`` those of the rows.
    """

    def __init__(self, row: int, data: np.ndarray, edges: np.ndarray):
        self.row, self.data, self.edges = row, data, edges
        self.rows = len(edges) - 1
        inside = ~SPACE[data]
        fresh = np.ones(len(data) + 1, bool)  # a row or a run of bytes begins here
        fresh[1:-1] = ~inside[:-1]
        fresh[edges] = True
        self.begin = np.flatnonzero(inside & fresh[:-1])
        ended = np.ones(len(data) + 1, bool)
        ended[:-1] = ~inside
        ended[edges] = True
        self.end = np.flatnonzero(inside & ended[1:]) + 1
        bounds = np.searchsorted(self.begin, edges)
        self.first, self.count = bounds[:-1], np.diff(bounds)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit value per word, equal for equal words (A-Z lowered on request)."""
        if not len(self.begin):
            return np.zeros(0, np.uint64)
        # A text is below 2 GB, so are the places in it; half the memory of 64-bit ones.
        wide = np.int32 if len(self.data) < 1 << 31 else np.int64
        place = np.zeros(len(self.data), wide)
        lengths = np.diff(np.append(self.begin, len(self.data)))
        place[self.begin[0] :] = np.arange(self.begin[0], len(self.data), dtype=wide)
        place[self.begin[0] :] -= np.repeat(self.begin.astype(wide), lengths)
        longest = int((self.end - self.begin).max())
        table = powers(_STEP, longest)
        np.minimum(place, longest - 1, out=place)
        terms = (_BYTE_LOWER if lower else _BYTE)[self.data]
        terms *= table[place]
        return mix(np.add.reduceat(terms, self.begin))

    def text(self, row: int) -> bytes:
        return self.data[self.edges[row] : self.edges[row + 1]].tobytes()


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks of about ``most`` bytes; null counts as empty."""
    if not len(column):
        return
    column = column.cast(pa.large_binary()).fill_null(b"") if column.null_count else column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
        high = min(max(high, low + 1), len(column))
        yield Block(low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word sequences of one word array, in order (none if it is shorter)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total *= _GRAM
        total += words[i : i + len(total)]
    return mix(total + _U(n))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Like ``grams``; a shorter, not empty text is one shingle as a whole."""
    return grams(words, min(n, len(words))) if len(words) else np.zeros(0, np.uint64)


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hashes of every window of n words, from prefix sums modulo 2^64.

    The sum of ``word * base^place`` over a window is a difference of two prefix sums;
    multiplying by the inverse power moves it to place 0.
    """
    if len(words) < n:
        return np.zeros(0, np.uint64)
    base = _STEP
    scale = powers(base, len(words))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * scale, dtype=np.uint64, out=total[1:])
    back = powers(_U(pow(int(base), -1, 1 << 64)), len(words) - n + 1)
    return mix((total[n:] - total[:-n]) * back)
