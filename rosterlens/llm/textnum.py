"""Vectorised word work on Arrow text columns: bytes, word bounds, 64-bit hashes.

All functions take whole texts. Words are byte runs, and every separator is
ASCII, so UTF-8 needs no decoding. A null text counts as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
# Odd multipliers of 64-bit finalisers and a fixed seed for the byte table.
MULTIPLIERS = [U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)]
BASE = U(0x5851F42D4C957F2D)
SEED = 20240229
PIECE = 2**18 - 1  # bytes hashed with one running sum

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of plain alphanumeric tokens: every other ASCII byte.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_BYTE = np.random.default_rng(SEED).integers(1, 2**63, 256, dtype=np.uint64) | U(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_POWERS: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x = x * MULTIPLIERS[1]
    x ^= x >> U(27)
    x *= MULTIPLIERS[2]
    x ^= x >> U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = U(pow(int(BASE), -1, 2**64))
        for k, base in enumerate((BASE, inverse)):
            p = np.full(size, base, U)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and their bounds."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    bounds = bounds[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def blocks(bounds: np.ndarray, most: int):
    """(first, last) document ranges of about ``most`` bytes; a longer document is a range of its own."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of the documents in one buffer: bounds, document numbers, counts."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = WHITE):
        n = len(data)
        inside = np.zeros(n + 1, bool)
        np.logical_not(separators[data], out=inside[:n])
        cut = np.zeros(n + 1, bool)
        cut[bounds] = True
        before = np.zeros(n + 1, bool)
        before[1:] = inside[:-1]
        self.data, self.bounds = data, bounds
        self.start = np.flatnonzero(inside & (~before | cut))
        self.end = np.flatnonzero(before & (~inside | cut))
        self.first = np.searchsorted(self.start, bounds)  # of each document, and the end
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(bounds) - 1), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """64-bit hash of each word."""
        return self.hash_lists([None], lower)[0]

    def hash_lists(self, lengths: list, lower: bool = True) -> list[np.ndarray]:
        """64-bit hashes of the words, for each of ``lengths`` those of their
        first so many bytes (None: of whole words). Sums run over pieces of the
        buffer, so what they need does not grow with it."""
        table = _LOWER if lower else _BYTE
        out = [np.empty(len(self.start), U) for _ in lengths]
        i = 0
        while i < len(self.start):
            base = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, base + PIECE, "right")))
            start, end = self.start[i:j] - base, self.end[i:j] - base
            n = int(end[-1])
            if n > PIECE:  # a single word
                for o, most in zip(out, lengths):
                    o[i] = self._long_hash(base, n if most is None else min(n, most), table)
            else:
                p, inverse = _powers(n + 1)
                sums = np.zeros(n + 1, U)
                np.cumsum(table[self.data[base:base + n]] * p[:-1], out=sums[1:])
                for o, most in zip(out, lengths):
                    stop = end if most is None else np.minimum(end, start + most)
                    o[i:j] = mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(U) * MULTIPLIERS[0])
            i = j
        return out

    def _long_hash(self, base: int, n: int, table: np.ndarray) -> np.uint64:
        total = n * int(MULTIPLIERS[0])
        for at in range(0, n, PIECE):
            part = table[self.data[base + at:base + min(n, at + PIECE)]]
            total += int(np.add.reduce(part * _powers(len(part))[0])) * pow(int(BASE), at, 2**64)
        return mix(np.array([total % 2**64], U))[0]


def gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive word hashes at each position (len - size + 1)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    total = np.zeros(n, U)
    for j in range(size):
        total = total * BASE + h[j:j + n]
    return mix(total)


def shingle_sets(words: Words, size: int):
    """Sorted distinct shingle hashes of each document, in order. A document of
    fewer words than ``size`` has its whole sequence as its one shingle; one
    without words has none."""
    h = words.hashes()
    g = gram_hashes(h, size)
    for d in range(len(words.bounds) - 1):
        a, n = int(words.first[d]), int(words.count[d])
        if n >= size:
            s = np.sort(g[a:a + n - size + 1])
            keep = np.ones(len(s), bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            yield s[keep]
        elif n:
            with np.errstate(over="ignore"):
                total = U(n)
                for x in h[a:a + n]:
                    total = total * BASE + x
            yield mix(np.array([total ^ MULTIPLIERS[0]]))
        else:
            yield np.zeros(0, U)
