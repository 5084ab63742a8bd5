"""Vectorised tokenising and hashing of whole Arrow text columns.

A batch's texts are one byte buffer plus offsets.  Words and k-word windows are found and hashed with a
handful of array passes, never a Python loop over words, so that one core handles about 30 MB a second.

Hashes are polynomial in the bytes (or word hashes) modulo 2**64 over a random byte table, read off a prefix
sum and then mixed.  Nulls count as empty texts; bytes are UTF-8, so a word is never cut inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE, _STEP = 0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95 | 1
_M = (1 << 64) - 1
#: bytes of text that are worked on at once, so that temporary arrays stay near the cache
BLOCK = 1 << 19


def spaces() -> np.ndarray:
    """True at the six bytes that separate words: space, tab, line feed, vertical tab, form feed, return."""
    out = np.zeros(256, dtype=bool)
    out[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return out


def non_alnum() -> np.ndarray:
    """True at ASCII bytes that are neither digits nor letters (bytes over 127 are word bytes)."""
    out = np.zeros(256, dtype=bool)
    out[:128] = True
    out[48:58] = out[65:91] = out[97:123] = False
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def byte_table(seed: int, fold: bool = False) -> np.ndarray:
    """A random 64-bit value for each byte; fold: A-Z share those of a-z."""
    t = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
    if fold:
        t[65:91] = t[97:123]
    return t


class _Powers:
    """base**i and base**-i, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                x = np.full(size, b, dtype=np.uint64)
                x[0] = 1
                setattr(self, name, np.cumprod(x, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BASE), _Powers(_STEP)


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row's begin and end (n + 1 offsets); nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, at - at[0]


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of rows of at most `size` bytes (or one row of more)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, j
        i = j


class Words:
    """The words of a run of rows: byte spans, row of each word, first word of each row (n + 1)."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> None:
        self.raw, self.offsets, n = raw, offsets, len(raw)
        gap = separators[raw]
        before = np.empty(n + 1, dtype=bool)
        before[0] = True
        before[1:] = gap
        after = np.empty(n + 1, dtype=bool)
        after[:-1] = gap
        after[-1] = True
        before[offsets] = True
        after[offsets] = True
        solid = ~gap
        self.starts = np.flatnonzero(solid & before[:-1])
        self.ends = np.flatnonzero(solid & after[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def hashes(self, table: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = len(self.raw)
        up, down = _BYTES.get(n + 1)
        total = np.empty(n + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(table[self.raw] * up[:n], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * down[self.starts])

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the words that begin k consecutive words of one row, and a hash of each such window."""
        n = len(hashes)
        if n < k:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        up, down = _WORDS.get(n + 1)
        total = np.empty(n + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(hashes * up[:n], out=total[1:])
        at = np.flatnonzero(self.row[: n - k + 1] == self.row[k - 1 :])
        return at, mix((total[at + k] - total[at]) * down[at])


def words_of(column: pa.Array, separators: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int, Words]]:
    """(i, j, words of rows i to j) for each block of a text column."""
    raw, offsets = text_buffer(column)
    for i, j in blocks(offsets, size):
        yield i, j, Words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], separators)
