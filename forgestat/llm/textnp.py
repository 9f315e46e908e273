"""Vectorised text helpers for use inside Arrow tasks.

A batch's string column is read as one byte buffer plus offsets; words and
word hashes of many documents come from a few numpy passes over that buffer,
in pieces of bounded size, so no per-word Python objects are made. A single
text larger than a piece is handled whole.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20          # bytes of text handled at a time
SHINGLE = 5              # words in a shingle

_BASE = np.uint64(0x9E3779B97F4A7C15)            # odd, hence invertible modulo 2**64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SLOT = np.array([0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93,
                  0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32                               # A-Z only

SPACE = np.zeros(256, dtype=bool)                # \x20 and \x09-\x0D
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        def geometric(q):
            t = np.full(max(n, PIECE) + 1, q, dtype=np.uint64)
            t[0] = 1
            return np.multiply.accumulate(t)
        tables = [geometric(_BASE), geometric(_INV)]
        if n > 4 * PIECE:                        # a very long text: not kept
            return tables[0], tables[1]
        _powers[:] = tables
    return _powers[0], _powers[1]


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (len + 1) of a string array; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if len(column) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def release() -> None:
    """Give memory that is no longer used back to the system: Python workers are
    kept from task to task beside an executor of fixed size."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


@dataclass
class Piece:
    """Some consecutive documents of a batch and their words."""
    lo: int                  # first document (index in the batch)
    hi: int                  # past the last document
    raw: np.ndarray          # bytes as given
    buf: np.ndarray          # bytes, A-Z lowered
    doc_at: np.ndarray       # byte offset of each document in buf, and the end
    start: np.ndarray        # first byte of each word
    end: np.ndarray          # past the last byte of each word
    first: np.ndarray        # index of each document's first word, and the number of words

    def word_hash(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)

    def span_hash(self, *spans: np.ndarray) -> np.ndarray | list[np.ndarray]:
        """Hash of the bytes from each start to each end (pairs of arrays); equal
        bytes have equal hashes wherever they stand."""
        n = len(self.buf)
        power, inverse = _power_tables(n)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        out = [mix((sums[e] - sums[s]) * inverse[s]) for s, e in zip(spans[::2], spans[1::2], strict=True)]
        return out[0] if len(out) == 1 else out

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.hi - self.lo), np.diff(self.first))


def pieces(column: pa.Array, separators: np.ndarray, most: int = PIECE, lower: bool = True) -> Iterator[Piece]:
    """Cut a string column into pieces of at most ``most`` bytes (or one text)."""
    raw, offsets = string_buffers(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        hi = min(hi, n)
        given = raw[offsets[lo]:offsets[hi]]
        buf = LOWER[given] if lower else given
        at = offsets[lo:hi + 1] - offsets[lo]
        word = ~separators[buf]
        begins, ends = word.copy(), np.zeros(len(buf) + 1, dtype=bool)
        cut = np.zeros(len(buf) + 1, dtype=bool)
        cut[at] = True
        if len(buf):
            begins[1:] &= ~word[:-1] | cut[1:-1]
            ends[1:-1] = word[:-1] & (~word[1:] | cut[1:-1])
            ends[-1] = word[-1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends)
        yield Piece(lo, hi, given, buf, at, start, end, np.searchsorted(start, at).astype(np.int64))
        lo = hi
    release()


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (positions 0 .. n - size)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, (size * int(_SLOT[0])) % (1 << 64), dtype=np.uint64)
    for k in range(size):
        total += mix(words[k:k + n] + _SLOT[k % 5]) * np.uint64(int(_SLOT[(k + 1) % 5]) ^ (2 * (k // 5)))
    return mix(total)


def shingle_sets(piece: Piece) -> Iterator[np.ndarray]:
    """Sorted distinct 5-word shingle hashes of each document of a piece; with
    fewer words the whole sequence is one shingle, without words none."""
    words = piece.word_hash()
    grams = gram_hashes(words, SHINGLE)
    for a, b in zip(piece.first[:-1].tolist(), piece.first[1:].tolist(), strict=True):
        k = b - a
        if k >= SHINGLE:
            yield np.unique(grams[a:b - SHINGLE + 1])
        else:
            yield gram_hashes(words[a:b], k) if k else np.zeros(0, dtype=np.uint64)
