"""Words of whole texts as arrays: one pass over the bytes of an Arrow column.

A batch is cut between documents into pieces of about ``PIECE`` bytes, so memory follows the
piece (or one longer document), never the batch. A word is known by a 64-bit hash of its bytes;
results that must be exact compare the words themselves afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 2 << 20

BYTES = np.arange(256)
LOWER = np.where((BYTES >= 65) & (BYTES <= 90), BYTES + 32, BYTES).astype(np.uint8)
#: Bytes that end a word, after lowering: white space; or all ASCII but digits and letters.
SPACE = (BYTES == 32) | ((BYTES >= 9) & (BYTES <= 13))
NOT_ALNUM = (BYTES < 128) & ~(((BYTES >= 48) & (BYTES <= 57)) | ((BYTES >= 97) & (BYTES <= 122)))

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
MIX = np.uint64(0xFF51AFD7ED558CCD)


class Powers:
    """BASE**i and its inverse mod 2**64, as far as they have been needed."""

    def __init__(self, base: int) -> None:
        self.base = np.uint64(base)
        self.inverse = np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            one = np.ones(size, np.uint64)
            self.up, self.down = one.copy(), one
            self.up[1:], self.down[1:] = self.base, self.inverse
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)


POWERS = Powers(BYTE_BASE)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(33))) * MIX
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """Words of consecutive documents; those of document d are offsets[d]:offsets[d+1]."""

    data: np.ndarray  # lowered bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray
    bounds: np.ndarray  # bytes of document d are bounds[d]:bounds[d+1]

    def text(self, i: int, j: int) -> bytes:
        """Words i to j, each after one blank."""
        data = self.data
        return b" ".join(data[s:e].tobytes() for s, e in zip(self.starts[i:j], self.ends[i:j]))

    def document_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of n words within one document."""
        if len(self.hashes) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        last = np.repeat(self.offsets[1:], np.diff(self.offsets))  # end of each word's document
        at = np.arange(len(self.hashes) - n + 1)
        at = at[at + n <= last[:len(at)]]
        if len(at) == len(self.hashes) - n + 1:
            return at, rolled(self.hashes, n)
        return at, rolled(self.hashes, n)[at]


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n hashes."""
    size = len(hashes) - n + 1
    out = np.zeros(size, np.uint64)
    for j in range(n):
        out = out * np.uint64(WORD_BASE) + hashes[j:j + size]
    return mixed(out)


def words(data: np.ndarray, bounds: np.ndarray, stops: np.ndarray) -> Words:
    """The words of texts data[bounds[d]:bounds[d+1]]; ``stops`` marks the bytes between words."""
    data = LOWER[data]
    inside = ~stops[data]
    first = bounds[:-1][np.diff(bounds) > 0]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    after[first[first > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    if len(starts):
        POWERS.grow(len(data))
        value = (np.arange(256) + 1) * ~stops
        sums = np.add.reduceat(value.astype(np.uint64)[data] * POWERS.up[:len(data)], starts)
        hashes = mixed(sums * POWERS.down[starts])
    else:
        hashes = np.empty(0, np.uint64)
    return Words(data, starts, ends, hashes, np.searchsorted(starts, bounds), bounds)


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of texts; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + size, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo]
        lo = hi
