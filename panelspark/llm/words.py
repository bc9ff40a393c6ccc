"""Vectorised words, rolling hashes and minimisers over whole Arrow batches.

A batch of texts is one byte array with document offsets, so no loop runs over
documents. Words are ``[^\\x20\\x09-\\x0D]+``; these separators are single bytes in
UTF-8. Hashes are polynomials modulo 2**64 over mixed words or bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
NO_SPACE = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
LETTERS = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
WORD = r"[^\x20\x09-\x0D]+"

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2**64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[int(base)] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit items."""

    def __init__(self, items: np.ndarray):
        n = len(items)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(items * powers(BASE, n), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """mix(hash) of items[start:end] for arrays of positions."""
        back = powers(INVERSE, len(self.sums))
        return mix((self.sums[end] - self.sums[start]) * back[start])

    def every(self, length: int) -> np.ndarray:
        """The hash of each stretch of one length, by its start."""
        if len(self.sums) <= length:
            return np.zeros(0, np.uint64)
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * powers(INVERSE, n))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i+width]) for each i that has a whole window, by doubling."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def minimisers(hashes: np.ndarray, width: int) -> np.ndarray:
    """True where a hash is the least of some ``width`` neighbours in a row.

    Any ``width`` consecutive positions contain at least one; equal least values
    all count. A sequence shorter than ``width`` keeps its least values.
    """
    n = len(hashes)
    if n == 0:
        return np.zeros(0, bool)
    width = min(width, n)
    low = sliding_min(hashes, width)
    # the largest window minimum that covers a position
    padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    high = ~sliding_min(~padded, width)
    return high[:n] == hashes


@dataclass
class Texts:
    """The texts of one Arrow column: bytes and where each document starts."""

    data: np.ndarray
    offsets: np.ndarray  # documents + 1

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        """Null texts count as empty."""
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        column = column.fill_null("").cast(pa.large_string())
        if not len(column):
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        return cls(data, offsets - offsets[0])

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def pieces(self, size: int = 1 << 20) -> Iterator[tuple[int, int, Texts]]:
        """(from, to, texts) of whole documents of about ``size`` bytes together, so work arrays stay in cache."""
        begin, n = 0, len(self)
        while begin < n:
            end = int(np.searchsorted(self.offsets, self.offsets[begin] + size, "right")) - 1
            end = min(n, max(end, begin + 1))
            low, high = self.offsets[begin], self.offsets[end]
            yield begin, end, Texts(self.data[low:high], self.offsets[begin : end + 1] - low)
            begin = end

    def lower(self) -> Texts:
        """A-Z lower-cased; other letters stay."""
        upper = (self.data >= 65) & (self.data <= 90)
        return Texts(np.where(upper, self.data + 32, self.data).astype(np.uint8), self.offsets)

    def words(self, letters: bool = False) -> Words:
        """Words between white space, or runs of ASCII letters, digits and other scripts' bytes."""
        data, n = self.data, len(self.data)
        if not n:
            zero = np.zeros(0, np.int64)
            return Words(self, zero, zero, np.zeros(len(self) + 1, np.int64))
        inside = (LETTERS if letters else NO_SPACE)[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return Words(self, start, end, np.searchsorted(start, self.offsets))


@dataclass
class Words:
    texts: Texts
    start: np.ndarray  # byte positions
    end: np.ndarray
    first: np.ndarray  # index of each document's first word; documents + 1

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes, equal in every batch; about a megabyte at a time."""
        out = np.empty(len(self), np.uint64)
        a = 0
        while a < len(out):
            low = self.start[a]
            b = max(a + 1, int(np.searchsorted(self.end, low + (1 << 20), "right")))
            rolling = Rolling(self.texts.data[low : self.end[b - 1]].astype(np.uint64) + np.uint64(1))
            out[a:b] = rolling.of(self.start[a:b] - low, self.end[a:b] - low)
            a = b
        return out
