"""Word hashes of whole Arrow batches with numpy, without a Python loop over words.

Words are runs of bytes other than ASCII white space (0x20, 0x09-0x0D). A word's hash is a
polynomial of its bytes modulo 2**64, then mixed; a span of words is a polynomial of their
hashes. Spans that differ share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 0x20

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
LENGTH_SALT = 0x632BE59BD9B4E019
_PIECE = 1 << 17  # bytes hashed at a time
SLICE_BYTES = 3 << 19  # text handed to an operator at a time, but for longer single texts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _power_table(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        table = np.full(size, b, np.uint64)
        table[0] = 1
        both.append(np.cumprod(table, dtype=np.uint64))
    return both[0], both[1]


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below ``size``."""
    up, down = _power_table(base, 1 << max(16, (size - 1).bit_length()))
    return up[:size], down[:size]


class Polynomial:
    """Hashes of spans of a sequence; ``raw`` values can be combined, ``span`` are final."""

    def __init__(self, values: np.ndarray, base: int = _WORD_BASE):
        self.up, self.down = powers(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[:-1], out=self.sums[1:])

    def raw(self, low, high) -> np.ndarray:
        return (self.sums[high] - self.sums[low]) * self.down[low]

    def span(self, low, high) -> np.ndarray:
        length = np.asarray(high - low).astype(np.uint64)
        return mix(self.raw(low, high) + length * np.uint64(LENGTH_SALT))


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of about ``_PIECE`` bytes, each before white space."""
    low = 0
    while low < len(data):
        high = min(low + _PIECE, len(data))
        while high < len(data):
            gaps = np.flatnonzero(SPACE[data[high : high + 65536]])
            if len(gaps):
                high += int(gaps[0])
                break
            high = min(high + 65536, len(data))
        yield low, high
        low = high


class Words:
    """The words of several texts: ``hash``, byte ``start`` and ``end`` of each word, and
    ``first``, the index of each text's first word (one entry more than texts)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = SAME):
        heads = np.zeros(len(data) + 1, bool)
        heads[offsets] = True
        hashes, starts, ends = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
        for low, high in _pieces(data):
            piece = fold[data[low:high]]
            gap, head = SPACE[piece], heads[low : high + 1]
            before = np.concatenate(([True], gap[:-1])) | head[:-1]
            after = np.concatenate((gap[1:], [True])) | head[1:]
            start, end = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
            chars = Polynomial(piece.astype(np.uint64) + np.uint64(1), _BYTE_BASE)
            hashes.append(chars.span(start, end))
            starts.append(start + low)
            ends.append(end + low)
        self.data = data
        self.hash = np.concatenate(hashes)
        self.start = np.concatenate(starts)
        self.end = np.concatenate([np.zeros(0, np.int64), *ends])
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text index and word position of every run of ``size`` words of one text."""
        counts = np.maximum(self.counts() - size + 1, 0)
        text = np.repeat(np.arange(len(self)), counts)
        place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = self.first[:-1][text] + place
        return Polynomial(self.hash).span(at, at + size), text, place


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and where each text begins; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``SLICE_BYTES`` of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = bytes_of(batch.column(text))
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(offsets, offsets[low] + SLICE_BYTES, "right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            yield batch.slice(low, high - low)
            low = high


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
