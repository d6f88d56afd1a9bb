"""Texts of Arrow batches in bounded pieces, and hashes of their words as numpy arrays.

Arrow batches hold many rows, so numpy work on a batch is cut into chunks of about
``CHUNK_BYTES`` of text (a longer single text is a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Chunk:
    """Rows ``[first, first + len(bounds) - 1)`` of a batch: their bytes on end, and where each begins."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def texts(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """UTF-8 bytes of a string column (null counts as empty), chunk by chunk."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Chunk(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def mixed(h: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit of a 64-bit value over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, BASE, dtype=np.uint64)
    up[0] = 1
    down = np.full(n + 1, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class SpanHash:
    """Hash of any span of a byte string in constant time (a polynomial modulo 2^64, mixed)."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(20, int(len(data)).bit_length())
        up, self.down = _powers(size)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, width: int) -> np.ndarray:
        """The hash of every window of ``width`` bytes."""
        n = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


@dataclass
class Words:
    """Words of a chunk: byte spans, the row each belongs to, and where a row's words begin."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def find_words(chunk: Chunk) -> Words:
    """Maximal runs without ASCII white space; a run ends with its text."""
    inside = ~SPACE[chunk.data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    heads = chunk.bounds[:-1]
    heads = heads[heads < len(chunk.data)]
    opens[heads] = inside[heads]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    tails = chunk.bounds[1:][chunk.bounds[1:] > 0] - 1
    closes[tails] = inside[tails]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    row = np.searchsorted(chunk.bounds, start, side="right") - 1
    return Words(start, end, row, np.searchsorted(row, np.arange(chunk.rows + 1)))


def gram_hashes(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Position of the first word and the hash of every ``n``-word window that lies inside one row."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(words.row[: len(hashes) - n + 1] == words.row[n - 1 :])
    total = hashes[at].copy()
    for k in range(1, n):
        total = total * np.uint64(BASE) + hashes[at + k]
    return at, mixed(total)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
