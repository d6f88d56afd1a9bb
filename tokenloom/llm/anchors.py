"""Content-chosen anchors: every window of a text holds one, and equal windows choose the same one."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from tokenloom.llm.batches import Chunk, SpanHash

PLACE_BITS = 22
PIECE = 1 << 20


@dataclass
class Anchors:
    """Anchors of a chunk: row, place in the row, seed hash, and the bytes its windows cover with their hash."""

    row: np.ndarray
    at: np.ndarray
    seed: np.ndarray
    low: np.ndarray
    high: np.ndarray
    context: np.ndarray


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values (running minima of blocks, from both sides)."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def _pieces(chunk: Chunk, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes, bounds and offset: the chunk, or pieces of its only text that overlap by a window less one."""
    if len(chunk.data) <= 2 * PIECE:
        yield chunk.data, chunk.bounds, 0
        return
    for at in range(0, len(chunk.data), PIECE):
        part = chunk.data[at : at + PIECE + window - 1]
        yield part, np.array([0, len(part)], dtype=np.int64), at


def find_anchors(chunk: Chunk, window: int, seed: int) -> Iterator[Anchors]:
    """The anchor of a window is its ``seed``-byte string of least hash, the leftmost of equals.

    Windows that choose the same anchor stand side by side; together they are its context.  A text shorter
    than ``window`` has none.  Long texts come in pieces, so one anchor may have several contexts.
    """
    mask = np.uint64((1 << PLACE_BITS) - 1)
    for data, bounds, offset in _pieces(chunk, window):
        if len(data) < window:
            continue
        spans = SpanHash(data)
        grams = spans.windows(seed)
        marked = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        least = sliding_min(marked, window - seed + 1)
        change = np.zeros(len(data) + 1, dtype=np.int32)
        long = np.diff(bounds) >= window
        np.add.at(change, bounds[:-1][long], 1)
        np.subtract.at(change, bounds[1:][long] - window + 1, 1)
        inside = np.flatnonzero(np.cumsum(change)[: len(least)] > 0)
        if not len(inside):
            continue
        chosen = (least[inside] & mask).astype(np.int64)
        opens = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (inside[1:] != inside[:-1] + 1)])
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(inside)) - 1
        at, low, high = chosen[first], inside[first], inside[last] + window
        row = np.searchsorted(bounds, low, side="right") - 1
        base = bounds[row] - offset
        context = spans.of(low, high) ^ ((at - low).astype(np.uint64) << np.uint64(32)) ^ (high - low).astype(np.uint64)
        yield Anchors(row, at - base, spans.of(at, at + seed), low - base, high - base, context)
