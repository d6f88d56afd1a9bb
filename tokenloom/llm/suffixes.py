"""Suffix arrays by induced sorting, and permuted common prefixes, as numpy array steps.

A scan of induced sorting goes bucket by bucket of the first letter.  All suffixes of a bucket that are
known at a time induce their neighbours together, in the order in which a letter-by-letter scan would,
so every step is an array operation.  For that the alphabet must be small, which the string of names of
the leftmost-smaller substrings has not: there the recursion goes by doubling, from names to pairs of
names and so on, until all differ.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last letter is the unique smallest."""
    change = np.flatnonzero(text[1:] != text[:-1])
    smaller = np.empty(len(text), dtype=bool)
    runs = np.diff(change, prepend=-1)
    smaller[:-1] = np.repeat(text[change] < text[change + 1], runs)
    smaller[-1] = True
    return smaller


def _deal(target: np.ndarray, heads: np.ndarray, letters: np.ndarray, suffixes: np.ndarray, step: int) -> None:
    """Append suffixes to the buckets of their letters in order; ``step`` -1 fills from the end."""
    counts = np.bincount(letters, minlength=len(heads))
    suffixes = suffixes[np.argsort(letters, kind="stable")]
    which = np.flatnonzero(counts)
    if len(letters) > 8 * len(which):
        at = 0
        for c, n, h in zip(which.tolist(), counts[which].tolist(), heads[which].tolist(), strict=True):
            if step > 0:
                target[h : h + n] = suffixes[at : at + n]
            else:
                target[h - n + 1 : h + 1] = suffixes[at : at + n][::-1]
            at += n
    else:
        sizes = counts[which]
        rank = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        target[np.repeat(heads[which], sizes) + step * rank] = suffixes
    heads += step * counts


def _induce(text: np.ndarray, smaller: np.ndarray, sizes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in (sub)order."""
    n, k = len(text), len(sizes)
    array = np.empty(n, dtype=np.int32)
    tails = np.cumsum(sizes)
    starts = tails - sizes
    seeds = seeds[np.argsort(text[seeds], kind="stable")]
    seed_sizes = np.bincount(text[seeds], minlength=k)
    seed_ends = np.cumsum(seed_sizes)
    # the letter before a suffix if the suffix there is larger (smaller) than its next one, else 0
    larger_before, smaller_before = np.zeros(n, text.dtype), np.zeros(n, text.dtype)
    larger_before[1:] = np.where(smaller[:-1], 0, text[:-1])
    smaller_before[1:] = np.where(smaller[:-1], text[:-1], 0)

    def follow(now: np.ndarray, before: np.ndarray, heads: np.ndarray, step: int) -> None:
        letters = before[now]
        known = np.flatnonzero(letters)
        if len(known):
            _deal(array, heads, letters[known], now[known] - 1, step)

    heads = starts.copy()
    present = np.flatnonzero(sizes).tolist()
    for c in present:
        done = int(starts[c])
        while done < (end := int(heads[c])):
            now, done = array[done:end], end
            follow(now, larger_before, heads, 1)
        if seed_sizes[c]:
            follow(seeds[seed_ends[c] - seed_sizes[c] : seed_ends[c]], larger_before, heads, 1)
    larger_ends = heads  # the part of each bucket that larger suffixes fill
    heads = tails - 1
    for c in present[::-1]:
        done = int(tails[c]) - 1
        while done > (end := int(heads[c])):
            now, done = array[end + 1 : done + 1][::-1], end
            follow(now, smaller_before, heads, -1)
        if larger_ends[c] > starts[c]:
            follow(array[starts[c] : larger_ends[c]][::-1], smaller_before, heads, -1)
    array[0] = n - 1
    return array


def _names(text: np.ndarray, ordered: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, int]:
    """A name for each leftmost-smaller substring, by rank of its letters; equal substrings share it."""
    length = np.empty(len(text), dtype=np.int32)
    length[marks[:-1]] = np.diff(marks) + 1
    length[marks[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    differs = length[a] != length[b]
    open_ = np.flatnonzero(~differs)
    at = 0
    while len(open_):
        open_ = open_[at < length[a[open_]]]
        unequal = text[a[open_] + at] != text[b[open_] + at]
        differs[open_[unequal]] = True
        open_ = open_[~unequal]
        at += 1
    names = np.concatenate([[0], np.cumsum(differs)])
    by_place = np.empty(len(text), dtype=np.int32)
    by_place[ordered] = names
    return by_place[marks], int(names[-1]) + 1


def _order_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the string of names.

    Substrings of ``reach`` names are sorted, then those of twice as many by the ranks of their halves,
    and so on; only substrings that are still equal to another take part.
    """
    m = len(names)
    rank = (np.cumsum(np.bincount(names)) - np.bincount(names))[names].astype(np.int64)
    open_ = np.flatnonzero(np.bincount(rank, minlength=m)[rank] > 1)
    reach = 1
    while len(open_):
        after = np.zeros(len(open_), dtype=np.int64)
        inside = open_ + reach < m
        after[inside] = rank[open_[inside] + reach] + 1
        key = rank[open_] * (m + 1) + after
        order = np.argsort(key)
        open_, key = open_[order], key[order]
        old = rank[open_]
        new_group = np.concatenate([[True], key[1:] != key[:-1]])
        old_group = np.concatenate([[True], old[1:] != old[:-1]])
        place = np.arange(len(open_))
        first = np.maximum.accumulate(np.where(new_group, place, 0))
        base = np.maximum.accumulate(np.where(old_group, place, 0))
        rank[open_] = old + first - base
        alone = new_group & np.concatenate([new_group[1:], [True]])
        open_ = open_[~alone]
        reach *= 2
    ordered = np.empty(m, dtype=np.int32)
    ordered[rank] = np.arange(m, dtype=np.int32)
    return ordered


def _sort(text: np.ndarray) -> np.ndarray:
    """Suffix array of small unsigned letters; the last letter is 0, the unique smallest."""
    if len(text) == 1:
        return np.zeros(1, dtype=np.int32)
    smaller = _types(text)
    sizes = np.bincount(text)
    is_mark = np.zeros(len(text), bool)
    is_mark[1:] = smaller[1:] & ~smaller[:-1]
    marks = np.flatnonzero(is_mark).astype(np.int32)
    rough = _induce(text, smaller, sizes, marks)
    ordered = rough[is_mark[rough]]
    names, count = _names(text, ordered, marks)
    if count < len(marks):
        ordered = marks[_order_names(names)]
    return _induce(text, smaller, sizes, ordered)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a byte string in order (a suffix that is a prefix of another comes first)."""
    used = np.flatnonzero(np.bincount(text, minlength=256))
    rank = np.zeros(256, dtype=np.uint8 if len(used) < 256 else np.uint16)
    rank[used] = np.arange(1, len(used) + 1)
    return _sort(np.append(rank[text], rank.dtype.type(0)))[1:]


def permuted_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For each suffix, by place, the common prefix with its predecessor in the order.

    A value is one less than that of the place before wherever both suffixes are preceded by equal
    letters; only the other places are compared, eight letters at a time.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[array[1:]] = array[:-1]
    padded = np.zeros(n + 16, dtype=np.uint8)
    padded[:n] = text
    eights = np.zeros(n + 8, dtype=np.uint64)
    for i in range(8):
        eights |= padded[i : i + n + 8].astype(np.uint64) << np.uint64(8 * i)
    place = np.arange(n)
    reducible = np.zeros(n, bool)
    has = (place > 0) & (before > 0)
    reducible[has] = text[place[has] - 1] == text[before[has] - 1]
    own = np.flatnonzero(~reducible & (before >= 0))
    prefix = np.zeros(n, dtype=np.int64)
    x, y, at = own.copy(), before[own], own.copy()
    while len(x):
        other = eights[x] ^ eights[y]
        limit = n - np.maximum(x, y)
        low = other & (~other + np.uint64(1))
        same = np.where(other == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
        same = np.minimum(same, limit)
        prefix[at] += same
        go = (same == 8) & (limit > 8)
        x, y, at = x[go] + 8, y[go] + 8, at[go]
    source = np.maximum.accumulate(np.where(reducible, 0, place))
    return np.maximum(prefix[source] - (place - source), 0)
