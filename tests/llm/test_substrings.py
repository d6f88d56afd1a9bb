"""Suffix arrays, anchors and the removal of repeated strings against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from odd_rows import no_docs, odd_docs, texts
from tokenloom.llm import anchors, substring_dedup
from tokenloom.llm.batches import Chunk
from tokenloom.llm.suffixes import permuted_prefixes, suffix_array


@pytest.mark.parametrize("letters", [1, 2, 3, 30, 256])
def test_suffix_array_and_prefixes(letters):
    rng = random.Random(letters)
    for n in (1, 2, 5, 40, 300):
        text = bytes(rng.randrange(letters) for _ in range(n)) * rng.choice([1, 3])
        array = np.frombuffer(text, np.uint8)
        found = suffix_array(array)
        wanted = sorted(range(len(text)), key=lambda i: text[i:])
        assert found.tolist() == wanted
        common = permuted_prefixes(array, found)
        for a, b in zip(wanted, wanted[1:]):
            k = 0
            while k < min(len(text) - a, len(text) - b) and text[a + k] == text[b + k]:
                k += 1
            assert common[b] == k


def test_every_window_has_an_anchor_in_pieces_too(monkeypatch):
    rng = random.Random(1)
    data = np.frombuffer(bytes(rng.choice(b"abc ") for _ in range(5000)), np.uint8)
    chunk = Chunk(0, data, np.array([0, len(data)]))

    def choices(chunk):
        seen = {}
        for a in anchors.find_anchors(chunk, 40, 12):
            for at, low, high, seed in zip(a.at, a.low, a.high, a.seed):
                for p in range(low, high - 39):
                    seen[int(p)] = (int(at), int(seed))
        return seen

    whole = choices(chunk)
    assert sorted(whole) == list(range(len(data) - 39))
    by_content = {}
    for p, (at, _) in whole.items():
        assert by_content.setdefault(data[p : p + 40].tobytes(), at - p) == at - p
    monkeypatch.setattr(anchors, "PIECE", 700)
    assert choices(chunk) == whole


def plain(rows, window):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + window] for t in data for i in range(len(t) - window + 1))
    out = Counter()
    for (doc, _), t in zip(rows, data):
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("window, seed, block", [(24, 8, 8192), (24, 24, 8192), (30, 12, 2)])
def test_removed_bytes(spark, monkeypatch, window, seed, block):
    monkeypatch.setattr(substring_dedup.covered_parts, "__defaults__", (window, block))
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 4000)
    found = substring_dedup.dedup_substrings(odd_docs(spark), window, seed).drop("spans").collect()
    assert Counter(map(tuple, found)) == plain([r[:2] for r in texts()], window)


def test_no_rows(spark):
    assert substring_dedup.dedup_substrings(no_docs(spark)).count() == 0
