"""Codebooks and codes against plain rounds over all points and all entries."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tokenloom.llm import vector_codes

FIELDS = "vec_id bigint, vector array<float>, label int, code string, error bigint, label_error bigint, points int, n int"


def plain_codes(rows, rounds=4):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    points = [[math.floor(1024 * float(np.float32(x))) for x in r[1]] for r in kept]
    if not kept:
        return [], []
    w = len(points[0]) // 4
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, points[i]))[:256]
    books = [[points[i][p * w : (p + 1) * w] for i in first] for p in range(4)]

    def nearest(p):
        out = []
        for x in points:
            x = x[p * w : (p + 1) * w]
            out.append(min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(books[p])))
        return out

    for _ in range(rounds):
        for p in range(4):
            owned = defaultdict(list)
            for x, (_, i) in zip(points, nearest(p), strict=True):
                owned[i].append(x[p * w : (p + 1) * w])
            for i, own in owned.items():
                books[p][i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [nearest(p) for p in range(4)]
    errors = [sum(found[p][i][0] for p in range(4)) for i in range(len(kept))]
    of_label = defaultdict(int)
    for r, e in zip(kept, errors, strict=True):
        of_label[r[2]] += e
    codes = ["".join(f"{found[p][i][1]:02x}" for p in range(4)) for i in range(len(kept))]
    return [(r[0], r[2], c, e, of_label[r[2]]) for r, c, e in zip(kept, codes, errors, strict=True)], books


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 9, 9, 9, 9) for r in rows], FIELDS).repartition(3)


def some_rows(seed, n, values, width=8):
    rng = random.Random(seed)
    rows = [(i, [values(rng) for _ in range(width)], rng.choice([1, 2, 3, None])) for i in rng.sample(range(10 * n), n)]
    rows += rows[:5] + [(None, rows[7][1], 1), (None, None, None), (3, None, 1), (4, [], 1), (5, [None] * width, 2)]
    return rows + [(6, [float("nan")] * width, 2), (7, [1.0] * (width - 1) + [float("-inf")], 2), (None, rows[8][1], None)]


KINDS = {
    "spread": lambda rng: rng.gauss(0, 1),
    "ties": lambda rng: rng.randrange(-2, 3) / 1024,
    "clusters": lambda rng: rng.choice([-3, 0, 5]) + rng.gauss(0, 0.01),
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("leaf, block", [(48, 4096), (2, 100)])
def test_codes_equal_plain_rounds(spark, monkeypatch, kind, leaf, block):
    monkeypatch.setattr(vector_codes, "LEAF", leaf)
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rows = some_rows(4, 420, KINDS[kind])
    wanted, books = plain_codes(rows)
    codes, found = vector_codes.compress(frame(spark, rows))
    assert found.tolist() == books
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in codes.collect()), key=key) == sorted(wanted, key=key)


def test_few_rows_and_none(spark):
    rows = some_rows(5, 20, KINDS["spread"])
    wanted, books = plain_codes(rows)
    codes, found = vector_codes.compress(frame(spark, rows))
    assert found.tolist() == books
    assert sorted(r.error for r in codes.collect()) == sorted(r[3] for r in wanted)
    for none in ([], [(1, None, 1)]):
        codes, _ = vector_codes.compress(frame(spark, none))
        assert codes.count() == 0


@pytest.mark.parametrize("n", [1, 2, 49, 700])
def test_balls_cover_their_points(monkeypatch, n):
    monkeypatch.setattr(vector_codes, "LEAF", 5)
    points = np.random.default_rng(n).integers(-9, 9, (n, 3))
    points[n // 2 :] = points[0]  # many equal points
    tree = vector_codes.build_tree(points)
    assert (points[tree.order] == tree.points).all() and sorted(tree.order) == list(range(n))
    for at in range(len(tree.first)):
        own = tree.points[tree.first[at] : tree.last[at]]
        assert (own.sum(axis=0) == tree.total[at]).all()
        assert (np.sqrt(((own - tree.center[at]) ** 2).sum(axis=1)) <= tree.radius[at] + 1e-9).all()
        if tree.left[at] >= 0:
            left, right = tree.left[at], tree.right[at]
            assert (tree.first[left], tree.last[left], tree.last[right]) == (tree.first[at], tree.first[right], tree.last[at])


def test_whole_balls_are_owned():
    points = np.concatenate([np.random.default_rng(1).integers(0, 9, (500, 4)) + 1000 * k for k in range(5)])
    tree = vector_codes.build_tree(points)
    book = np.array([[1000 * k] * 4 for k in range(5)])
    found = list(vector_codes.owners(tree, book))
    assert all(f[3] is None for f in found) and len(found) < 40
    assert vector_codes.tree_sums(tree, book)[1].tolist() == [500] * 5


def test_large_components(spark):
    assert vector_codes.exact_kind(np.full((1, 2), 1 << 27), np.full((1, 2), 1)) is np.int64
    with pytest.raises(ValueError):
        vector_codes.whole_numbers(np.array([3e38]))
