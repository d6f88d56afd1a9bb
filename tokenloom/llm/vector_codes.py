"""Vector codes: each quarter of a vector becomes the number of its nearest codebook entry.

Codebooks come from rounds of assigning and averaging, in whole numbers.  The parts of a block of vectors
are held in a metric tree, built middle-out by the anchors hierarchy: anchors that each own the points
nearest to them, merged upwards into balls, and split downwards in the same way.  A ball caches the sum and
the number of its points.  A round walks down from the root with the list of entries that may own points;
a child inherits the list of its parent and drops the entries that are farther from every point of its
ball than another one.  Once a single entry is left the cached sum goes to it as a whole.  Trees depend on
the points alone: they are built once, written to the shared folder and walked in every round.

Assignments are exact: balls drop an entry only if it is beyond another one by more than rounding can be,
and points are compared by squared distances in whole numbers, ties to the lower entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.llm.storage import staged

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 4096
LEAF = 48
SLACK = 1e-9
KINDS = {"points": "<i4", "order": "<i4", "first": "<i4", "last": "<i4", "left": "<i4", "right": "<i4", "center": "<f8", "radius": "<f8", "total": "<i8"}
MATRICES = ("points", "center", "total")


@dataclass
class Tree:
    """Points in tree order and the balls over them; ball 0 is the root, ``left`` is -1 at leaves.

    A ball covers the points ``[first, last)``; ``total`` is their sum.
    """

    points: np.ndarray
    order: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    right: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    total: np.ndarray

    def packed(self) -> dict[str, bytes]:
        return {k: getattr(self, k).astype(kind).tobytes() for k, kind in KINDS.items()}

    @staticmethod
    def unpacked(raw: dict[str, bytes], width: int) -> Tree:
        found = {k: np.frombuffer(raw[k], kind) for k, kind in KINDS.items()}
        return Tree(**{k: v.reshape(-1, width) if k in MATRICES else v for k, v in found.items()})


def anchor_owners(points: np.ndarray, many: int) -> np.ndarray:
    """Owner of each point among at most ``many`` anchors; equal points have one owner.

    A new anchor is the farthest point of the widest anchor.  It takes the points nearer to itself; only those
    farther from their anchor than half the way between both anchors are looked at.
    """
    chosen, owner = [0], np.zeros(len(points), dtype=np.int64)
    far = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    while len(chosen) < many and far[new := int(np.argmax(far))] > 0:
        between = np.sqrt(((points[chosen] - points[new]) ** 2).sum(axis=1))
        rows = np.flatnonzero(far > between[owner] / 2)
        own = np.sqrt(((points[rows] - points[new]) ** 2).sum(axis=1))
        taken = own < far[rows]
        owner[rows[taken]], far[rows[taken]] = len(chosen), own[taken]
        chosen.append(new)
    return owner


def merges(centers: np.ndarray, radii: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of balls by the size of the ball around both, smallest first; merge ``m`` is ball ``len(sizes) + m``."""
    n, names = len(sizes), list(range(len(sizes)))
    centers, radii, sizes = centers.copy(), radii.copy(), sizes.astype(np.float64)

    def around(i: int) -> np.ndarray:
        apart = np.sqrt(((centers - centers[i]) ** 2).sum(axis=1))
        return np.maximum(apart + radii + radii[i], 2 * np.maximum(radii, radii[i]))

    cost = np.array([around(i) for i in range(n)])
    np.fill_diagonal(cost, np.inf)
    gone, out = np.zeros(n, dtype=bool), []
    for m in range(n - 1):
        i, j = sorted(divmod(int(np.argmin(cost)), n))
        out.append((names[i], names[j]))
        center = (sizes[i] * centers[i] + sizes[j] * centers[j]) / (sizes[i] + sizes[j])
        radii[i] = max(np.sqrt(((centers[k] - center) ** 2).sum()) + radii[k] for k in (i, j))
        centers[i], sizes[i], names[i], gone[j] = center, sizes[i] + sizes[j], n + m, True
        cost[i] = np.where(gone, np.inf, around(i))
        cost[:, i], cost[i, i], cost[j], cost[:, j] = cost[i], np.inf, np.inf, np.inf
    return out


def build_tree(points: np.ndarray) -> Tree:
    """The anchors hierarchy over whole-number ``points`` (at least one row)."""
    values = points.astype(np.float64)
    balls: list[list] = []

    def ball(rows: np.ndarray, first: int) -> int:
        center = values[rows].mean(axis=0)
        radius = float(np.sqrt(((values[rows] - center) ** 2).sum(axis=1).max()))
        balls.append([first, first + len(rows), -1, -1, center, radius, points[rows].sum(axis=0, dtype=np.int64)])
        return len(balls) - 1

    order = np.arange(len(points))
    open_ = [(order.copy(), 0, ball(order, 0))]
    while open_:
        rows, first, at = open_.pop()
        order[first : first + len(rows)] = rows
        if len(rows) <= LEAF:
            continue
        owner = anchor_owners(values[rows], max(2, int(np.sqrt(len(rows)))))
        groups = [g for k in range(owner.max() + 1) if len(g := rows[owner == k])]
        if len(groups) < 2:  # all points equal
            continue
        centers = np.array([values[g].mean(axis=0) for g in groups])
        radii = np.array([np.sqrt(((values[g] - c) ** 2).sum(axis=1).max()) for g, c in zip(groups, centers, strict=True)])
        pairs, n = merges(centers, radii, np.array([len(g) for g in groups])), len(groups)
        for a, b in pairs:
            groups.append(np.concatenate([groups[a], groups[b]]))
        below = [(len(groups) - 1, first, at)]
        while below:  # the merged balls, from the widest down to the anchors
            now, first, at = below.pop()
            if now < n:
                open_.append((groups[now], first, at))
                continue
            for side, slot in zip(pairs[now - n], (2, 3), strict=True):
                balls[at][slot] = ball(groups[side], first)
                below.append((side, first, balls[at][slot]))
                first += len(groups[side])
    columns = list(zip(*balls, strict=True))
    ints = [np.array(c, dtype=np.int32) for c in columns[:4]]
    return Tree(points[order], order.astype(np.int32), *ints, *(np.array(c) for c in columns[4:]))


def exact_kind(points: np.ndarray, book: np.ndarray) -> type:
    """A number type in which squared distances are exact: doubles where they suffice."""
    largest = max(int(np.abs(a).max()) if a.size else 0 for a in (points, book))
    most = 4 * points.shape[1] * largest * largest
    if most >= 1 << 62:
        raise ValueError("components are too large for squared distances in 64 bits")
    return np.float64 if most < 1 << 53 else np.int64


def owners(tree: Tree, book: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray | None]]:
    """``ball, first, last, entries``: balls owned by one entry as a whole (``entries``: None, then the ball's
    entry stands in ``last``), or leaves with the entry of each point."""
    kind = exact_kind(tree.points, book)
    points, exact = tree.points.astype(kind), book.astype(kind)
    norms, values = (exact * exact).sum(axis=1), book.astype(np.float64)
    apart = np.sqrt(((values[:, None] - values) ** 2).sum(axis=2))
    open_ = [(0, np.sort(np.unique(book, axis=0, return_index=True)[1]))]
    while open_:
        at, entries = open_.pop()
        away = ((values[entries] - tree.center[at]) ** 2).sum(axis=1)
        best = int(np.argmin(away))
        reach = 2 * tree.radius[at] * apart[entries, entries[best]]
        beyond = away - away[best] - reach > SLACK * (away + away[best] + reach + 1)
        entries = entries[~beyond]
        if len(entries) == 1:
            yield at, int(tree.first[at]), int(entries[0]), None
        elif tree.left[at] >= 0:
            open_ += [(tree.left[at], entries), (tree.right[at], entries)]
        else:
            a, b = int(tree.first[at]), int(tree.last[at])
            yield at, a, b, entries[np.argmin(norms[entries] - 2 * (points[a:b] @ exact[entries].T), axis=1)]


def tree_sums(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the points that each entry owns."""
    sums, counts = np.zeros(book.shape, dtype=np.int64), np.zeros(len(book), dtype=np.int64)
    for at, a, b, entries in owners(tree, book):
        if entries is None:
            sums[b] += tree.total[at]
            counts[b] += tree.last[at] - tree.first[at]
        else:
            np.add.at(sums, entries, tree.points[a:b])
            counts += np.bincount(entries, minlength=len(book))
    return sums, counts


def tree_codes(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each point, in the order of the block."""
    codes = np.zeros(len(tree.points), dtype=np.int64)
    for at, a, b, entries in owners(tree, book):
        if entries is None:
            codes[a : tree.last[at]] = b
        else:
            codes[a:b] = entries
    apart = tree.points.astype(np.int64) - book[codes]
    out = np.empty((2, len(codes)), dtype=np.int64)
    out[:, tree.order] = codes, (apart * apart).sum(axis=1)
    return out[0], out[1]


def whole_numbers(values: np.ndarray) -> np.ndarray:
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() >= 1 << 31:
        raise ValueError("components are too large for squared distances in 64 bits")
    return scaled.astype(np.int64)


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` of the rows whose vector has components, all of them finite."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", "label", "vector").filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)


def tree_blocks(kept: DataFrame, width: int) -> DataFrame:
    """``vec_ids, labels, trees``: a row for each block of vectors, with one tree for each part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                lists = block.column("vector")
                if (lists.value_lengths().to_numpy(zero_copy_only=False) != width * PARTS).any():
                    raise ValueError(f"all vectors must have {width * PARTS} components")
                values = whole_numbers(lists.flatten().to_numpy(zero_copy_only=False)).reshape(-1, PARTS, width)
                trees = [build_tree(np.ascontiguousarray(values[:, p])).packed() for p in range(PARTS)]
                edges = pa.array([0, block.num_rows], pa.int32())
                columns = [pa.ListArray.from_arrays(edges, block.column(c)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([trees], packed)], names=["vec_ids", "labels", "trees"])

    packed = pa.list_(pa.struct([(k, pa.binary()) for k in KINDS]))
    tree = T.StructType([T.StructField(k, T.BinaryType()) for k in KINDS])
    lists = [T.StructField(f"{c}s", T.ArrayType(kept.schema[c].dataType)) for c in ("vec_id", "label")]
    return kept.mapInArrow(work, T.StructType([*lists, T.StructField("trees", T.ArrayType(tree))]))


def block_trees(batch: pa.RecordBatch, row: int, width: int) -> list[Tree]:
    return [Tree.unpacked(raw, width) for raw in batch.column("trees")[row].as_py()]


def next_books(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after a round: each entry the mean (rounded down) of the parts that it owns; others stay."""
    shape = books.shape
    shared = blocks.sparkSession.sparkContext.broadcast(books)
    names = ["part", "entry", "n", "total"]

    def rows(counts: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        part, entry = np.nonzero(counts)
        total = pa.array(list(sums[part, entry]), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(counts[part, entry]), total], names=names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(shape, dtype=np.int64), np.zeros(shape[:2], dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for p, tree in enumerate(block_trees(batch, row, shape[2])):
                    found = tree_sums(tree, shared.value[p])
                    sums[p] += found[0]
                    counts[p] += found[1]
        yield rows(counts, sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(shape, dtype=np.int64), np.zeros(shape[:2], dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                at = tuple(batch.column(c).to_numpy() for c in ("part", "entry"))
                np.add.at(counts, at, batch.column("n").to_numpy())
                np.add.at(sums, at, batch.column("total").flatten().to_numpy().reshape(batch.num_rows, -1))
        yield rows(counts, sums)

    fields = "part bigint, entry bigint, n bigint, total array<bigint>"
    added = blocks.select("trees").mapInArrow(walk, fields).repartition("part", "entry").mapInArrow(add, fields)
    books = books.copy()
    for r in added.collect():  # at most PARTS * ENTRIES rows
        books[r["part"], r["entry"]] = np.array(r["total"], dtype=np.int64) // r["n"]
    shared.unpersist()
    return books


def coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of every vector of the blocks."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = [tree_codes(t, shared.value[p]) for p, t in enumerate(block_trees(batch, row, books.shape[2]))]
                codes = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
                hexes = [c.tobytes().hex() for c in codes]
                columns = [batch.column(c).slice(row, 1).flatten() for c in ("vec_ids", "labels")]
                columns += [pa.array(hexes, pa.string()), pa.array(sum(e for _, e in found))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    kinds = {c: blocks.schema[f"{c}s"].dataType.elementType.simpleString() for c in ("vec_id", "label")}
    return blocks.mapInArrow(work, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the codebooks ``[part, entry, position]``.

    ``vectors`` has ``vec_id, label, vector``; the codes have ``vec_id, label, code, error, label_error``.
    Vectors that are null, without components, or with a null or non-finite one have no row.  Null ids and null
    labels are kept; ids that are null come last when the first codebooks are taken, and rows of one id in the
    order of their vectors.  Repeated rows count as often as they stand.  Fewer than ``ENTRIES`` rows make
    smaller codebooks, none give no rows.  Vectors of different lengths, or of a length that does not
    divide by four, are an error, as are components whose squared distances exceed 64 bits.
    """
    kept = kept_vectors(vectors)
    firsts = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).select("vector").collect()
    size = len(firsts[0]["vector"]) if firsts else PARTS
    if size % PARTS:
        raise ValueError(f"vectors of {size} components do not divide by {PARTS}")
    start = whole_numbers(np.array([r["vector"] for r in firsts if len(r["vector"]) == size])).reshape(-1, PARTS, size // PARTS)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    blocks = staged(tree_blocks(kept, size // PARTS), "vector-trees")
    for _ in range(rounds if len(firsts) else 0):
        books = next_books(blocks, books)
    codes = staged(coded(blocks, books), "vector-codes")
    of_label = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    met = codes.join(of_label, F.col("label").eqNullSafe(F.col("_label")))
    return met.select("vec_id", "label", "code", "error", "label_error"), books


def _codes_sql() -> str:
    """The rounds written out, a table for each."""
    steps = [
        "kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, embedding AS raw, list_transform(embedding, lambda x: "
        f"floor({SCALE} * CAST(x AS DOUBLE))) AS v, len(embedding) // {PARTS} AS w FROM embeddings WHERE len(embedding) > 0 AND "
        "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "parts AS MATERIALIZED (SELECT r, p, vec_id, raw, v[p * w + 1 : (p + 1) * w] AS x, list_dot_product(x, x) AS xx "
        f"FROM kept, range({PARTS}) AS t(p))",
        "book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, raw) - 1 AS e, x, xx FROM parts "
        f"QUALIFY e < {ENTRIES})",
    ]
    for k in range(ROUNDS + 1):
        steps.append(
            f"near{k} AS MATERIALIZED (SELECT r, a.p, any_value(a.x) AS x, min(CAST(a.xx - 2 * list_dot_product(a.x, b.x) + b.xx AS BIGINT) "
            f"* {ENTRIES} + e) AS best FROM parts a JOIN book{k} b ON a.p = b.p GROUP BY r, a.p)"
        )
        steps.append(
            f"mean{k} AS MATERIALIZED (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS x FROM (SELECT p, best % {ENTRIES} AS e, "
            "i, count(*) AS n, CAST(sum(x[i]) AS BIGINT) AS s FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i "
            f"FROM near{k}) GROUP BY ALL) GROUP BY ALL)"
        )
        steps.append(
            f"book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x, list_dot_product(coalesce(m.x, b.x), coalesce(m.x, b.x)) AS xx "
            f"FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e)"
        )
    last = ROUNDS
    return (
        "WITH " + ",\n".join(steps[:-2]) + f",\ncoded AS (SELECT r, string_agg(lower(printf('%02x', best % {ENTRIES})), '' ORDER BY p) AS code, "
        f"CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM near{last} GROUP BY r)\n"
        "SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, "
        f"(SELECT sha256(string_agg(array_to_string(list_transform(x, lambda c: CAST(c AS BIGINT)), ','), ',' ORDER BY p, e)) FROM book{last}) "
        "AS codebooks_sha256 FROM kept JOIN coded USING (r)"
    )


CODES_SQL = _codes_sql()
