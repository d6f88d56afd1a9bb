"""Near-duplicates by exact similarity of word shingles, by prefix filtering.

Two texts are linked if the sets of their five-word shingles have a Jaccard similarity of 0.8 or more.  Then
they share at least ``ceil(0.8 n)`` of the ``n`` shingles of either, so under any order of all shingles the
first ``n - ceil(0.8 n) + 1`` of both have one in common: texts that meet at none are not linked, and no link
is lost.  The order puts the shingles that a sample of the texts holds often last; it decides the work alone.

Texts of equal sets are one row from the start.  First, SimHash fingerprints of the sets that are at most three
bits apart are paired by the anchors of ``simhash``, and the rows of a shingle meet one of them; what the sets
themselves confirm joins components.  Then all rows of a shingle that are in different components meet, block by
block, inside a task: the place of a shingle in both orders bounds what two texts can share, and so do small
bitmaps of the sets, folded for the exchange and whole for the pairs that come out.  Sets travel only for pairs that pass all bounds.  A round hands out a bounded number of
pairs of each component in a group; rounds go on, with joined components and a larger number, until none is held back.
A pair that failed stays apart, and later rounds do not fetch its sets again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.batches import BASE, Chunk, SpanHash, ascii_lower, find_words, gram_hashes, mixed, signed, text_chunks
from tokenloom.llm.bitmaps import key_bitmap, may_hold
from tokenloom.llm.components import components
from tokenloom.llm.simhash import majority_bits
from tokenloom.llm.simhash import near_links as fingerprint_links
from tokenloom.llm.storage import staged

SHINGLE = 5
SIMILARITY = 0.8
SAMPLE = 16
OFTEN = 8
LISTED = 1 << 17
MET_BLOCK = 1024
MET_BITS = 1024
MOST_BITS = 1 << 16
ROUND_PAIRS = 8
ROUND_GROWTH = 64


def shingle_sets(chunk: Chunk) -> list[np.ndarray]:
    """Sorted hashes of the shingles of each text; one of fewer words is a shingle itself."""
    words = find_words(chunk)
    hashes = SpanHash(ascii_lower(chunk.data)).of(words.start, words.end)
    at, grams = gram_hashes(words, hashes, SHINGLE)
    cuts = np.searchsorted(words.row[at], np.arange(chunk.rows + 1))
    out = []
    for row in range(chunk.rows):
        found = grams[cuts[row] : cuts[row + 1]]
        if not len(found) and (n := words.first[row + 1] - words.first[row]):
            total = np.full(1, n, dtype=np.uint64)
            for h in hashes[words.first[row] : words.first[row + 1]]:
                total = total * np.uint64(BASE) + h
            found = mixed(total)
        out.append(np.unique(found))
    return out


def set_print(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes(), 42)


def parity(shingles: np.ndarray) -> bytes:
    """Bitmap of a set: of each bit, whether an odd number of shingles falls on it; at least four bits a shingle,
    from ``MET_BITS`` to ``MOST_BITS``, in powers of two."""
    size = min(MOST_BITS, max(MET_BITS, 1 << (4 * len(shingles)).bit_length()))
    counts = np.bincount((shingles % np.uint64(size)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def folded(bits: bytes, size: int) -> bytes:
    """The parity bitmap of the same set in ``size`` bytes: the exclusive or of its stretches of that length."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint8).reshape(-1, size)).tobytes()


def set_prints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp, n, simhash, bits``: of the shingle set of every row a hash, the size, the SimHash
    fingerprint and the parity bitmap; null text counts as empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in text_chunks(batch.column("text")):
                sets = shingle_sets(c)
                columns = [batch.column(name).slice(c.first, c.rows) for name in ("doc_id", "text_hash")]
                columns.append(pa.array(signed(np.array([set_print(s) for s in sets], np.uint64))))
                columns.append(pa.array([len(s) for s in sets], pa.int32()))
                columns.append(pa.array(signed(np.array([majority_bits(s) for s in sets], np.uint64))))
                columns.append(pa.array([parity(s) for s in sets], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "fp", "n", "simhash", "bits"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(work, "doc_id bigint, text_hash bigint, fp bigint, n int, simhash bigint, bits binary")


def simhash_pairs(prints: DataFrame) -> DataFrame:
    """``a, b`` (``a > b``): links of the sets whose SimHash fingerprints differ in at most three bits."""
    sets = prints.select("simhash", "fp").distinct()
    points = staged(sets.groupBy("simhash").agg(F.min("fp").alias("rep")), "near-points")
    same = sets.join(points, "simhash").filter("fp > rep").select(F.col("fp").alias("a"), F.col("rep").alias("b"))
    links = fingerprint_links(points.select(F.col("simhash").alias("fp"), "rep"))
    return same.unionByName(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))


def common_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample of the texts holds often, sorted, and how often; at most ``LISTED``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                found = np.concatenate([np.zeros(0, np.uint64), *shingle_sets(chunk)])
                shingle, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(shingle)), pa.array(n.astype(np.int64))], names=["shingle", "n"])

    sample = texts.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counts = sample.mapInArrow(work, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counts.filter(F.col("n") >= OFTEN).orderBy(F.desc("n"), "shingle").limit(LISTED).collect()
    shingle = np.array([r["shingle"] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(shingle)
    return shingle[order], np.array([r["n"] for r in rows], dtype=np.int64)[order]


def prefix_rows(texts: DataFrame, similarity: float) -> DataFrame:
    """``shingle, fp, size, pos`` of the shingles of each text at which it can meet a similar one, and their places."""
    shared = texts.sparkSession.sparkContext.broadcast(common_shingles(texts))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, often = shared.value
        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                prefixes, prints, sizes = [np.zeros(0, np.uint64)], [], []
                for own in shingle_sets(chunk):
                    n = len(own)
                    weight = np.zeros(n, dtype=np.int64)
                    if len(common) and n:
                        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                        weight = np.where(common[at] == own, often[at], 0)
                    length = n - int(np.ceil(similarity * n - 1e-9)) + 1 if n else 0
                    prefixes.append(own[np.argsort(weight, kind="stable")[:length]])
                    prints.append(set_print(own))
                    sizes.append(n)
                lengths = [len(p) for p in prefixes[1:]]
                columns = [signed(np.concatenate(prefixes)), np.repeat(signed(np.array(prints, np.uint64)), lengths)]
                columns.append(np.repeat(np.array(sizes, np.int32), lengths))
                columns.append(np.concatenate([np.zeros(0, np.int32), *(np.arange(n, dtype=np.int32) for n in lengths)]))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shingle", "fp", "size", "pos"])

    return texts.mapInArrow(work, "shingle bigint, fp bigint, size int, pos int")


def least_overlap(n: Column, m: Column, similarity: float) -> Column:
    """How many shingles sets of ``n`` and ``m`` have in common at least, if they are similar."""
    return F.ceil((n + m) * (similarity / (1 + similarity)) - 1e-6)


def may_be_similar(similarity: float) -> Column:
    """Whether sets of ``size`` and ``other_size`` that have the shingle at ``pos`` and ``other_pos`` of their orders
    in common can be similar: before and after it they share no more than the shorter stretch."""
    n, m, i, j = (F.col(c) for c in ("size", "other_size", "pos", "other_pos"))
    most = F.least(i, j) + F.least(n - i, m - j)
    return (most >= least_overlap(n, m, similarity)) & (F.least(n, m) >= F.greatest(n, m) * similarity - 1e-9)


def enough_shared(similarity: float) -> Column:
    """Whether ``shared`` of the first shingles in common are enough: of two sets, that whose first part ends first
    in the order has no other shingle there, and all that it can still share stands behind."""
    n, m = F.col("size"), F.col("other_size")
    behind = F.greatest(F.ceil(n * similarity - 1e-9), F.ceil(m * similarity - 1e-9)) - 1
    return F.col("shared") + behind >= least_overlap(n, m, similarity)


def met_pairs(now: DataFrame, similarity: float, most: int) -> DataFrame:
    """``a, b, held`` (``a > b``) of texts of different components ``c`` that can be similar by the places of a
    shingle that they share and by their bitmaps.

    The ``n`` rows of a shingle are dealt into blocks of about ``MET_BLOCK``; each pair of blocks is a group of its
    own, compared inside a task.  A group hands out at most ``most`` pairs of a component with those above it;
    ``held`` marks a row that only says that some were held back.
    """
    dealt = now.withColumn("blocks", F.ceil(F.col("n") / MET_BLOCK).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "to"), F.greatest("own", "to")
    side = F.when(low == high, F.lit(-1)).otherwise(F.col("own"))
    rows = dealt.select(F.xxhash64("shingle", low, high).alias("key"), "fp", "size", "pos", "c", side.alias("side"), "bits")
    parts = max(1, int(now.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    grouped = rows.repartition(parts, "key").sortWithinPartitions("key")
    return grouped.mapInArrow(_compare_groups(similarity, most), "a bigint, b bigint, held boolean")


def _compare_groups(similarity: float, most: int):
    names = ("key", "fp", "size", "pos", "c", "side")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in names]
            raw = b"".join(x.as_py() for x in batch.column("bits"))
            now.append(np.frombuffer(raw, np.uint64).reshape(-1, MET_BITS // 64))
            now = now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            rest = [x[cut:] for x in now]
            if cut:
                yield _group_pairs(*[x[:cut] for x in now], similarity, most)
        if rest is not None:
            yield _group_pairs(*rest, similarity, most)

    return work


def _group_pairs(key, fp, size, pos, c, side, bits, similarity: float, most: int) -> pa.RecordBatch:
    """Pairs of rows of equal key (rows come sorted by key) that pass the bounds; see ``met_pairs``."""
    found, here, lag = [], np.arange(len(key)), 1
    while len(here := here[here + lag < len(key)]):
        here = here[key[here] == key[here + lag]]
        i, j = here, here + lag
        meet = (c[i] != c[j]) & (fp[i] != fp[j]) & ((side[i] < 0) | (side[i] != side[j]))
        i, j = i[meet], j[meet]
        n, m = size[i].astype(np.int64), size[j].astype(np.int64)
        least = np.ceil((n + m) * (similarity / (1 + similarity)) - 1e-6)
        share = np.minimum(pos[i], pos[j]) + np.minimum(n - pos[i], m - pos[j])
        near = (share >= least) & (np.minimum(n, m) >= np.maximum(n, m) * similarity - 1e-9)
        i, j = i[near], j[near]
        apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
        near = apart <= (1 - similarity) / (1 + similarity) * (n + m)[near] + 1e-6
        found.append(np.stack([i[near], j[near]]))
        lag += 1
    i, j = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
    low = np.minimum(c[i], c[j])
    order = np.lexsort((low, key[i]))
    i, j, low = i[order], j[order], low[order]
    new = np.ones(len(i), dtype=bool)
    new[1:] = (key[i][1:] != key[i][:-1]) | (low[1:] != low[:-1])
    at = np.arange(len(i))
    out = at - np.maximum.accumulate(np.where(new, at, 0)) < most
    a, b = np.unique([np.maximum(fp[i], fp[j])[out], np.minimum(fp[i], fp[j])[out]], axis=1)
    held = np.zeros(len(a), dtype=bool)
    if not out.all():
        a, b, held = np.append(a, 0), np.append(b, 0), np.append(held, True)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(held)], names=["a", "b", "held"])


def likely_pairs(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """``pairs`` without those whose parity bitmaps differ in more bits than similar sets have shingles apart."""
    most = (1 - similarity) / (1 + similarity)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y, n in zip(*(batch.column(c).to_pylist() for c in ("left", "right", "n")), strict=True):
                size = min(len(x), len(y))
                apart = int.from_bytes(folded(x, size)) ^ int.from_bytes(folded(y, size))
                good.append(apart.bit_count() <= most * n + 1e-6)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sketches.select(F.col("fp").alias("a"), F.col("bits").alias("left"), F.col("n").alias("m"))
    right = sketches.select(F.col("fp").alias("b"), F.col("bits").alias("right"), F.col("n").alias("o"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right", (F.col("m") + F.col("o")).alias("n"))
    return both.mapInArrow(near, "a bigint, b bigint")


def small_sketches(sketches: DataFrame) -> DataFrame:
    """``fp, bits`` with the bitmaps folded: they travel with every row of a shingle."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = pa.array([folded(x.as_py(), MET_BITS // 8) for x in batch.column("bits")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("fp"), bits], names=["fp", "bits"])

    return sketches.select("fp", "bits").mapInArrow(fold, "fp bigint, bits binary")


def similar_pairs(texts: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``pairs`` (``a, b``: prints) whose sets are similar enough, by the sets themselves."""
    ends = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp")))
    shared = texts.sparkSession.sparkContext.broadcast(key_bitmap(ends, "fp"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                sets = shingle_sets(chunk)
                prints = signed(np.array([set_print(s) for s in sets], np.uint64))
                held = np.flatnonzero(may_hold(shared.value, prints))
                columns = [pa.array(prints[held]), pa.array([sets[i].tobytes() for i in held], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["fp", "shingles"])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    sets = staged(texts.mapInArrow(work, "fp bigint, shingles binary").dropDuplicates(["fp"]), "near-sets")
    left = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("fp").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(confirm, "a bigint, b bigint")


def near_links(texts: DataFrame, prints: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links ``a, b`` of set prints that connect all texts of at least this similarity."""
    parts = max(1, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    same = Window.partitionBy("shingle")
    sketches = staged(prints.select("fp", "n", "bits").dropDuplicates(["fp"]), "near-sketches")
    rows = prefix_rows(texts, similarity).repartition(parts, "shingle").distinct()
    rows = rows.select("*", F.min(F.struct("fp", "size", "pos")).over(same).alias("head"), F.max("fp").over(same).alias("last"))
    met = staged(rows.filter(F.col("head.fp") < F.col("last")), "near-met")
    heads = met.filter(F.col("fp") > F.col("head.fp")).select(
        F.col("fp").alias("a"), F.col("head.fp").alias("b"), "size", "pos", F.col("head.size").alias("other_size"), F.col("head.pos").alias("other_pos")
    )
    counted = heads.filter(may_be_similar(similarity)).groupBy("a", "b", "size", "other_size").agg(F.count(F.lit(1)).alias("shared"))
    first = counted.filter(enough_shared(similarity)).select("a", "b").unionByName(simhash_pairs(prints)).distinct()
    first = staged(likely_pairs(first, sketches, similarity), "near-first")
    links = staged(similar_pairs(texts, first, similarity), "near-links")
    small = staged(small_sketches(sketches), "near-small")
    tried, most = first, ROUND_PAIRS
    while True:
        known = components(links).withColumnRenamed("component", "known")
        now = met.join(known, F.col("fp") == F.col("node"), "left").select("shingle", "fp", "size", "pos", F.coalesce("known", "fp").alias("c"))
        ends = (F.min("c").over(same).alias("low"), F.max("c").over(same).alias("high"), F.count(F.lit(1)).over(same).alias("n"))
        now = now.select("*", *ends).filter("low < high").drop("low", "high").join(small, "fp")
        rest = staged(met_pairs(now, similarity, most), "near-rest")
        fresh = rest.filter("NOT held").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
        fresh = staged(fresh, "near-fresh")
        tried = tried.unionByName(fresh)
        pairs = staged(likely_pairs(fresh, sketches, similarity), "near-pairs")
        if not pairs.isEmpty():
            links = staged(links.unionByName(similar_pairs(texts, pairs, similarity)), "near-links")
        if rest.filter("held").isEmpty():
            return links
        most *= ROUND_GROWTH


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id; columns as they were.

    Repeated rows of that id stay once (of several texts under it, one).  Texts without words are equal.
    Rows with a null id all stay, and link nothing.
    """
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    named = docs.filter("doc_id IS NOT NULL")
    prints = staged(set_prints(named), "near-prints")
    groups = components(near_links(named.select("text"), prints, similarity))
    prints = prints.join(groups, F.col("fp") == F.col("node"), "left").withColumn("group", F.coalesce("component", "fp"))
    stay = prints.groupBy("group").agg(F.min(F.struct("doc_id", "text_hash")).alias("s"))
    stay = stay.select(F.col("s.doc_id").alias("_stays"), F.col("s.text_hash").alias("_hash"))
    stay = stay.groupBy("_stays").agg(F.min("_hash").alias("_hash"))
    packed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_own"))
    kept = packed.join(stay, (F.col("_id") == F.col("_stays")) & (F.col("_own") == F.col("_hash"))).dropDuplicates(["_stays"])
    return kept.select("doc.*").unionByName(docs.filter("doc_id IS NULL"))
