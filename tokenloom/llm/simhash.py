"""SimHash fingerprints and their links by anchor-point covering.

Fingerprints of 64 bits are linked at three or fewer differing bits.  Then at least one half of 32
bits differs in at most one bit.  For each half the anchors are the words of the perfect Hamming
code of length 31: every point lies within radius 1 of exactly one anchor.  A fingerprint is copied
to every anchor within radius 1 + threshold 1 = 2 of its half (1 or 16 anchors), so two linked
fingerprints meet at an anchor; there all 64 bits are compared.

Equal fingerprints are one row from the start, so copies do not weigh.  An anchor with very many
fingerprints is dealt into blocks, and each pair of blocks is compared in a group of its own; a
group returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.batches import signed, text_chunks
from tokenloom.llm.components import components
from tokenloom.llm.storage import staged

SHINGLE = 3
MAX_BITS = 3
CODE_BITS = 31
GROUP_LIMIT = 2048
BIT_ROWS = 1 << 16


def majority_bits(values: np.ndarray) -> int:
    """Bit ``i`` is set if it is set in over half the 64-bit values."""
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(values), BIT_ROWS):
        bits = np.unpackbits(values[i : i + BIT_ROWS].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view(np.uint64)[0])


def text_fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit ``i`` is set if it is set in over half the XXH64 values of the text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends]]
    digest = xxhash.xxh64_intdigest
    values = np.fromiter(
        (digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :], strict=False)),
        dtype=np.uint64, count=len(words) - width + 1,
    )
    return majority_bits(values)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` (signed longs) of every row; null text counts as empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [text_fingerprint(t, shingle) for c in text_chunks(batch.column("text")) for t in c.texts()]
            fp = signed(np.array(values, dtype=np.uint64))
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(fp)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(work, "doc_id bigint, text_hash bigint, fp bigint")


def _flips() -> np.ndarray:
    """For each syndrome the masks that lead to the anchors within distance 2; the first is the nearest."""
    table = np.zeros((CODE_BITS + 1, 16), dtype=np.int64)
    for s in range(1, CODE_BITS + 1):
        pairs = [(a, a ^ s) for a in range(1, CODE_BITS + 1) if a < a ^ s]
        table[s] = [1 << (s - 1), *[1 << (a - 1) | 1 << (b - 1) for a, b in pairs]]
    return table


FLIPS = _flips()


def anchors_of(half: np.ndarray) -> np.ndarray:
    """Anchors of 32-bit values, 16 columns; a code word has itself alone (its row repeats it)."""
    value = half.astype(np.int64) & ((1 << CODE_BITS) - 1)
    syndrome = np.zeros(len(value), dtype=np.int64)
    for p in range(CODE_BITS):
        syndrome ^= ((value >> p) & 1) * (p + 1)
    return value[:, None] ^ FLIPS[syndrome]


def _to_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, len(whole), 4096):
            batch = whole.slice(at, 4096)
            fp, rep = batch.column("fp").to_numpy(), batch.column("rep").to_numpy()
            unsigned = fp.view(np.uint64)
            for side in (0, 1):
                half = (unsigned >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)
                anchors = anchors_of(half)
                keep = np.ones(anchors.shape, dtype=bool)
                keep[:, 1:] = anchors[:, 1:] != anchors[:, :1]
                row, _ = np.nonzero(keep)
                columns = [pa.array(anchors[keep] | (side << CODE_BITS)), pa.array(fp[row]), pa.array(rep[row])]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "fp", "rep"])


class _Forest:
    """Union-find over the nodes of some links; keeps the links that joined two trees."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        top = x
        while (up := self.parent.get(top, top)) != top:
            top = up
        while (up := self.parent.get(x, x)) != top:
            self.parent[x], x = top, up
        return top

    def join(self, a: int, b: int) -> None:
        ra, rb = self.root(a), self.root(b)
        if ra != rb:
            self.parent[max(ra, rb)] = min(ra, rb)
            self.links.append((a, b))


def _links_of(key: np.ndarray, fp: np.ndarray, rep: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Forest of the links between rows of equal key (rows come sorted by key)."""
    fp = fp.view(np.uint64)  # a signed difference would be counted by its absolute value
    forest, here, lag = _Forest(), np.arange(len(key)), 1
    while len(here := here[here + lag < len(key)]):
        here = here[key[here] == key[here + lag]]
        near = here[np.bitwise_count(fp[here] ^ fp[here + lag]) <= max_bits]
        for a, b in zip(rep[near].tolist(), rep[near + lag].tolist(), strict=True):
            forest.join(a, b)
        lag += 1
    return forest.links


def _compare(max_bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("key", "fp", "rep")]
            now = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            cut = int(np.searchsorted(now[0] == now[0][-1], True)) if len(now[0]) else 0
            held = [x[cut:] for x in now]
            yield _as_links(_links_of(*[x[:cut] for x in now], max_bits))
        if held is not None:
            yield _as_links(_links_of(*held, max_bits))

    return work


def _as_links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def near_links(points: DataFrame, max_bits: int = MAX_BITS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links ``a, b`` (values of ``rep``) that connect all distinct fingerprints ``fp, rep`` at most ``max_bits`` apart.

    The links of an anchor are a spanning forest, so their number is below the number of copies.
    ``max_bits`` of 3 is the most for which one half differs in at most one bit.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be from 0 to 3")
    rows = points.filter("rep IS NOT NULL").mapInArrow(_to_anchors, "anchor bigint, fp bigint, rep bigint")
    counts = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counts = counts.select(F.col("anchor").alias("of"), F.ceil(F.col("n") / group_limit).cast("int").alias("blocks"))
    # Spark sizes the copies as if each point had one row, and would broadcast up to 32 times as many.
    met = rows.join(counts.hint("merge"), F.col("anchor") == F.col("of")).withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    )
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other"))
    dealt = met.select(F.when(F.col("blocks") == 1, F.col("anchor")).otherwise(key).alias("key"), "fp", "rep")
    parts = max(1, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    grouped = dealt.repartition(parts, "key").sortWithinPartitions("key")
    return grouped.mapInArrow(_compare(max_bits), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` of every row of ``docs`` (``doc_id``, ``text``).

    ``component_id`` is the smallest id reachable over links, the document included.  Texts without
    words (null, empty) share fingerprint 0.  Repeated rows stay.  A null id takes part through its
    fingerprint; a fingerprint that only null ids have links to nothing and has a null component.
    """
    prints = staged(fingerprints(docs, shingle), "simhash-prints")
    points = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-points")
    groups = components(near_links(points, max_bits))
    named = points.join(groups, F.col("rep") == F.col("node"), "left")
    named = named.select(F.col("fp").alias("of"), F.coalesce("component", "rep").alias("component_id"))
    # Files of repeated rows are small, and Spark would broadcast the rows for it.
    found = prints.join(named.hint("merge"), F.col("fp") == F.col("of"))
    return found.select("doc_id", "text_hash", "fp", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id; columns as they were.

    Repeated rows of that id stay once (of several texts under it, one).  Rows with a null id all
    stay: no other row can name them.
    """
    found = near_duplicates(docs, **options).filter("doc_id = component_id")
    stay = found.groupBy(F.col("doc_id").alias("_stays")).agg(F.min("text_hash").alias("_hash"))
    packed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_own"))
    named = (F.col("_id") == F.col("_stays")) & (F.col("_own") == F.col("_hash"))
    kept = packed.join(stay, named).dropDuplicates(["_stays"])
    return kept.select("doc.*").unionByName(docs.filter("doc_id IS NULL"))
