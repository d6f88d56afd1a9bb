"""Removal of every byte inside a long string that starts anywhere else, by suffix arrays of shards.

Strings that are equal must meet in one shard.  Every 200-byte window chooses an anchor by content
(see ``anchors``), so equal windows share the hash of their anchor.  The bytes of all windows that
choose an anchor are its context.  Contexts are counted by anchor and content; those whose anchor
stands anywhere else are fetched once each, dealt out by anchor, and joined to one text per shard.
Its suffix array comes from induced sorting; the permuted common prefixes show which windows equal
another one.  A context that several places share enters once, with its count.  An anchor with very
many different contexts is dealt into blocks, and each pair of blocks is a shard of its own.

Hashes only decide which contexts meet and which are one; what is repeated is read off the suffix array.
Rows are known by a 64-bit hash of id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.anchors import find_anchors
from tokenloom.llm.batches import signed, text_chunks
from tokenloom.llm.storage import staged
from tokenloom.llm.suffixes import permuted_prefixes, suffix_array

WINDOW = 200
SEED = 64
SHARD_BYTES = 2 << 20
BLOCK_CONTEXTS = 8192
FLUSH_ROWS = 100_000
SEPARATOR = b"\xff"  # never a byte of UTF-8

COUNTED = "anchor bigint, context bigint, n bigint, row_key bigint, low bigint, size int"


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("row_key"), F.col("doc_id").cast("bigint"), "text")


def _collapse(columns: list[np.ndarray]) -> list[np.ndarray]:
    """One row per (anchor, context), in that order, with the counts added up."""
    anchor, context, n = columns[:3]
    order = np.lexsort((context, anchor))
    anchor, context = anchor[order], context[order]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])]))
    return [anchor[first], context[first], np.add.reduceat(n[order], first), *[c[order][first] for c in columns[3:]]]


def _counted_contexts(window: int, seed: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0

        def flush() -> pa.RecordBatch:
            columns = _collapse([np.concatenate(c) for c in zip(*held, strict=True)])
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in COUNTED.split(", ")])

        for batch in batches:
            keys = batch.column("row_key").to_numpy()
            for chunk in text_chunks(batch.column("text")):
                for a in find_anchors(chunk, window, seed):
                    ones = np.ones(len(a.row), dtype=np.int64)
                    size = (a.high - a.low).astype(np.int32)
                    held.append([signed(a.seed), signed(a.context), ones, keys[chunk.first + a.row], a.low, size])
                    rows += len(a.row)
            if rows > FLUSH_ROWS:
                yield flush()
                held, rows = [], 0
        if held:
            yield flush()

    return work


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of anchor and context: one row per context whose anchor stands at two places or more.

    The last context of a batch waits for the next batch, with whether its anchor has come before.
    """
    names = [c.split()[0] for c in COUNTED.split(", ")]
    held, known = None, False

    def chosen(columns: list[np.ndarray], known: bool, final: bool) -> tuple[pa.RecordBatch, list[np.ndarray], bool]:
        columns = _collapse(columns)
        same = columns[0][1:] == columns[0][:-1]
        before, after = np.concatenate([[known], same]), np.concatenate([same, [False]])
        keep = (columns[2] > 1) | before | after
        upto = len(keep) if final else len(keep) - 1
        batch = pa.RecordBatch.from_arrays([pa.array(c[:upto][keep[:upto]]) for c in columns], names=names)
        return batch, [c[upto:] for c in columns], bool(before[-1])

    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(c).to_numpy() for c in names]
        columns = columns if held is None else [np.concatenate(x) for x in zip(held, columns, strict=True)]
        found, held, known = chosen(columns, known, False)
        yield found
    if held is not None:
        yield chosen(held, known, True)[0]


def recurring_contexts(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Contexts (see ``COUNTED``) whose anchor recurs, each with its count and one place where it stands."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = docs.select("row_key", "text").mapInArrow(_counted_contexts(window, seed), COUNTED)
    grouped = counted.repartition(parts, "anchor").sortWithinPartitions("anchor", "context")
    return staged(grouped.mapInArrow(_recurring, COUNTED), "substring-contexts")


def packed_texts(docs: DataFrame) -> DataFrame:
    """``row_key, doc_id, packed``: texts compressed before they are exchanged."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [compressor.compress(t) for c in text_chunks(batch.column("text")) for t in c.texts()]
            columns = [batch.column("row_key"), batch.column("doc_id"), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row_key", "doc_id", "packed"])

    return docs.mapInArrow(work, "row_key bigint, doc_id bigint, packed binary")


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


SHIPPED = "anchor bigint, context bigint, n bigint, row_key bigint, low bigint, bytes binary"


def context_bytes(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """The contexts with their bytes, each cut from one text that holds it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SHIPPED.split(", ")]
        for batch in batches:
            wanted = batch.column("wanted")
            for i in range(len(batch)):
                text = _unpack(batch.column("packed")[i].as_py())
                items = wanted[i].values.flatten()  # anchor, context, n, low, size
                low, size = items[3].to_pylist(), items[4].to_pylist()
                cut = pa.array([text[a : a + s] for a, s in zip(low, size, strict=True)], pa.binary())
                keys = pa.array(np.full(len(low), batch.column("row_key")[i].as_py()))
                yield pa.RecordBatch.from_arrays([*items[:3], keys, items[3], cut], names=names)

    wanted = contexts.groupBy(F.col("row_key").alias("_key")).agg(
        F.collect_list(F.struct("anchor", "context", "n", "low", "size")).alias("wanted")
    )
    met = packed_texts(docs).join(wanted, F.col("row_key") == F.col("_key")).select("row_key", "packed", "wanted")
    return met.mapInArrow(work, SHIPPED)


def repeated_windows(parts: list[bytes], counts: np.ndarray, places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and place of every window that equals another one, or one of another place.

    ``counts``: at how many places a part stands; ``places``: a number for its first byte, so that windows of
    different parts that are the same bytes of the same text have the same number.
    """
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    text = np.frombuffer(SEPARATOR.join(parts) + SEPARATOR, dtype=np.uint8)
    array = suffix_array(text)
    shared = permuted_prefixes(text, array)[array] >= window
    part = np.repeat(np.arange(len(parts)), lengths + 1)[array]
    inside = array - starts[part]
    whole = inside + window <= lengths[part]
    shared &= whole
    groups = np.flatnonzero(~shared)
    number = places[part] + inside
    low, high = np.minimum.reduceat(number, groups), np.maximum.reduceat(number, groups)
    many = np.maximum.reduceat(counts[part], groups)
    repeated = np.repeat((low != high) | (many > 1), np.diff(groups, append=len(array))) & whole
    return part[repeated], inside[repeated]


COVERED = "anchor bigint, context bigint, start int, stop int"


def _shards(window: int):
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        anchor, context, n, row_key, low, parts = (list(c) for c in zip(*rows, strict=True))
        text_of = {k: i for i, k in enumerate(dict.fromkeys(row_key))}
        places = np.array([text_of[k] << 36 for k in row_key], dtype=np.int64) + np.array(low, dtype=np.int64)
        part, inside = repeated_windows(parts, np.array(n, dtype=np.int64), places, window)
        order = np.lexsort((inside, part))
        part, inside = part[order], inside[order]
        if len(part):
            opens = np.concatenate([[True], (part[1:] != part[:-1]) | (inside[1:] > inside[:-1] + window)])
            first = np.flatnonzero(opens)
            last = np.append(first[1:], len(part)) - 1
            part, start, stop = part[first], inside[first], inside[last] + window
        else:
            start = stop = inside
        columns = [np.array(anchor, np.int64)[part], np.array(context, np.int64)[part], start.astype(np.int32), stop.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "context", "start", "stop"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, last, seen = 0, None, set()
        for batch in batches:
            for key, *row in zip(*[batch.column(c).to_pylist() for c in ("key", *[c.split()[0] for c in SHIPPED.split(", ")])], strict=True):
                if key != last:
                    if size >= SHARD_BYTES:
                        yield solve(rows)
                        rows, size = [], 0
                    last, seen = key, set()
                if row[1] in seen:  # fetched from several equal rows
                    continue
                seen.add(row[1])
                rows.append(tuple(row))
                size += len(row[-1])
        if rows:
            yield solve(rows)

    return work


def covered_parts(shipped: DataFrame, contexts: DataFrame, window: int = WINDOW, block: int = BLOCK_CONTEXTS) -> DataFrame:
    """Spans of the contexts that lie in repeated windows."""
    large = contexts.groupBy(F.col("anchor").alias("_of")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block)
    large = large.select("_of", F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    met = shipped.join(large, F.col("anchor") == F.col("_of"), "left")
    blocks = F.coalesce("_blocks", F.lit(1))
    own = F.pmod(F.xxhash64("context"), blocks).cast("int")
    met = met.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pair = F.xxhash64("anchor", F.least("_own", "_other"), F.greatest("_own", "_other"))
    dealt = met.select(F.when(F.col("_of").isNull(), F.col("anchor")).otherwise(pair).alias("key"), *[c.split()[0] for c in SHIPPED.split(", ")])
    parts = int(shipped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_shards(window), COVERED)


def _places(window: int, seed: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row_key").to_numpy()
            for chunk in text_chunks(batch.column("text")):
                for a in find_anchors(chunk, window, seed):
                    columns = [signed(a.seed), signed(a.context), keys[chunk.first + a.row], a.low]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "context", "row_key", "low"])

    return work


def removed_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``row_key, spans`` (unmerged ``start, stop`` bytes of repeated windows) of rows that have some."""
    contexts = recurring_contexts(docs, window, seed)
    covered = staged(covered_parts(context_bytes(docs, contexts), contexts, window).distinct(), "substring-covered")
    places = docs.select("row_key", "text").mapInArrow(_places(window, seed), "anchor bigint, context bigint, row_key bigint, low bigint")
    spans = places.join(covered, ["anchor", "context"]).select(
        "row_key", F.struct((F.col("low") + F.col("start")).alias("start"), (F.col("low") + F.col("stop")).alias("stop")).alias("span")
    )
    return spans.groupBy("row_key").agg(F.collect_list("span").alias("spans"))


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start: bigint, stop: bigint>>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        rows: list[list] = [[] for _ in names[1:]]
        spans = batch.column("spans")
        for i in range(len(batch)):
            text = _unpack(batch.column("packed")[i].as_py())
            kept, merged = hashlib.sha256(), []
            if spans[i].is_valid:
                start, stop = (c.to_numpy() for c in spans[i].values.flatten())
                order = np.argsort(start, kind="stable")
                start, reach = start[order], np.maximum.accumulate(stop[order])
                first = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
                last = np.append(first[1:], len(start)) - 1
                merged = list(zip(start[first].tolist(), reach[last].tolist(), strict=True))
            at = 0
            for a, b in merged:
                kept.update(text[at:a])
                at = b
            kept.update(text[at:])
            removed = sum(b - a for a, b in merged)
            found = (len(text), removed, len(merged), kept.hexdigest(), [{"start": a, "stop": b} for a, b in merged])
            for column, value in zip(rows, found, strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span_type]
        columns = [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of every row of ``docs`` (``doc_id``, ``text``).

    A byte goes if a string of ``window`` bytes around it starts anywhere else, in the same text or another;
    the first of the equal strings goes too.  Null text is empty.  Repeated rows are copies of each other.
    A text shorter than ``window`` loses nothing.  No rows give no rows.
    """
    if not 0 < seed <= window <= 4096:
        raise ValueError("seed must be at most the window, and the window below 4096")
    rows = keyed(docs)
    spans = removed_spans(rows, window, seed).withColumnRenamed("row_key", "_key")
    met = packed_texts(rows).join(spans, F.col("row_key") == F.col("_key"), "left")
    return met.select("doc_id", "packed", "spans").mapInArrow(_cut, RESULT)
