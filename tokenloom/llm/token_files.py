"""Token ids of documents as ORC files: written in id order, read by stripe, pruned by metadata.

A row of the files holds up to ``PIECE`` ids of one document, so no row and no column batch of a reader
grows with a text.  ORC run-length encodes the integers, keeps a row index with minima and maxima, and a
Bloom filter on ``doc_id``: a lookup by id reads the row groups that may hold it.  Stripes are bounded, and
a reader takes them in parallel.  Files follow the ids (``part`` is a file's number), documents without an
id first; equal ids follow a hash of their texts.

Encoding works on segments: a text is cut before white space behind another character and before
punctuation behind a letter or digit, where the pattern of byte-level tokenizers always cuts too.  Each
different segment is encoded once in a while; tokenizers of another make get whole texts.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.batches import SPACE, Chunk, SpanHash, text_chunks
from tokenloom.llm.storage import staged

PIECE = 4096
STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1000
KNOWN = 1 << 18
LONG_BYTES = 1 << 22
JOINED = 1000
WINDOW = 1 << 20
GROUP = 1 << 17
BLANK = bytes([0x20, *range(0x09, 0x0E)])
INK = bytes(range(0x21, 0x7F))
SOLID, LEAD, WORD, STOP = (np.zeros(256, dtype=bool) for _ in range(4))
SOLID[0x21:0x7F] = True
LEAD[0xC3:0xE0] = True
LEADS = {bytes([b]) for b in range(0xC3, 0xE0)}
WORD[[*b"0123456789", *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
STOP[[*b".,;:!?"]] = True
FILE_FIELDS = "doc_id bigint, part int, doc_start bigint, n_tokens bigint, piece int, ids array<int>"


def cuts_before_spaces(made: dict) -> bool:
    """Whether a tokenizer (its JSON) never lets a token cross a place of ``cut_places``."""
    cutter, model = made.get("pre_tokenizer") or {}, made["model"]
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])) for t in made["added_tokens"])
    bytewise = cutter.get("type") == "ByteLevel" and not cutter["add_prefix_space"] and cutter.get("use_regex", True)
    return bool(bytewise and plain and model["type"] == "BPE" and not model.get("dropout") and not made["normalizer"])


def cut_places(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where segments begin in UTF-8 texts on end: at texts, at white space behind a character that is none
    (ASCII, or of two bytes), and at one of ``.,;:!?`` behind a letter or digit."""
    places = np.zeros(len(data), dtype=bool)
    places[bounds[:-1][bounds[1:] > bounds[:-1]]] = True
    for at in range(0, len(data), WINDOW):
        low = max(at - 2, 0)
        d = data[low : at + WINDOW]
        pair = np.zeros(len(d), dtype=bool)  # ends of two-byte characters, from U+00C0 on
        pair[1:] = LEAD[d[:-1]] & (d[1:] >= 0x80)
        latin = np.zeros(len(d), dtype=bool)
        latin[1:] = (d[:-1] == 0xC3) & (d[1:] >= 0x80) & (d[1:] != 0x97) & (d[1:] != 0xB7)
        found = np.zeros(len(d), dtype=bool)
        found[1:] = SPACE[d[1:]] & (SOLID[d[:-1]] | pair[:-1])
        found[1:] |= STOP[d[1:]] & (WORD[d[:-1]] | latin[:-1])
        places[at : at + WINDOW] |= found[at - low :]
    return np.flatnonzero(places)


def repeats(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different span, and for each span the number of that place.

    Spans are told apart by hashes; if bytes of equal hashes differ, or spans are very long, each span counts
    as different.
    """
    if len(data) <= LONG_BYTES:
        _, one, which = np.unique(SpanHash(data).of(start, end), return_index=True, return_inverse=True)
        first, size = start[one[which]], end - start
        if (end[one[which]] - first == size).all() and (data[np.repeat(first - start, size) + np.arange(len(data))] == data).all():
            return one, which
    return np.arange(len(start)), np.arange(len(start))


class Encoder:
    """Ids of texts without special tokens, by the tokenizers library."""

    def __init__(self, made: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(made)
        self.cuts = cuts_before_spaces(json.loads(made))
        names = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(names.values(), default=0) + 1, dtype=np.int64)
        if self.cuts:  # one character of a name stands for one byte; added tokens stand for themselves
            for name, at in names.items():
                self.lengths[at] = len(name)
            for at, token in self.tokenizer.get_added_tokens_decoder().items():
                self.lengths[at] = len(token.content.encode())
        self._forget()

    def _forget(self) -> None:
        self.at: dict[bytes, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)
        self.ends = np.zeros(1, dtype=np.int64)
        self.met = np.zeros(0, dtype=np.int32)

    def _keep_repeated(self) -> None:
        """Keep only what was met in two groups or more since the last time: words that come once fill the memory."""
        kept = np.flatnonzero(self.met > 1)
        if len(kept) > KNOWN // 2:
            return self._forget()
        names, first = list(self.at), self.ends[kept]
        size = self.ends[kept + 1] - first
        before = np.cumsum(size) - size
        self.at = {names[k]: i for i, k in enumerate(kept.tolist())}
        self.ids = self.ids[np.repeat(first - before, size) + np.arange(size.sum())]
        self.ends = np.concatenate([[0], np.cumsum(size)])
        self.met = np.zeros(len(kept), dtype=np.int32)

    def _whole(self, texts: Sequence[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, np.int32) for e in found]

    def _learn(self, segments: list[bytes]) -> None:
        """Segments that begin with white space and do not end in it are encoded on end, several at a time."""
        chain, alone = [], []
        for s in segments:
            (chain if s[0] in BLANK and (s[-1] in INK or s[-2:-1] in LEADS) else alone).append(s)
        ends = np.cumsum(np.fromiter(map(len, chain), np.int64, len(chain)))
        groups = np.searchsorted(ends, np.arange(JOINED, (ends[-1] if len(ends) else 0) + JOINED, JOINED))
        joined = [b"".join(chain[a:b]) for a, b in zip([0, *groups], [*groups, len(chain)], strict=True) if b > a]
        ids = np.concatenate([np.zeros(0, np.int32), *self._whole(joined)])
        cuts = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
        parts = self._whole(alone)
        cuts = np.concatenate([cuts, len(ids) + np.cumsum([len(p) for p in parts], dtype=np.int64)])
        known = len(self.at)
        self.at.update(zip(chain + alone, range(known, known + len(segments)), strict=True))
        self.ids = np.concatenate([self.ids, ids, *parts])
        self.ends = np.concatenate([self.ends, self.ends[-1] + cuts])
        self.met = np.concatenate([self.met, np.zeros(len(segments), np.int32)])

    def _segments(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments on end, and how many each has."""
        new = set(segments).difference(self.at)
        if len(self.at) + len(new) > KNOWN:
            self._keep_repeated()
            new = set(segments).difference(self.at)
        held, n_ids = len(self.at), len(self.ids)
        self._learn(list(new))
        index = np.fromiter(map(self.at.__getitem__, segments), np.int64, len(segments))
        self.met[index] += 1
        first, size = self.ends[index], self.ends[index + 1] - self.ends[index]
        before = np.cumsum(size) - size
        ids = self.ids[np.repeat(first - before, size) + np.arange(size.sum())]
        if sum(map(len, new)) > LONG_BYTES:  # texts without spaces are not worth keeping
            for s in new:
                del self.at[s]
            self.ids, self.ends, self.met = self.ids[:n_ids], self.ends[: held + 1], self.met[:held]
        return ids, size

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a chunk on end, and where each text's begin (with the end of the last)."""
        if not self.cuts:
            found = self._whole(chunk.texts())
            return np.concatenate([np.zeros(0, np.int32), *found]), np.cumsum([0, *map(len, found)])
        starts = cut_places(chunk.data, chunk.bounds)
        stops = np.append(starts[1:], len(chunk.data))
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(starts), GROUP):
            low, high = starts[at : at + GROUP], stops[at : at + GROUP]
            data, low, high = chunk.data[low[0] : high[-1]], low - low[0], high - low[0]
            raw, (one, which) = data.tobytes(), repeats(data, low, high)
            found, each = self._segments([raw[a:b] for a, b in zip(low[one].tolist(), high[one].tolist(), strict=True)])
            size = each[which]
            first = (np.cumsum(each) - each)[which]
            ids.append(found[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())])
            sizes.append(size)
        before = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return np.concatenate(ids), before[np.searchsorted(starts, chunk.bounds)]


@lru_cache(maxsize=1)
def encoder(made: str) -> Encoder:
    return Encoder(made)


def token_rows(docs: DataFrame, tokenizer: str, end_id: int, parts: int) -> DataFrame:
    """The rows of the files (``FILE_FIELDS``), in file order within ``parts`` partitions."""
    with open(tokenizer, encoding="utf-8") as f:
        made = docs.sparkSession.sparkContext.broadcast(f.read())  # of the size of the vocabulary

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, start = encoder(made.value).encode, 0
        for batch in batches:
            ids, part = batch.column("doc_id"), batch.column("part")
            for chunk in text_chunks(batch.column("text")):
                found, edges = encode(chunk)
                flat = np.insert(found, edges[1:], end_id)
                edges = edges + np.arange(len(edges))
                sizes, starts = np.diff(edges), start + edges
                start = int(starts[-1])
                pieces = -(-sizes // PIECE)
                row = np.repeat(np.arange(chunk.rows), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                begin = edges[row] + piece * PIECE
                offsets = pa.array(np.append(begin, len(flat)).astype(np.int32))
                at = pa.array(chunk.first + row)
                columns = [ids.take(at), part.take(at), pa.array(starts[row]), pa.array(sizes[row])]
                columns += [pa.array(piece.astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(flat))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "doc_start", "n_tokens", "piece", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("_hash"), F.spark_partition_id().alias("_from"))
    ranged = rows.repartitionByRange(parts, "doc_id", "_hash", "_from").sortWithinPartitions("doc_id", "_hash")
    return ranged.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(work, FILE_FIELDS)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, files: int | None = None) -> None:
    """Write the ids of all ``docs`` (``doc_id, text``), each document's followed by ``end_id``, below ``folder``.

    Null and empty texts have the end id alone.  Documents without an id come first, equal ids stand together
    in the order of a hash of their texts, and repeated rows are all written.  Other columns are not read; an
    empty table leaves a folder with no rows.  ``files`` is at most the number of files (default: the shuffle
    partitions).  Rows are dealt by id, text and place of reading, so no id or text is one task's alone.
    """
    parts = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = token_rows(docs, tokenizer, end_id, parts).write.option("compression", "zstd")
    writer = writer.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
    writer = writer.option("orc.stripe.size", str(STRIPE_BYTES)).option("orc.row.index.stride", str(INDEX_STRIDE))
    writer.orc(f"{folder}/ids")
    first = token_files(docs.sparkSession, folder).filter("piece = 0")
    totals = first.groupBy("part").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    based = totals.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    based.coalesce(1).write.orc(f"{folder}/parts")


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the files, as they are."""
    return spark.read.schema(FILE_FIELDS).orc(f"{folder}/ids")


def token_parts(spark: SparkSession, folder: str) -> DataFrame:
    """``part, n_docs, n_tokens, base``: a row for each file with documents; ``base``: ids of all files before it."""
    return spark.read.schema("part int, n_docs bigint, n_tokens bigint, base bigint").orc(f"{folder}/parts")


POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2), bits reflected, modulo that of CRC-32."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


@lru_cache(maxsize=4096)
def _shift(n_bytes: int) -> int:
    """``x ** (8 * n_bytes)``."""
    out, square = 1 << 31, 1 << 23
    while n_bytes:
        if n_bytes & 1:
            out = _times(square, out)
        square, n_bytes = _times(square, square), n_bytes >> 1
    return out


def joined_crc32(pieces: Sequence[tuple[int, int]]) -> int:
    """The CRC-32 of the concatenation of pieces, given ``(crc, n_bytes)`` of each."""
    total = 0
    for crc, n_bytes in pieces:
        total = _times(_shift(n_bytes), total) ^ crc
    return total


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` runs over the ids as unsigned 32-bit
    little-endian integers.  Documents of several pieces are joined by the checksums of the pieces.
    """

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), dtype="<u4")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            sums = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            columns = [batch.column(c) for c in ("doc_id", "part", "doc_start", "n_tokens", "piece")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], names=names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_tokens = batch.column("n_tokens").to_pylist()
            sums = []
            for n, crcs in zip(n_tokens, batch.column("crcs").to_pylist(), strict=True):
                sizes = [PIECE] * (len(crcs) - 1) + [n - PIECE * (len(crcs) - 1)]
                sums.append(joined_crc32([(c["crc"], 4 * s) for c, s in zip(crcs, sizes, strict=True)]))
            columns = [batch.column(c) for c in ("doc_id", "part", "doc_start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], names=[*names[:4], "crc"])

    names = ["doc_id", "part", "doc_start", "n_tokens", "piece", "crc"]
    fields = "doc_id bigint, part int, doc_start bigint, n_tokens bigint"
    rows = staged(token_files(spark, folder).mapInArrow(crc, f"{fields}, piece int, crc bigint"), "token-digests")
    whole = rows.filter(F.col("n_tokens") <= PIECE).drop("piece")
    cut = rows.filter(F.col("n_tokens") > PIECE).groupBy("part", "doc_start").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("piece", "crc"))).alias("crcs")
    )
    found = whole.unionByName(cut.mapInArrow(join, f"{fields}, crc bigint"))
    placed = found.join(token_parts(spark, folder).select("part", "base"), "part")
    return placed.select("doc_id", (F.col("base") + F.col("doc_start")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"))


def read_documents(spark: SparkSession, folder: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """``doc_id, start, piece, ids``: pieces of the documents (of the given ids, which prune stripes and row groups)."""
    rows = token_files(spark, folder)
    if doc_ids is not None:
        rows = rows.filter(F.col("doc_id").isin([int(d) for d in doc_ids]))
    placed = rows.join(token_parts(spark, folder).select("part", "base"), "part")
    return placed.select("doc_id", (F.col("base") + F.col("doc_start")).alias("start"), "piece", "ids")


def read_span(spark: SparkSession, folder: str, start: int, stop: int) -> DataFrame:
    """``at, ids``: the ids at positions ``start <= at < stop`` of the whole, in pieces.

    Files outside are dropped by ``part``, row groups by ``doc_start``; both stand in the metadata.
    """
    parts = token_parts(spark, folder).filter((F.col("base") < stop) & (F.col("base") + F.col("n_tokens") > start))
    wanted = parts.select("part", "base").collect()  # at most one row a file
    rows = token_files(spark, folder).filter(F.col("part").isin([r["part"] for r in wanted]))
    least = min((r["base"] for r in wanted), default=0)
    rows = rows.filter(F.col("doc_start") < stop - least)
    placed = rows.join(parts.select("part", "base"), "part")
    at = F.col("base") + F.col("doc_start") + F.col("piece").cast("bigint") * PIECE
    placed = placed.select(at.alias("_at"), "ids").filter((F.col("_at") < stop) & (F.col("_at") + F.size("ids") > start))
    skip = F.greatest(F.lit(start) - F.col("_at"), F.lit(0))
    size = F.least(F.lit(stop) - F.col("_at"), F.size("ids")) - skip
    return placed.select((F.col("_at") + skip).alias("at"), F.slice("ids", (skip + 1).cast("int"), size.cast("int")).alias("ids"))
