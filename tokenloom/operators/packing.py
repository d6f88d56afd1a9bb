"""Packing token sequences into fixed windows.

A sequence that occupies ``[s, e)`` of its shard's stream touches only the
windows ``floor((s - len) / step) + 1 .. floor((e - 1) / step)``.  Windows that
lie inside one sequence are cut on the spot and never shuffled; only the pieces
at the two ends of a sequence meet the pieces of its neighbours in one exchange,
grouped by (shard, window), a group of at most ``len`` tokens.

Byte tokens are cut from the bytes of the texts in numpy, a bounded piece of a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.arrays import exclusive_cumsum, let, slice_from
from tokenloom.functions.tokens import BYTE_BOS, BYTE_EOS
from tokenloom.operators.ordering import offset_by_id

CHUNK_BYTES = 1 << 19
CUT_TOKENS = 1 << 19


def _pieces(tokens: Column, start: Column, first: Column, last: Column, length: int, step: int) -> Column:
    """Parts of one sequence for the windows ``first..last``: (window, place in the stream, tokens)."""
    windows = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(
        windows,
        lambda w: let(
            F.greatest(w * step - start, F.lit(0)),
            lambda lo: F.struct(
                w.alias("window_id"),
                (start + lo).alias("at"),
                slice_from(
                    tokens, lo, F.least(w * step + length - start, F.size(tokens).cast("bigint")) - lo
                ).alias("piece"),
            ),
        ),
    )


def cut_windows(
    df: DataFrame, tokens: str, start: str, length: int, step: int, shard: Sequence[str] = ()
) -> DataFrame:
    """Complete windows ``[k * step, k * step + length)`` of each shard's stream.

    ``start`` is the place of the sequence in the stream.  Windows the stream
    does not fill are dropped.
    """
    if length < 1 or step < 1:
        raise ValueError("window length and step must be positive")
    s, t = F.col(start).cast("bigint"), F.col(tokens)

    def explode(ranges) -> DataFrame:
        """One row per piece; ``ranges`` maps (first place, last place + 1) to window ranges."""
        parts = let(
            F.struct(t.alias("t"), s.alias("s")),
            lambda x: let(
                x["s"] + F.size(x["t"]),
                lambda e: F.flatten(
                    F.array(*[_pieces(x["t"], x["s"], a, b, length, step) for a, b in ranges(x["s"], e)])
                ),
            ),
        )
        return df.select(*shard, F.explode(parts).alias("p")).select(*shard, "p.*")

    def first_touched(s: Column) -> Column:
        return F.greatest(F.floor((s - length) / step) + 1, F.lit(0)).cast("bigint")

    def last_touched(e: Column) -> Column:
        return F.floor((e - 1) / step).cast("bigint")

    def first_inner(s: Column) -> Column:
        return F.ceil(s / step).cast("bigint")

    def last_inner(s: Column, e: Column) -> Column:
        return F.greatest(F.floor((e - length) / step).cast("bigint"), first_inner(s) - 1)

    inner = explode(lambda s, e: [(first_inner(s), last_inner(s, e))]).select(
        *shard, "window_id", F.col("piece").alias("window")
    )
    edges = explode(
        lambda s, e: [
            (first_touched(s), F.least(first_inner(s) - 1, last_touched(e))),
            (last_inner(s, e) + 1, last_touched(e)),
        ]
    )
    return inner.unionByName(_joined(edges, length, shard))


def _joined(edges: DataFrame, length: int, shard: Sequence[str]) -> DataFrame:
    """Windows of pieces ``window_id, at, piece`` that together fill them."""
    parts = edges.groupBy(*shard, "window_id").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("parts"))
    return parts.select(*shard, "window_id", F.flatten("parts.piece").alias("window")).filter(F.size("window") == length)


def _byte_chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a batch whose ``text`` is not null, their byte tokens on end, and where each row's begin."""
    texts = batch.column("text").cast(pa.large_binary())
    rows = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
    texts = texts.drop_null()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data, at = np.frombuffer(texts.buffers()[2] or b"", np.uint8), 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1)
        to = min(to, len(rows))
        bounds = offsets[at : to + 1] - offsets[at] + 2 * np.arange(to - at + 1)
        tokens = np.empty(bounds[-1], np.int32)
        inside = np.ones(len(tokens), bool)
        inside[bounds[:-1]] = inside[bounds[1:] - 1] = False
        tokens[inside] = data[offsets[at] : offsets[to]]
        tokens[bounds[:-1]], tokens[bounds[1:] - 1] = BYTE_BOS, BYTE_EOS
        yield rows[at:to], tokens, bounds
        at = to


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and window of every window in ``first..last`` of each row."""
    n = np.maximum(last - first + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    return row, first[row] + np.arange(len(row)) - (np.cumsum(n) - n)[row]


def _byte_pieces(df: DataFrame, length: int, step: int, shard: Sequence[str], whole: bool) -> DataFrame:
    """``window_id, at, piece`` of the byte tokens of ``text`` that begin at ``s``: the windows that lie inside a
    row (``whole``), or the pieces at its ends."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column("s").to_numpy(zero_copy_only=False)
            for rows, tokens, bounds in _byte_chunks(batch):
                s, n = starts[rows], np.diff(bounds)
                first = -(-s // step)
                last = np.maximum((s + n - length) // step, first - 1)
                if whole:
                    row, window = _ranges(first, last)
                else:
                    touched = (s + n - 1) // step
                    before = _ranges(np.maximum((s - length) // step + 1, 0), np.minimum(first - 1, touched))
                    row, window = np.concatenate([before, _ranges(last + 1, touched)], axis=1)
                low = np.maximum(window * step - s[row], 0)
                size = np.minimum(window * step + length - s[row], n[row]) - low
                many = max(1, CUT_TOKENS // length)
                for a in range(0, len(row), many):
                    r, lo, k = row[a : a + many], low[a : a + many], size[a : a + many]
                    ends = np.cumsum(k)
                    index = np.repeat(bounds[r] + lo - (ends - k), k) + np.arange(ends[-1])
                    pieces = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(tokens[index]))
                    of = pa.array(rows[r])
                    columns = [batch.column(c).take(of) for c in shard]
                    columns += [pa.array(window[a : a + many]), pa.array(s[r] + lo), pieces]
                    yield pa.RecordBatch.from_arrays(columns, names=[*shard, "window_id", "at", "piece"])

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in shard)
    rows = df.select(*shard, F.col("s").cast("bigint"), "text")
    return rows.mapInArrow(work, f"{kinds}window_id bigint, at bigint, piece array<int>")


def cut_byte_windows(
    df: DataFrame, text: str, start: str, length: int, step: int, shard: Sequence[str] = (), held: DataFrame | None = None
) -> DataFrame:
    """As ``cut_windows``, of the byte tokens of ``text`` with both special ids; a null text has no tokens.

    ``held`` has pieces of the stream, ``s, t`` (place and tokens), each shorter than a window.
    """
    if length < 1 or step < 1:
        raise ValueError("window length and step must be positive")
    rows = df.select(*shard, F.col(start).alias("s"), F.col(text).alias("text"))
    inner = _byte_pieces(rows, length, step, shard, True).select(*shard, "window_id", F.col("piece").alias("window"))
    edges = _byte_pieces(rows, length, step, shard, False)
    if held is not None:
        first = F.greatest(F.floor((F.col("s") - length) / step) + 1, F.lit(0)).cast("bigint")
        last = F.floor((F.col("s") + F.size("t") - 1) / step).cast("bigint")
        parts = _pieces(F.col("t"), F.col("s"), first, last, length, step)
        edges = edges.unionByName(held.filter(F.size("t") > 0).select(*shard, F.explode(parts).alias("p")).select(*shard, "p.*"))
    return inner.unionByName(_joined(edges, length, shard))


def pack_tokens(
    df: DataFrame,
    tokens: str,
    n_tokens: Column,
    key: str,
    seq_len: int,
    n_views: int,
    shard: Sequence[str] = (),
) -> DataFrame:
    """Windows of ``seq_len + n_views - 1`` tokens advancing by ``seq_len``, per shard in id order.

    ``n_tokens`` gives a sequence's length without building its tokens, so the
    offsets are computed from a narrow scan.
    """
    placed = offset_by_id(df, n_tokens, key, "_start", shard)
    return cut_windows(placed, tokens, "_start", seq_len + n_views - 1, seq_len, shard)


def pack_text(
    df: DataFrame,
    text: str,
    build: Column | None,
    n_tokens: Column,
    key: str,
    seq_len: int,
    n_views: int,
    shard: Sequence[str] = (),
    step: int | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """As ``pack_tokens``, but the exchange carries the text and tokens are built after it.

    ``build`` None stands for the byte tokens of the text.
    """
    placed = offset_by_id(df.select(*shard, key, text), n_tokens, key, "_start", shard, ids)
    if build is None:
        return cut_byte_windows(placed, text, "_start", seq_len + n_views - 1, step or seq_len, shard)
    built = placed.select(*shard, "_start", build.alias("tokens"))
    return cut_windows(built, "tokens", "_start", seq_len + n_views - 1, step or seq_len, shard)


def sliding_examples(
    df: DataFrame,
    text: str,
    build: Column | None,
    n_tokens: Column,
    key: str,
    length: int,
    stride: int,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Examples over the whole stream: input ``[i, i + L)`` and target ``[i + 1, i + L + 1)``
    for ``i`` in ``range(0, n - L, stride)``."""
    windows = pack_text(df, text, build, n_tokens, key, length, 2, step=stride, ids=ids)
    return windows.select(
        (F.col("window_id") * stride).alias("start"),
        F.slice("window", 1, length).alias("input"),
        F.slice("window", 2, length).alias("target"),
    )


def local_ids(lengths: Column) -> Column:
    """(segment, position in segment) of every packed token."""
    return F.flatten(
        F.transform(
            lengths,
            lambda n, i: F.transform(
                F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>")),
                lambda p: F.struct(i.alias("segment"), p.alias("position")),
            ),
        )
    )


def visible_ranges(lengths: Column) -> Column:
    """The same mask as one range per query: keys ``[first, q]`` of the packed row are visible.

    Listing the pairs would need n(n + 1) / 2 rows per segment; a range per
    query carries the same information in n rows.
    """
    return F.transform(
        local_ids(lengths),
        lambda x, q: F.struct(
            x["segment"].alias("segment"),
            q.alias("q"),
            (q - x["position"]).alias("first_kv"),
            (x["position"] + 1).alias("n_visible"),
        ),
    )


def segment_sums(lengths: Column) -> Column:
    """What the local ids and visible ranges of each segment that has tokens come to, from its length alone.

    A segment of n tokens that starts at s holds positions 0 to n - 1; its queries run from s to s + n - 1 and
    see n (n + 1) / 2 pairs, the first key being s.
    """
    zipped = F.arrays_zip(lengths.alias("n"), exclusive_cumsum(lengths).alias("start"))

    def sums(x: Column, i: Column) -> Column:
        n, start = x["n"].cast("bigint"), x["start"].cast("bigint")
        return F.struct(
            i.alias("segment"),
            n.alias("n_tokens"),
            F.floor(n * (n - 1) / 2).cast("bigint").alias("position_sum"),
            start.cast("int").alias("first_kv"),
            (start + n - 1).cast("int").alias("last_q"),
            F.floor(n * (n + 1) / 2).cast("bigint").alias("n_pairs"),
        )

    return F.filter(F.transform(zipped, sums), lambda s: s["n_tokens"] > 0)
