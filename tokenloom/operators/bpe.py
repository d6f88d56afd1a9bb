"""Byte-pair vocabularies: training over distinct words, and encoding.

A word is an array of symbols, so no character of a text has a meaning of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.arrays import let
from tokenloom.functions.bytechars import byte_chars, from_byte_chars, to_byte_chars
from tokenloom.functions.text import pretokens
from tokenloom.operators.rank_files import row_runs
from tokenloom.session import written

Merge = tuple[str, str]
DENSE_SYMBOLS = 1024  # up to so many symbols a task has a counter for every pair


def initial_symbols(word: Column, alphabet: Sequence[str] | None = None) -> Column:
    """One symbol per character; characters outside the alphabet fall back to byte symbols."""
    chars = F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0))
    if alphabet is None:
        return chars
    known = F.array(*[F.lit(c) for c in alphabet])
    as_bytes = lambda c: F.transform(
        F.regexp_extract_all(F.hex(c.cast("binary")), F.lit(".."), F.lit(0)),
        lambda h: F.concat(F.lit("<0x"), h, F.lit(">")),
    )
    return F.flatten(
        F.transform(chars, lambda c: F.when(F.array_contains(known, c), F.array(c)).otherwise(as_bytes(c)))
    )


def adjacent(symbols: Column) -> Column:
    """``left, right`` of every pair of neighbours."""
    n = F.greatest(F.size(symbols) - 1, F.lit(0))
    return F.arrays_zip(F.slice(symbols, F.lit(1), n).alias("left"), F.slice(symbols, F.lit(2), n).alias("right"))


def pair_counts(words: DataFrame) -> DataFrame:
    """Adjacent pairs of ``words(symbols, cnt)``, weighted by the word counts."""
    pairs = words.select("cnt", F.explode(adjacent(F.col("symbols"))).alias("p"))
    return pairs.groupBy("p.left", "p.right").agg(F.sum("cnt").alias("cnt"))


def pair_words(words: DataFrame) -> DataFrame:
    """As ``pair_counts``, with the number of distinct words that hold the pair.

    A word is one row, so a pair's places are counted inside it before anything is exchanged.
    """
    inside = let(
        adjacent(F.col("symbols")),
        lambda pairs: F.transform(
            F.array_distinct(pairs),
            lambda p: F.struct(p["left"].alias("left"), p["right"].alias("right"), F.size(F.filter(pairs, lambda q: q == p)).alias("times")),
        ),
    )
    pairs = words.select("cnt", F.explode(inside).alias("p"))
    return pairs.groupBy("p.left", "p.right").agg(
        F.sum(F.col("cnt") * F.col("p.times")).alias("cnt"), F.count(F.lit(1)).alias("n_words")
    )


def best_pair(counts: DataFrame) -> DataFrame:
    """Most frequent pair; ties go to the smaller pair."""
    return counts.orderBy(F.desc("cnt"), "left", "right").limit(1)


def independent_head(ranked: Sequence[tuple[str, str, int]], existing: set[str], complete: bool) -> list[Merge]:
    """How many of the ranked pairs one-merge-at-a-time training would take in this order.

    Taking a pair only changes pairs that share a symbol with it, and a new pair
    counts at most as much as such a neighbour.  So the next pair in the ranking
    is also the next merge while it shares no symbol with those taken and no
    neighbour has the same count.  A merge whose result is a symbol already
    (reached by another path) ends the head, because counts then add up.
    """
    usable = list(ranked)
    if not complete and len({n for *_, n in usable}) > 1:
        lowest = usable[-1][2]  # pairs of this count may be missing
        usable = [r for r in usable if r[2] > lowest]
    elif not complete:
        usable = usable[:1]
    taken: list[Merge] = []
    touched: set[str] = set()
    for left, right, n in usable:
        neighbour_tie = any(m == n and (touched & {a, b}) and (a, b) not in taken for a, b, m in ranked)
        if taken and (neighbour_tie or touched & {left, right}):
            break
        taken.append((left, right))
        touched |= {left, right, left + right}
        if left + right in existing:
            break
    return taken


def symbol_names(words: DataFrame) -> list[str]:
    """Different symbols of ``words(symbols)``; as many as code points at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            new = set(pc.unique(batch.column(0).flatten()).to_pylist()) - seen
            seen |= new
            yield pa.record_batch({"symbol": pa.array(sorted(new), pa.string())})

    return sorted(r[0] for r in words.select("symbols").mapInArrow(run, "symbol string").distinct().collect())


def coded(words: DataFrame, names: Sequence[str]) -> DataFrame:
    """``ids array<int>, cnt`` of ``words(symbols, cnt)``: the places of the symbols among ``names``."""
    model = words.sparkSession.sparkContext.broadcast(list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(model.value, pa.string())
        for batch in batches:
            symbols = batch.column("symbols")
            values = pc.index_in(symbols.flatten(), known)
            ends = np.append(0, np.cumsum(pc.list_value_length(symbols).fill_null(0).to_numpy(zero_copy_only=False)))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([ids, batch.column("cnt")], names=["ids", "cnt"])

    return words.select("symbols", F.col("cnt").cast("bigint")).mapInArrow(run, "ids array<int>, cnt bigint")


def _merged(ids: np.ndarray, word: np.ndarray, merges: Sequence[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of words on end, and the word of each, after merges ``left, right, new``, the first ones first."""
    for left, right, new in merges:
        at = np.flatnonzero((ids[:-1] == left) & (ids[1:] == right) & (word[:-1] == word[1:]))
        if left == right and len(at):  # of places in a row every second one, from the first
            opens = np.append(True, at[1:] != at[:-1] + 1)
            first = np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
        if len(at):
            ids = ids.copy()
            ids[at] = new
            stay = np.ones(len(ids), dtype=bool)
            stay[at + 1] = False
            ids, word = ids[stay], word[stay]
    return ids, word


def _merged_batches(batches: Iterator[pa.RecordBatch], merges: Sequence[tuple[int, int, int]]):
    """Symbols, the word of each and the counts of the words of each batch, after the merges."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column("ids")).to_numpy(zero_copy_only=False)
        ids, word = batch.column("ids").flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
        yield *_merged(ids, word, merges), batch.column("cnt")


def rewritten(words: DataFrame, merges: Sequence[tuple[int, int, int]]) -> DataFrame:
    """``words(ids, cnt)`` after the merges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, word, counts in _merged_batches(batches, merges):
            ends = np.searchsorted(word, np.arange(len(counts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), counts], names=["ids", "cnt"])

    return words.mapInArrow(run, "ids array<int>, cnt bigint")


def _count_pairs(batches: Iterator[pa.RecordBatch], merges, names: Sequence[str], dense_symbols: int):
    size = len(names)
    codes, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    dense = np.zeros(size * size if size <= dense_symbols else 0, np.int64)
    for ids, word, counts in _merged_batches(batches, merges):
        same = word[:-1] == word[1:]
        pairs = ids[:-1][same].astype(np.int64) * size + ids[1:][same]
        weights = counts.to_numpy()[word[:-1][same]]
        if len(dense):
            dense += np.bincount(pairs, weights=weights, minlength=len(dense)).astype(np.int64)
            continue
        found, where = np.unique(np.concatenate([codes, pairs]), return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, where, np.concatenate([sums, weights]))
        codes, sums = found, total
    if len(dense):
        codes = np.flatnonzero(dense)
        sums = dense[codes]
    texts = pa.array(names, pa.string())
    left, right = (texts.take(pa.array(x)) for x in (codes // max(size, 1), codes % max(size, 1)))
    yield pa.RecordBatch.from_arrays([left, right, pa.array(sums)], names=["left", "right", "cnt"])


def merged_pair_counts(words: DataFrame, merges: Sequence[tuple[int, int, int]], names: Sequence[str]) -> DataFrame:
    """``left, right, cnt`` of the pairs of ``words(ids, cnt)`` after the merges; a task adds up its words."""
    model = words.sparkSession.sparkContext.broadcast(list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _count_pairs(batches, merges, model.value, DENSE_SYMBOLS)

    return words.mapInArrow(run, "left string, right string, cnt bigint").groupBy("left", "right").agg(F.sum("cnt").alias("cnt"))


def train_merges(
    words: DataFrame, n_merges: int, min_count: int = 1, candidates: int = 256, passes_per_checkpoint: int = 8
) -> list[Merge]:
    """Ordered merges of ``words(symbols, cnt)``.

    A pass counts all pairs, each task in numpy over the symbol numbers of its words, fetches the ``candidates`` best
    ones and takes every merge that is certain to come next.  The words are written anew every
    ``passes_per_checkpoint`` passes; in between a pass merges what was taken since.
    """
    # a fixed number of partitions: the table is small in bytes but its passes are CPU work
    tasks = words.sparkSession.sparkContext.defaultParallelism
    start = written(words.select("symbols", "cnt").repartition(tasks), "bpe-symbols")
    names = symbol_names(start)
    state = written(coded(start, names), "bpe-words")
    number = {name: i for i, name in enumerate(names)}
    merges: list[Merge] = []
    pending: list[tuple[int, int, int]] = []
    passes = 0
    existing: set[str] = set()
    while len(merges) < n_merges:
        counted = merged_pair_counts(state, list(pending), names).filter(F.col("cnt") >= min_count)
        rows = counted.orderBy(F.desc("cnt"), "left", "right").select("left", "right", "cnt").limit(candidates).collect()
        head = independent_head([tuple(r) for r in rows], existing, len(rows) < candidates)
        head = head[: n_merges - len(merges)]
        if not head:
            break
        for left, right in head:
            if left + right not in number:
                number[left + right] = len(names)
                names.append(left + right)
            pending.append((number[left], number[right], number[left + right]))
        merges += head
        existing |= {a + b for a, b in head}
        passes += 1
        if passes % passes_per_checkpoint == 0 and len(merges) < n_merges:
            state = written(rewritten(state, list(pending)), "bpe-words")
            pending = []
    return merges


def merges_frame(spark, merges: Sequence[Merge]) -> DataFrame:
    rows = [(i, a, b) for i, (a, b) in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left string, right string")


def byte_vocab(merges: Sequence[Merge]) -> list[str]:
    """Pieces of a byte-level vocabulary in id order: the 256 bytes, then the merges."""
    return list(dict.fromkeys(byte_chars() + [a + b for a, b in merges]))


def merge_word(symbols: Sequence[str], ranks: dict[Merge, int]) -> list[str]:
    """Apply the lowest-ranked merge that fits until none does."""
    parts = list(symbols)
    while len(parts) > 1:
        rank, pair = min((ranks.get(p, len(ranks)), p) for p in zip(parts, parts[1:]))
        if rank == len(ranks):
            break
        joined, i = [], 0
        while i < len(parts):
            hit = i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair
            joined.append(pair[0] + pair[1] if hit else parts[i])
            i += 2 if hit else 1
        parts = joined
    return parts


def word_encoder(merges: Sequence[Merge]):
    """word (byte characters) -> piece ids, with a bounded memory of recent words."""
    ranks = {m: i for i, m in reversed(list(enumerate(merges)))}
    ids = {p: i for i, p in enumerate(byte_vocab(merges))}

    @lru_cache(maxsize=200_000)
    def encode(word: str) -> tuple[int, ...]:
        return tuple(ids[p] for p in merge_word(word, ranks))

    return encode


def encode_dictionary(words: DataFrame, merges: Sequence[Merge]) -> DataFrame:
    """``words(word, ...)`` with the ids of each distinct word: every word is encoded once."""
    schema = T.StructType([*words.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    model = words.sparkSession.sparkContext.broadcast(list(merges))  # bounded by the vocabulary size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = word_encoder(model.value)
        for pdf in batches:
            yield pdf.drop(columns="_shown").assign(ids=[list(encode(w)) for w in pdf["_shown"]])

    return words.withColumn("_shown", to_byte_chars(F.col("word"))).mapInPandas(run, schema)


def encode_by_join(df: DataFrame, key: str, words: Column, merges: Sequence[Merge], hot_words: int = 1000) -> DataFrame:
    """Documents to ids through the distinct-word dictionary; one without words has no ids.

    The most frequent words (a fixed number of them) are joined without an
    exchange; only the rest is shuffled by word, where no word is hot any more.
    """
    placed = df.select(key, F.posexplode_outer(words).alias("pos", "word"))
    counts = placed.filter("word IS NOT NULL").groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    hot = counts.orderBy(F.desc("cnt"), "word").limit(hot_words)
    hot_ids = F.broadcast(encode_dictionary(hot.select("word"), merges))
    cold_ids = encode_dictionary(counts.select("word"), merges)
    left = placed.join(hot_ids.withColumnRenamed("ids", "hot_ids"), "word", "left")
    at_once = F.col("hot_ids").isNotNull() | F.col("word").isNull()
    done = left.filter(at_once).select(key, "pos", F.coalesce("hot_ids", F.array().cast("array<int>")).alias("ids"))
    rest = left.filter(~at_once).select(key, "pos", "word").join(cold_ids, "word")
    parts = done.unionByName(rest.select(key, "pos", "ids"))
    return parts.groupBy(key).agg(F.flatten(F.array_sort(F.collect_list(F.struct("pos", "ids")))["ids"]).alias("ids"))


def encode_words_udf(spark, merges: Sequence[Merge]):
    """Arrow UDF: array of pre-tokens -> ids.

    Rows stay where they are: no token is ever shuffled.  Each task keeps the
    words it has seen, which is what makes repeated words cheap.
    """
    model = spark.sparkContext.broadcast(list(merges))

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode_shown, chars = word_encoder(model.value).__wrapped__, byte_chars()

        @lru_cache(maxsize=200_000)
        def encode(word: str) -> tuple[int, ...]:
            return encode_shown("".join([chars[b] for b in word.encode()]))

        for rows in row_runs(batches):
            ids, ends = [], [0]
            for row in rows:
                for word in row:
                    ids += encode(word)
                ends.append(len(ids))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))

    return run


def encode_text(spark, text: Column, merges: Sequence[Merge]) -> Column:
    return encode_words_udf(spark, merges)(pretokens(text))


def decode_ids(spark, ids: Column, merges: Sequence[Merge]) -> Column:
    """Ids -> pieces -> bytes -> text, bad bytes replaced; the pieces travel as one literal array."""
    pieces = F.lit(byte_vocab(merges))
    return from_byte_chars(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))


def recover_merges(vocab: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """Pair each ``vocab(piece, rank)`` was merged from: the piece is encoded with the ranks below its own."""
    model = vocab.sparkSession.sparkContext.broadcast(ranks)

    def split(piece: str, below: int) -> list[str]:
        table, parts = model.value, list(piece)
        while len(parts) > 2:
            rank, i = min((table.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            long = pdf[pdf["piece"].str.len() > 1]
            pairs = [split(p, r) for p, r in zip(long["piece"], long["rank"])]
            yield pd.DataFrame(
                {
                    "rank": long["rank"].to_numpy(),
                    "left": pd.Series([p[0] for p in pairs], dtype=object),
                    "right": pd.Series([p[1] for p in pairs], dtype=object),
                }
            )

    return vocab.select("piece", F.col("rank").cast("int")).mapInPandas(run, "rank int, left string, right string")


def show_work_udtf(merges: Sequence[Merge], specials: Sequence[str]):
    """Table function: one row per pre-token with every step of its encoding."""
    model, kept = list(merges), set(specials)

    @F.udtf(returnType="n int, token string, shown string, merged array<string>, ids array<int>, is_special boolean")
    class ShowWork:
        def __init__(self):
            self.ranks = {m: i for i, m in reversed(list(enumerate(model)))}
            self.ids = {p: i for i, p in enumerate(byte_vocab(model) + sorted(kept))}
            self.chars = byte_chars()

        def eval(self, tokens: list):
            for n, token in enumerate(tokens):
                if token in kept:
                    yield n, token, token, [token], [self.ids[token]], True
                    continue
                shown = "".join(self.chars[b] for b in token.encode("utf-8"))
                merged = merge_word(shown, self.ranks)
                yield n, token, shown, merged, [self.ids[p] for p in merged], False

    return ShowWork
