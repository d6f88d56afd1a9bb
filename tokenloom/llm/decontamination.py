"""Benchmark decontamination: rare word-pair seeds, then Smith-Waterman alignment of words.

Texts that hold a seed of an item are aligned with the item around it: the best local alignment (match 2,
other word -1, left-out word -1) over that of the whole item with itself is the score.  Seeds are pairs of
words that stand one or two apart, in the item and in the text, and no pair of score ``s`` is lost by them:
an item of ``m`` words is scored 2 for each of ``k`` matched words, and what lies between two matches costs
at least the longer of the two gaps.  Of the ``k - 1`` steps from match to match let ``p`` cost 0 and ``q``
cost 1; then ``2p + q >= 2ms - 2``, and each of these steps is a seed pair at a first word of its own.  There
are ``m - 1`` first words, so at most ``m(1 - s)`` have no pair in the text: of any ``floor(m(1 - s)) + 1``
first words one has.  The rarest are taken, by the count of their pairs over the whole corpus; which are
rare decides the work alone.  Nothing bounds the number of texts of an item or of seeds in a text.

An item of one or two words would reach 0.5 by one common word, so it counts only where it stands whole.
The word of a one-word item, taken with itself, is its seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.batches import BASE, Chunk, SpanHash, Words, ascii_lower, find_words, mixed, signed, text_chunks
from tokenloom.llm.bitmaps import key_bitmap, may_hold
from tokenloom.llm.storage import staged

LEAST_WORDS = 3
STEPS = (1, 2)
WITH_ITSELF = (0,)
MATCH, OTHER, GAP = 2, -1, -1
MIN_SCORE = 0.5
CELLS = 1 << 21


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the lower-cased words of a text, in order."""
    data = np.frombuffer(text, dtype=np.uint8)
    chunk = next(text_chunks(pa.array([text], pa.binary())))
    words = find_words(chunk)
    return SpanHash(ascii_lower(data)).of(words.start, words.end)


def local_scores(item: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """Best local alignment of the item with each row of ``passages`` (padded with hashes no item has).

    One row of the alignment matrix at a time; words left out of the passage carry a score to the right,
    which is a running maximum after adding the gap cost of each place.
    """
    ramp = (-GAP) * np.arange(passages.shape[1], dtype=np.int32)
    row = np.zeros(passages.shape, dtype=np.int32)
    best = np.zeros(len(passages), dtype=np.int32)
    for word in item:
        diagonal = np.zeros_like(row)
        diagonal[:, 1:] = row[:, :-1]
        row = np.maximum(np.maximum(diagonal + np.where(passages == word, MATCH, OTHER), row + GAP), 0)
        row = np.maximum.accumulate(row + ramp, axis=1) - ramp
        best = np.maximum(best, row.max(axis=1))
    return best


def pair_hashes(chunk: Chunk, steps: tuple[int, ...] = STEPS) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a chunk, and for each pair of words so many apart in a row the first word and a hash."""
    words = find_words(chunk)
    hashes = SpanHash(ascii_lower(chunk.data)).of(words.start, words.end)
    firsts, pairs = [], []
    for step in steps:
        at = np.flatnonzero(words.row[: max(0, len(hashes) - step)] == words.row[step:])
        firsts.append(at)
        pairs.append(mixed(hashes[at] * np.uint64(BASE) + hashes[at + step]))
    return words, np.concatenate(firsts), np.concatenate(pairs)


def item_grams(items: DataFrame) -> DataFrame:
    """``item_key, item_id, item_text, words, place, gram`` for every pair of every item, repeated items once.

    An item of one word has that word with itself.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column("item_text")):
                words, at, grams = pair_hashes(chunk)
                _, one, own = pair_hashes(chunk, WITH_ITSELF)
                single = np.diff(words.first)[words.row[one]] == 1
                at, grams = np.concatenate([at, one[single]]), np.concatenate([grams, own[single]])
                row = words.row[at]
                size = np.diff(words.first)[row]
                take = pa.array(row + chunk.first)
                columns = [batch.column(c).take(take) for c in names[:3]]
                columns += [pa.array(x.astype(np.int32)) for x in (size, at - words.first[row])]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(signed(grams))], names=names)

    rows = items.select(
        F.xxhash64("item_id", "text").alias("item_key"), F.col("item_id").cast("bigint"), F.col("text").alias("item_text")
    )
    schema = "item_key bigint, item_id bigint, item_text string, words int, place int, gram bigint"
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.distinct().mapInArrow(work, schema)


def gram_counts(docs: DataFrame, grams: DataFrame, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """``gram, n``: how often texts hold each pair of an item (and a few others that share its bit)."""
    shared = docs.sparkSession.sparkContext.broadcast(key_bitmap(grams, "gram"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                found = signed(pair_hashes(chunk, steps)[2])
                gram, n = np.unique(found[may_hold(shared.value, found)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return docs.select("text").mapInArrow(work, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_hits(docs: DataFrame, grams: DataFrame, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """``row_key, gram, place``: where texts hold a pair of ``grams`` (or, rarely, one that shares its bit)."""
    shared = docs.sparkSession.sparkContext.broadcast(key_bitmap(grams, "gram"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            keys = batch.column("row_key").to_numpy()
            for chunk in text_chunks(batch.column("text")):
                words, at, found = pair_hashes(chunk, steps)
                hit = may_hold(bitmap, signed(found))
                at, found = at[hit], found[hit]
                row = words.row[at]
                columns = [keys[chunk.first + row], signed(found), at - words.first[row]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row_key", "gram", "place"])

    return docs.select("row_key", "text").mapInArrow(work, "row_key bigint, gram bigint, place bigint")


def rare_seeds(grams: DataFrame, counts: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``item_key, item_place, gram``: all pairs of the rarest first words of each item, one more than may be missed."""
    counted = grams.join(counts.select(F.col("gram").alias("_gram"), "n"), F.col("gram") == F.col("_gram"), "left")
    places = counted.groupBy("item_key", "place").agg(
        F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.first("words").alias("words"), F.collect_set("gram").alias("pairs")
    )
    rank = F.row_number().over(Window.partitionBy("item_key").orderBy("n", "place"))
    missed = F.floor(F.col("words") * (1 - min_score) + 1e-9)
    chosen = places.withColumn("rank", rank).filter(F.col("rank") <= missed + 1)
    return chosen.select("item_key", F.col("place").alias("item_place"), F.explode("pairs").alias("gram"))


def _passages(starts: np.ndarray, item_words: int, text_words: int) -> list[tuple[int, int]]:
    """Stretches of words around the places where the item would begin, joined where they meet.

    An alignment scores above 0, so it leaves out fewer text words than twice the item's words: it lies inside.
    Long stretches are cut into ones that overlap by more than an alignment with a score can span.
    """
    slack = 2 * item_words
    low = np.maximum(np.sort(starts) - slack, 0)
    high = np.minimum(np.sort(starts) + item_words + slack, text_words)
    first = np.flatnonzero(np.concatenate([[True], low[1:] > np.maximum.accumulate(high)[:-1]]))
    reach = np.maximum.reduceat(high, first)
    out, step = [], 16 * item_words
    for a, b in zip(low[first].tolist(), reach.tolist(), strict=True):
        while b - a > step + 4 * item_words:
            out.append((a, a + step + 4 * item_words))
            a += step
        out.append((a, b))
    return out


PAIRS = "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint"


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PAIRS.split(", ")]
    items: dict[bytes, np.ndarray] = {}
    for batch in batches:
        work: dict[bytes, list[tuple[tuple[int, int], int, int, np.ndarray]]] = {}
        ids: dict[tuple[int, int], int] = {}
        for i in range(len(batch)):
            words = word_hashes(batch.column("text")[i].as_py().encode())
            for c, candidate in enumerate(batch.column("items")[i].as_py()):
                text = (candidate["item_text"] or "").encode()
                ids[i, c] = candidate["item_id"]
                if text not in items:
                    items[text] = word_hashes(text)
                for a, b in _passages(np.array(candidate["starts"]), len(items[text]), len(words)):
                    work.setdefault(text, []).append(((i, c), a, b, words[a:b]))
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for text, stretches in work.items():
            stretches.sort(key=lambda s: s[2] - s[1])
            while stretches:
                width = max(1, stretches[-1][2] - stretches[-1][1])
                part = stretches[-max(1, CELLS // width) :]
                del stretches[-len(part) :]
                padded = np.zeros((len(part), width), dtype=np.uint64)
                for k, (_, a, b, hashes) in enumerate(part):
                    padded[k, : b - a] = hashes
                scores = local_scores(items[text], padded) / (MATCH * max(1, len(items[text])))
                for (pair, a, b, _), score in zip(part, scores.tolist(), strict=True):
                    score = score if len(items[text]) >= LEAST_WORDS or score == 1 else 0.0
                    best[pair] = max(best.get(pair, (-1.0, 0, 0)), (score, a, b))
        rows = [[batch.column("doc_id")[pair[0]].as_py(), ids[pair], *found] for pair, found in best.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        items = items if len(items) < 10_000 else {}


def contaminated_pairs(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word`` of each text and item that align well enough.

    ``docs``: ``doc_id, text``; ``items``: ``item_id, text``.  The words compared are ``[first_word, last_word)``.
    Items of one or two words are found only whole; null or empty items and texts match nothing.  Repeated rows of ``docs`` give
    repeated pairs; repeated items count once.  Empty tables give no pairs.
    """
    if not 1 / LEAST_WORDS < min_score <= 1:
        raise ValueError("min_score must be above 1/3, where one word of three is enough, and at most 1")
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), F.col("doc_id").cast("bigint"), "text")
    grams = staged(item_grams(items), "leak-grams")
    steps = STEPS if grams.filter("words = 1").isEmpty() else WITH_ITSELF + STEPS
    seeds = staged(rare_seeds(grams, gram_counts(rows, grams, steps), min_score), "leak-seeds")
    hits = gram_hits(rows, seeds, steps).distinct().withColumnRenamed("gram", "hit")
    near = hits.join(seeds, F.col("hit") == F.col("gram")).select(
        "row_key", "item_key", (F.col("place") - F.col("item_place")).alias("start")
    )
    found = near.groupBy("row_key", "item_key").agg(F.collect_set("start").alias("starts"))
    named = grams.groupBy("item_key").agg(F.first("item_id").alias("item_id"), F.first("item_text").alias("item_text"))
    found = found.join(named, "item_key").groupBy(F.col("row_key").alias("_key")).agg(
        F.collect_list(F.struct("item_id", "item_text", "starts")).alias("items")
    )
    found = staged(found, "leak-candidates")
    shared = docs.sparkSession.sparkContext.broadcast(key_bitmap(found, "_key"))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(shared.value, batch.column("row_key").to_numpy())))

    held = rows.filter("text IS NOT NULL").mapInArrow(likely, "row_key bigint, doc_id bigint, text string")
    pairs = held.join(found, F.col("row_key") == F.col("_key")).select("doc_id", "text", "items").mapInArrow(_align, PAIRS)
    return pairs.filter(F.col("score") >= min_score)


def keep_clean(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that align with no item, columns as they were."""
    named = docs.select(F.struct("*").alias("doc"), F.xxhash64("doc_id", "text").alias("_key"))
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    bad = contaminated_pairs(keyed, items, min_score).select(F.col("doc_id").alias("_bad")).distinct()
    return named.join(bad, F.col("_key") == F.col("_bad"), "left_anti").select("doc.*")
