"""Quality rules: counts of a text, and a hashed n-gram logistic regression with calibrated probabilities.

Features are word 1-grams and 2-grams (lower-cased) and 4-grams of the UTF-8 characters, hashed
into ``BUCKETS`` each; a feature weighs its count over the root of the number of grams of its
kind.  Two models share the features: one is fitted on the ``quality`` labels, one on ``toxic``.

The fit sees a bounded sample of the labelled rows: at most ``sample`` rows of each of three
strata (bad, toxic, clean), the rows with the smallest hashes of their ids.  Whole texts are used;
a text's features are at most ``3 * BUCKETS`` numbers whatever its length.  A fifth of the sample is
kept from the fit and calibrates the probabilities (a logistic curve over the score, the rows
weighted back to the strata's true sizes).  Scoring runs over all rows in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.batches import Chunk, SpanHash, Words, ascii_lower, find_words, gram_hashes, mixed, text_chunks

BUCKETS = 1 << 17
FAMILIES = 3
CHAR_GRAM = 4
SAMPLE = 1500
MIN_QUALITY = 0.5
MAX_TOXIC = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of marks between consecutive bounds."""
    sums = np.zeros(len(marks) + 1, dtype=np.float64 if marks.dtype.kind == "f" else np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether it occurs twice or more, and whether an equal one stands before it."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    twice, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    twice[order], later[order] = same[:-1] | same[1:], same[:-1]
    return twice, later


def _within_row(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    return mixed(hashes + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def base_counts(chunk: Chunk, words: Words, spans: SpanHash, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every row of a chunk."""
    data, bounds = chunk.data, chunk.bounds
    n_words = np.diff(words.first)
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[words.start] += 1
    np.subtract.at(inside, words.end, 1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    word_chars = _per_row(inside & ((data & 0xC0) != 0x80), bounds)
    n_symbols = _per_row(SYMBOLS[data], bounds)

    breaks = np.flatnonzero(data == 10)
    heads = np.union1d(np.concatenate([bounds[:-1], breaks + 1]), [])
    heads = heads[heads < len(data)].astype(np.int64)
    row = np.searchsorted(bounds, heads, side="right") - 1
    tails = np.empty(len(heads), dtype=np.int64)
    if len(heads):
        tails[:-1] = heads[1:]
        tails[-1] = len(data)
        tails = np.where(data[tails - 1] == 10, tails - 1, tails)
    with_word = np.searchsorted(words.start, tails) > np.searchsorted(words.start, heads)
    heads, tails, row = heads[with_word], tails[with_word], row[with_word]
    _, later = _repeats(_within_row(spans.of(heads, tails), row))
    n_dup = np.bincount(row[later], minlength=chunk.rows)

    at, grams = gram_hashes(words, hashes, REPEAT_WINDOW)
    twice, _ = _repeats(_within_row(grams, words.row[at]))
    cover = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(cover, at[twice], 1)
    np.subtract.at(cover, at[twice] + REPEAT_WINDOW, 1)
    n_repeat = _per_row(np.cumsum(cover[:-1]) > 0, words.first)
    found = (n_words, word_chars, n_symbols, n_dup, n_repeat)
    return dict(zip(BASE_COLUMNS, (x.astype(np.int64) for x in found), strict=True))


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


def hashed_grams(chunk: Chunk, words: Words, spans: SpanHash) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family the buckets of all grams in text order, and where each row's grams begin and end."""
    lowered = SpanHash(ascii_lower(chunk.data)).of(words.start, words.end)
    at, pairs = gram_hashes(words, lowered, 2)
    windows = spans.windows(CHAR_GRAM)
    low = np.minimum(chunk.bounds[:-1], len(windows))
    high = np.maximum(low, np.minimum(chunk.bounds[1:] - CHAR_GRAM + 1, len(windows)))
    mask = np.uint64(BUCKETS - 1)
    firsts = np.searchsorted(at, words.first)
    families = []
    for k, (h, a, b) in enumerate(
        ((lowered, words.first[:-1], words.first[1:]), (pairs, firsts[:-1], firsts[1:]), (windows, low, high))
    ):
        families.append(((h & mask).astype(np.int64) + k * BUCKETS, np.stack([a, b])))
    return families


def chunk_scores(families: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, rows: int) -> np.ndarray:
    """Score of every row for each column of ``weights``."""
    total = np.zeros((rows, weights.shape[1]))
    for buckets, (low, high) in families:
        root = np.sqrt(np.maximum(high - low, 1))
        for m in range(weights.shape[1]):
            sums = np.zeros(len(buckets) + 1)
            np.cumsum(weights[:, m][buckets], out=sums[1:])
            total[:, m] += (sums[high] - sums[low]) / root
    return total


@dataclass
class Model:
    """Weights by bucket for the quality and the toxicity score, and their calibration curves."""

    weights: np.ndarray
    slope: np.ndarray
    shift: np.ndarray

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(scores * self.slope + self.shift, -500, 500)))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``quality, toxic, stratum_rows, features`` of at most ``3 * sample`` labelled documents.

    One document has one label: bad if any of its labels says so, toxic likewise.  Null marks count
    as not labelled (quality) or not toxic.  The ids are at most ``3 * sample`` rows and are broadcast.
    """
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    marks = marks.agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    stratum = F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 0, 0).otherwise(2)
    marks = marks.withColumn("stratum", stratum).withColumn("draw", F.xxhash64("doc_id"))
    counts = {r["stratum"]: r["n"] for r in marks.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for s, n in sorted(counts.items()):
        part = marks.filter(F.col("stratum") == s).orderBy("draw", "doc_id").limit(sample)
        part = part.withColumn("stratum_rows", F.lit(float(n)) / min(n, sample))
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        chosen = marks.withColumn("stratum_rows", F.lit(1.0))
    ids = F.broadcast(chosen.withColumnRenamed("doc_id", "_id").select("_id", "quality", "toxic", "stratum_rows"))
    rows = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            feature, value = [], []
            for chunk in text_chunks(batch.column("text"), 1 << 18):
                spans = SpanHash(chunk.data)
                families = hashed_grams(chunk, find_words(chunk), spans)
                for i in range(chunk.rows):
                    parts = [np.unique(b[low[i] : high[i]], return_counts=True) for b, (low, high) in families]
                    n = [max(1, int(high[i] - low[i])) for _, (low, high) in families]
                    feature.append(np.concatenate([p[0] for p in parts]).astype(np.int32).tobytes())
                    shares = [p[1] / np.sqrt(k) for p, k in zip(parts, n, strict=True)]
                    value.append(np.concatenate(shares).astype(np.float32).tobytes())
            columns = [batch.column(c) for c in ("doc_id", "quality", "toxic", "stratum_rows")]
            columns += [pa.array(feature, pa.binary()), pa.array(value, pa.binary())]
            names = ["doc_id", "quality", "toxic", "stratum_rows", "feature", "value"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = rows.select(F.col("doc_id").cast("bigint"), "text", F.col("quality").cast("int"), F.col("toxic").cast("int"), "stratum_rows")
    return rows.mapInArrow(
        work, "doc_id bigint, quality int, toxic int, stratum_rows double, feature binary, value binary"
    )


def _calibrate(scores: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps; a small ridge keeps a clean split finite."""
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(slope * scores + shift, -500, 500)))
        r, h = weight * (p - truth), np.maximum(weight * p * (1 - p), 1e-9)
        gradient = np.array([(r * scores).sum() + 1e-2 * (slope - 1), r.sum() + 1e-2 * shift])
        hessian = np.array([[(h * scores * scores).sum() + 1e-2, (h * scores).sum()], [(h * scores).sum(), h.sum() + 1e-2]])
        step = np.clip(np.linalg.solve(hessian, gradient), -2.0, 2.0)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(shift)


def fit(sample: DataFrame, epochs: int = 8, batch_rows: int = 64, rate: float = 0.5) -> Model:
    """Logistic regressions by minibatch gradient steps with per-feature step sizes, in a fixed order.

    Without rows, or with one class only, the score is constant and the calibrated probability is
    that of the only class.
    """
    rows = sorted(sample.collect(), key=lambda r: (r["doc_id"] * 0x9E3779B97F4A7C15 & 0xFFFFFFFF, r["doc_id"], r["feature"]))
    features = [np.frombuffer(r["feature"], np.int32) for r in rows]
    values = [np.frombuffer(r["value"], np.float32) for r in rows]
    truth = np.array([[r["quality"] == 1, r["toxic"] == 1] for r in rows], dtype=np.float64).reshape(-1, 2)
    weight = np.array([r["stratum_rows"] for r in rows])
    weights = np.zeros((FAMILIES * BUCKETS, 2))
    squares = np.full_like(weights, 1e-6)
    held = np.arange(len(rows)) % 5 == 4 if len(rows) >= 50 else np.zeros(len(rows), bool)
    learn = np.flatnonzero(~held)

    def scores_of(picked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(features[i]) for i in picked])
        flat = np.concatenate([features[i] for i in picked])
        value = np.concatenate([values[i] for i in picked])
        row = np.repeat(np.arange(len(picked)), size)
        each = [np.bincount(row, weights[flat, m] * value, len(picked)) for m in range(2)]
        return np.stack(each, axis=1), flat, value, row

    for epoch in range(epochs if len(rows) else 0):
        order = learn[np.random.default_rng(epoch).permutation(len(learn))]
        for at in range(0, len(order), batch_rows):
            picked = order[at : at + batch_rows]
            s, flat, value, row = scores_of(picked)
            error = (1.0 / (1.0 + np.exp(-np.clip(s, -500, 500))) - truth[picked]) / len(picked)
            where, back = np.unique(flat, return_inverse=True)
            for m in range(2):
                g = np.bincount(back, error[row, m] * value, len(where))
                squares[where, m] += g * g
                weights[where, m] -= rate * 0.1 * g / np.sqrt(squares[where, m])
    slope, shift = np.ones(2), np.zeros(2)
    judge = np.flatnonzero(held) if held.any() else learn
    if len(judge):
        s = np.concatenate([scores_of(judge[i : i + 256])[0] for i in range(0, len(judge), 256)])
        for m in range(2):
            slope[m], shift[m] = _calibrate(s[:, m], truth[judge, m], weight[judge])
    else:
        shift = np.array([50.0, -50.0])  # nothing learnt: every text passes both
    return Model(weights.astype(np.float32), slope, shift)


OUT = (
    "doc_id bigint, row_hash bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, p_quality double, p_toxic double, kept boolean"
)


def judge_texts(docs: DataFrame, model: Model) -> DataFrame:
    """Counts, probabilities and verdict of every row (``doc_id``, ``text``); the model has a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ["doc_id", "row_hash", *BASE_COLUMNS, "base_failed", "p_quality", "p_toxic", "kept"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                words, spans = find_words(chunk), SpanHash(chunk.data)
                counts = base_counts(chunk, words, spans, spans.of(words.start, words.end))
                p = own.probabilities(chunk_scores(hashed_grams(chunk, words, spans), own.weights, chunk.rows))
                failed = base_failed(counts)
                kept = ~failed & (p[:, 0] >= MIN_QUALITY) & (p[:, 1] < MAX_TOXIC)
                part = batch.slice(chunk.first, chunk.rows)
                columns = [part.column("doc_id"), part.column("row_hash"), *[pa.array(counts[c]) for c in BASE_COLUMNS]]
                columns += [pa.array(failed), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(columns, names=schema)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("row_hash"), "text")
    return rows.mapInArrow(work, OUT)


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``p_quality``, ``p_toxic`` and ``kept`` of every row.

    Null text has no words and fails the base rules, as does an empty one.  Repeated rows get equal
    answers.  Without labelled rows only the base rules decide.
    """
    return judge_texts(docs, fit(labelled_sample(docs, labels, sample)))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows that the rules keep, columns as they were.

    Equal texts under one id have one verdict, so rows and verdicts meet by id and text hash.
    """
    good = judged(docs, labels, sample).filter("kept").select(
        F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash")
    )
    packed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("_of"), F.xxhash64("text").alias("_own"))
    same = F.col("_of").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_hash"))
    return packed.join(good.distinct(), same, "left_semi").select("doc.*")
