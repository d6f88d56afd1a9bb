"""Log-bilinear language model trained with noise-contrastive estimation.

Tokens are the lower-cased words of a text and one end.  Every token has vectors: the most frequent
words and the end are classes of their own, and each other word belongs to the class of its last bytes,
whether it was seen in training or not.  The model scores a class ``w`` after the classes ``u, v`` as
``(c1 * r[v] + c2 * r[u]) . q[w] + b[w]`` and is normalised over all classes; a word of an ending then
has its smoothed share among the words of that ending.  So the probabilities of all words and one unseen
word of each ending add up to one.

Training passes over every training token.  Each task starts from the same parameters and learns on
its own texts; the results, one row a task, are added up ``FAN_IN`` to one and averaged by tokens.
Word counts are exact.  The most frequent ``HEAD_WORDS`` of at most ``HEAD_BYTES`` bytes go to all
tasks; the counts of all other words meet the texts in a join by word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.batches import Chunk, SpanHash, ascii_lower, find_words, text_chunks
from tokenloom.llm.storage import staged

CLASSES = 1024
ENDING_BYTES = 3
DIM = 12
NOISE = 24
BATCH = 1024
RATE = 0.05
HEAD_WORDS = 1 << 17
HEAD_BYTES = 64
FAN_IN = 64
COUNT_RANGES = 64
FLUSH_WORDS = 200_000
CONTEXTS_AT_ONCE = 2048
LOG10_E = float(np.log10(np.e))


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 7, is 2; a null id counts as empty text and is not held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def count_words(train: DataFrame) -> DataFrame:
    """``word`` (bytes), ``n``: exact counts; a null text has no words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                counts.update(b" ".join(chunk.texts()).lower().split())
                if len(counts) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    return train.select("text").mapInArrow(work, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def ending_classes(hashes: SpanHash, start: np.ndarray, end: np.ndarray, endings: int) -> np.ndarray:
    """The class, from 0, of the last ``ENDING_BYTES`` bytes of each word."""
    return (hashes.of(np.maximum(start, end - ENDING_BYTES), end) % np.uint64(endings)).astype(np.int32)


def word_endings(words: list[bytes], endings: int) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    starts = ends - np.array([len(w) for w in words], dtype=np.int64)
    return ending_classes(SpanHash(np.frombuffer(b"".join(words), dtype=np.uint8)), starts, ends, endings)


@dataclass
class Vocabulary:
    """Head words with their counts in order of frequency, and the totals of the training tokens.

    ``ending_tokens`` and ``ending_types`` are those of the words that have no class of their own.
    """

    words: list[bytes]
    counts: np.ndarray
    tokens: int
    types: int
    ends: int
    class_words: int
    ending_tokens: np.ndarray
    ending_types: np.ndarray

    @property
    def endings(self) -> int:
        return len(self.ending_tokens)

    def class_counts(self) -> np.ndarray:
        """By class: words 0.., then endings, then the end of a text."""
        return np.array([*self.counts[: self.class_words], *self.ending_tokens, self.ends], dtype=np.float64)

    def ending_levels(self) -> np.ndarray:
        """By class: log10 of what the share of a word within its class is divided by."""
        levels = np.zeros(self.class_words + self.endings + 1)
        levels[self.class_words : -1] = np.log10(self.ending_tokens + self.ending_types + 1.0)
        return levels


def ending_totals(counts: DataFrame, endings: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and words of each class of endings, over all words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, types = np.zeros(endings, dtype=np.int64), np.zeros(endings, dtype=np.int64)
        for batch in batches:
            times = batch.column("n").to_numpy()
            for chunk in text_chunks(batch.column("word")):
                at = ending_classes(SpanHash(chunk.data), chunk.bounds[:-1], chunk.bounds[1:], endings)
                np.add.at(tokens, at, times[chunk.first : chunk.first + chunk.rows])
                types += np.bincount(at, minlength=endings)
        columns = [pa.array(np.arange(endings)), pa.array(tokens), pa.array(types)]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "tokens", "types"])

    parts = counts.select("word", "n").mapInArrow(work, "at bigint, tokens bigint, types bigint")
    tokens, types = np.zeros(endings, dtype=np.int64), np.zeros(endings, dtype=np.int64)
    for row in parts.groupBy("at").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).collect():
        tokens[row["at"]], types[row["at"]] = row["tokens"], row["types"]
    return tokens, types


def head_words(counts: DataFrame, most: int) -> list:
    """The most frequent words, at most ``most``: all whose count lies in the highest ranges that fit.

    A table of words by range of count (``COUNT_RANGES`` to a doubling) finds the least count, so no task
    returns words that are not in the head.  Words above ``HEAD_BYTES`` are left to the join.
    """
    counts = counts.filter(F.length("word") <= HEAD_BYTES)
    step = F.floor(F.log2(F.col("n")) * COUNT_RANGES).cast("int")
    sizes = sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True)
    total, least = 0, None
    for row in sizes:
        total += row["words"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return []
    return sorted(counts.filter(step >= least).collect(), key=lambda r: (-r["n"], bytes(r["word"])))


def learn_vocabulary(counts: DataFrame, documents: int, classes: int = CLASSES, head: int = HEAD_WORDS) -> Vocabulary:
    """Every document adds one end.  The head is a fixed number of rows at most; half of the classes are endings."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = head_words(counts, head)
    words = [bytes(r["word"]) for r in top]
    numbers = np.array([r["n"] for r in top], dtype=np.int64)
    endings = max(1, classes // 2)
    own = min(len(words), max(0, classes - endings - 1))
    ending_tokens, ending_types = ending_totals(counts, endings)
    at = word_endings(words[:own], endings)
    np.subtract.at(ending_tokens, at, numbers[:own])
    np.subtract.at(ending_types, at, 1)
    tokens, types = total[0] + documents, total[1] + (documents > 0)
    return Vocabulary(words, numbers, tokens, types, documents, own, ending_tokens, ending_types)


class ClassIndex:
    """Classes of the words of a chunk, by hash of their lower-cased bytes."""

    def __init__(self, words: list[bytes], endings: int):
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        hashes = SpanHash(data).of(ends - [len(w) for w in words], ends) if words else np.zeros(0, np.uint64)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.words, self.endings, self.end = len(words), endings, len(words) + endings

    def tokens(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all tokens of the chunk (each row closed by its end), and where each row begins."""
        words = find_words(chunk)
        spans = SpanHash(ascii_lower(chunk.data))
        hashes = spans.of(words.start, words.end)
        found = self.words + ending_classes(spans, words.start, words.end, self.endings)
        if len(self.sorted):
            place = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
            hit = self.sorted[place] == hashes
            found[hit] = self.order[place[hit]]
        out = np.full(len(hashes) + chunk.rows, self.end, dtype=np.int32)
        out[np.arange(len(hashes)) + words.row] = found
        return out, words.first + np.arange(chunk.rows + 1)

    def contexts(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two classes before each token; ends stand before a text."""
        one, two = np.full(len(tokens), self.end, np.int32), np.full(len(tokens), self.end, np.int32)
        one[1:], two[2:] = tokens[:-1], tokens[:-2]
        one[first[:-1]] = two[first[:-1]] = self.end
        second = first[:-1] + 1
        second = second[second < first[1:]]
        two[second] = self.end
        return one, two


def start_parameters(class_counts: np.ndarray, dim: int = DIM, seed: int = 7) -> dict[str, np.ndarray]:
    """Small random vectors, and biases at which the model is the smoothed unigram."""
    rng, k = np.random.default_rng(seed), len(class_counts)
    share = (class_counts + 1) / (class_counts + 1).sum()
    return {
        "r": rng.normal(0, 0.1, (k, dim)).astype(np.float32),
        "q": rng.normal(0, 0.1, (k, dim)).astype(np.float32),
        "c": np.ones((2, dim), dtype=np.float32),
        "b": np.log(share).astype(np.float32),
    }


def _scatter(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(at, rows[:, d], size) for d in range(rows.shape[1])], axis=1)


class Trainer:
    """Noise-contrastive steps over batches of tokens; the noise of a batch is shared by its tokens."""

    def __init__(self, parameters: dict[str, np.ndarray], class_counts: np.ndarray, seed: int, noise: int = NOISE):
        self.p = {k: v.copy() for k, v in parameters.items()}
        self.square = {k: np.full(v.shape, 1e-8, dtype=np.float32) for k, v in parameters.items()}
        share = (class_counts + 1) / (class_counts + 1).sum()
        self.log_noise = (np.log(share) + np.log(noise)).astype(np.float32)
        self.edges = np.cumsum(share)
        self.rng, self.noise, self.seen = np.random.default_rng(seed), noise, 0

    def step(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        r, q, c, b = (self.p[k] for k in "rqcb")
        n, k = len(target), len(b)
        drawn = np.minimum(np.searchsorted(self.edges, self.rng.random(self.noise)), k - 1)
        r1, r2 = r[one], r[two]
        h = r1 * c[0] + r2 * c[1]
        q_target, q_noise = q[target], q[drawn]
        s_target = np.einsum("nd,nd->n", h, q_target) + b[target] - self.log_noise[target]
        s_noise = h @ q_noise.T + (b[drawn] - self.log_noise[drawn])
        e_target = 1 / (1 + np.exp(-s_target)) - 1
        e_noise = 1 / (1 + np.exp(-s_noise))
        g_h = e_target[:, None] * q_target + e_noise @ q_noise
        g_q = _scatter(target, e_target[:, None] * h, k)
        np.add.at(g_q, drawn, e_noise.T @ h)
        g_b = np.bincount(target, e_target, k)
        np.add.at(g_b, drawn, e_noise.sum(axis=0))
        g_c = np.stack([(g_h * r1).sum(axis=0), (g_h * r2).sum(axis=0)])
        g_r = _scatter(one, g_h * c[0], k) + _scatter(two, g_h * c[1], k)
        for name, g in (("r", g_r), ("q", g_q), ("c", g_c), ("b", g_b)):
            g = (g / n).astype(np.float32)
            self.square[name] += g * g
            self.p[name] -= RATE * g / np.sqrt(self.square[name])
        self.seen += n

    def learn(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        order = self.rng.permutation(len(target))
        for at in range(0, len(order), BATCH):
            picked = order[at : at + BATCH]
            self.step(target[picked], one[picked], two[picked])


def added_up(parts: DataFrame, tasks: int) -> list[tuple[int, np.ndarray]]:
    """Sum of the rows ``seen, flat`` (doubles as bytes): ``FAN_IN`` partitions become one until few are left."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, flat = 0, None
        for batch in batches:
            for weight, blob in zip(batch.column("seen").to_pylist(), batch.column("flat").to_pylist(), strict=True):
                more = np.frombuffer(blob, dtype=np.float64)
                seen, flat = seen + weight, more.copy() if flat is None else flat + more
        if flat is not None:
            columns = [pa.array([seen]), pa.array([flat.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["seen", "flat"])

    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        parts = parts.repartition(tasks).mapInArrow(work, "seen bigint, flat binary")
    return [(row["seen"], np.frombuffer(row["flat"], dtype=np.float64)) for row in parts.collect()]


def train(train_docs: DataFrame, vocabulary: Vocabulary, rounds: int = 1) -> dict[str, np.ndarray]:
    """Parameters learnt on all training texts; without any they are the start."""
    counts = vocabulary.class_counts()
    parameters = start_parameters(counts)
    words, endings = vocabulary.words[: vocabulary.class_words], vocabulary.endings
    texts = train_docs.select("text")
    for turn in range(rounds):
        start = train_docs.sparkSession.sparkContext.broadcast(parameters)

        def work(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            index = ClassIndex(words, endings)
            trainer = Trainer(start.value, counts, TaskContext.get().partitionId() * 1000 + turn)
            for batch in batches:
                for chunk in text_chunks(batch.column("text")):
                    tokens, first = index.tokens(chunk)
                    trainer.learn(tokens, *index.contexts(tokens, first))
            if trainer.seen:
                flat = np.concatenate([trainer.p[k].ravel() for k in "rqcb"]).astype(np.float64) * trainer.seen
                columns = [pa.array([trainer.seen]), pa.array([flat.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["seen", "flat"])

        learnt = texts.mapInArrow(work, "seen bigint, flat binary")
        sums = added_up(learnt, texts.rdd.getNumPartitions())
        start.unpersist()
        if not sums:
            break
        flat = np.sum([values for _, values in sums], axis=0) / sum(seen for seen, _ in sums)
        at = 0
        for k in "rqcb":
            size = parameters[k].size
            parameters[k] = flat[at : at + size].reshape(parameters[k].shape).astype(np.float32)
            at += size
    return parameters


class Scorer:
    """Normalised log-probabilities of classes; the normaliser of a context is computed once."""

    _last: tuple[bytes, np.ndarray] | None = None

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = {k: v.astype(np.float32) for k, v in parameters.items()}
        self.k = len(self.p["b"])
        mark = self.p["r"].tobytes() + self.p["b"].tobytes()
        if Scorer._last is None or Scorer._last[0] != mark:  # kept for the next task of this worker
            Scorer._last = (mark, np.full(self.k * self.k, np.nan, dtype=np.float32))
        self.normaliser = Scorer._last[1]

    def hidden(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.p["r"][one] * self.p["c"][0] + self.p["r"][two] * self.p["c"][1]

    def log_probabilities(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural logarithms, one for each token."""
        code = one.astype(np.int64) * self.k + two
        new = np.unique(code[np.isnan(self.normaliser[code])])
        for at in range(0, len(new), CONTEXTS_AT_ONCE):
            part = new[at : at + CONTEXTS_AT_ONCE]
            scores = self.hidden(part // self.k, part % self.k) @ self.p["q"].T + self.p["b"]
            top = scores.max(axis=1)
            self.normaliser[part] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        own = np.einsum("nd,nd->n", self.hidden(one, two), self.p["q"][target]) + self.p["b"][target]
        return (own - self.normaliser[code]).astype(np.float64)


ROWS = (
    "row_id bigint, doc_id bigint, held_out boolean, n_tokens bigint, other_levels double, known bigint, base_logs double, "
    "model_logs double, other_logs double, words array<binary>, times array<bigint>"
)


def score_heads(docs: DataFrame, vocabulary: Vocabulary, parameters: dict[str, np.ndarray]) -> DataFrame:
    """What head words and classes give each row, and its words outside the head with their numbers."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, parameters))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, parameters = shared.value
        index = ClassIndex(vocabulary.words[: vocabulary.class_words], vocabulary.endings)
        scorer, levels = Scorer(parameters), vocabulary.ending_levels()
        logs = np.log10(vocabulary.counts + 1.0)
        place = {w: i for i, w in enumerate(vocabulary.words)}
        end_log, number = float(np.log10(vocabulary.ends + 1)), TaskContext.get().partitionId() << 40
        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                tokens, first = index.tokens(chunk)
                each = scorer.log_probabilities(tokens, *index.contexts(tokens, first))
                sums = np.concatenate([[0.0], np.cumsum(each)])
                beyond = np.concatenate([[0.0], np.cumsum(levels[tokens])])
                others = beyond[first[1:]] - beyond[first[:-1]]
                model = (sums[first[1:]] - sums[first[:-1]]) * LOG10_E
                known, base, other, words, times = [], [], [], [], []
                for text in chunk.texts():
                    found = Counter(text.lower().split())
                    at, many, rare, rare_times = [], [], [], []
                    for w, n in found.items():
                        i = place.get(w)
                        if i is None:
                            rare.append(w)
                            rare_times.append(n)
                        else:
                            at.append(i)
                            many.append(n)
                    at, many = np.array(at, dtype=np.int64), np.array(many, dtype=np.int64)
                    share = many * logs[at]
                    known.append(int(many.sum()) + (vocabulary.ends > 0))
                    base.append(float(share.sum()) + end_log)
                    other.append(float(share[at >= vocabulary.class_words].sum()))
                    words.append(rare)
                    times.append(rare_times)
                part = batch.slice(chunk.first, chunk.rows)
                columns = [
                    pa.array(np.arange(chunk.rows) + number), part.column("doc_id"), part.column("held_out"),
                    pa.array(np.diff(first)), pa.array(others), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(model),
                    pa.array(other, pa.float64()), pa.array(words, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64())),
                ]
                number += chunk.rows
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ROWS.split(", ")])

    rows = docs.select(F.col("doc_id").cast("bigint"), is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(work, ROWS)


def score_texts(docs: DataFrame, classes: int = CLASSES, head: int = HEAD_WORDS, rounds: int = 1) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    A null or empty text is one end token.  Repeated rows are scored one by one.  Without training
    texts every probability of the base is 1 and the model is its start.
    """
    training = docs.filter(~is_held_out(F.col("doc_id")))
    counts = staged(count_words(training), "lm-counts")
    vocabulary = learn_vocabulary(counts, training.select("doc_id").count(), classes, head)
    return score_with(docs, counts, vocabulary, train(training, vocabulary, rounds))


def score_with(docs: DataFrame, counts: DataFrame, vocabulary: Vocabulary, parameters: dict[str, np.ndarray]) -> DataFrame:
    """The scores of every row by a trained model; ``counts`` are those of all its training words."""
    rows = staged(score_heads(docs, vocabulary, parameters), "lm-rows")
    outside = rows.select("row_id", F.explode(F.arrays_zip("words", "times")).alias("x"))
    outside = outside.select("row_id", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    n = F.coalesce("n", F.lit(0))
    met = outside.join(counts, "word", "left").groupBy(F.col("row_id").alias("of")).agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(n + 1.0)).alias("rare_logs"),
    )
    both = rows.drop("words", "times").join(met, F.col("row_id") == F.col("of"), "left")
    none = F.lit(0)
    base_level = float(np.log10(vocabulary.tokens + 1.0 * (vocabulary.types + 1)))
    rare_logs = F.coalesce("rare_logs", none)
    return both.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", none)).alias("n_known"),
        F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_logs") + rare_logs - F.col("n_tokens") * base_level).alias("base_score"),
        (F.col("model_logs") + F.col("other_logs") + rare_logs - F.col("other_levels")).alias("score"),
    )
