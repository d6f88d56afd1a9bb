"""Unigram vocabulary: expectation-maximisation over distinct words.

Words of equal length are one numpy grid, so a step of the sum over all segmentations is done for all of them
at once.  Pieces are known by a 64-bit hash of their characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.session import written

GRID_CELLS = 1 << 20  # word ends x piece lengths x words of a grid
HASH_BASE = 0x9E3779B97F4A7C15


BLOCK = 256  # characters; long words are cut into overlapping blocks before their suffixes are listed


def seed_pieces(words: DataFrame, n_seeds: int, longest: int, min_count: int = 2) -> DataFrame:
    """Candidate pieces of ``words(word, cnt)``: all characters, and the ``n_seeds`` repeated
    substrings of 2 to ``longest`` characters with the largest count * length.

    A substring that is always followed by the same character is left out for the longer one: the
    rest are the inner nodes of the suffix tree of all words.  Equal suffixes (up to ``longest``
    characters) are added up before their beginnings are listed.
    """
    n = F.length("word")
    blocks = words.filter(n > 0).select(
        "cnt", "word", F.explode(F.sequence(F.lit(1), n, F.lit(BLOCK))).alias("at"), n.alias("n")
    )
    blocks = blocks.select(
        "cnt",
        F.expr(f"substring(word, at, {BLOCK + longest - 1})").alias("block"),
        F.least(F.lit(BLOCK), F.col("n") - F.col("at") + 1).alias("starts"),
    )
    suffixes = blocks.select("cnt", "block", F.explode(F.sequence(F.lit(1), F.col("starts"))).alias("i")).select(
        "cnt", F.expr(f"substring(block, i, {longest})").alias("suffix")
    )
    suffixes = suffixes.groupBy("suffix").agg(F.sum("cnt").alias("cnt"))
    lengths = F.sequence(F.lit(1), F.length("suffix"))
    counts = (
        suffixes.select("cnt", F.explode(F.transform(lengths, lambda k: F.substring("suffix", F.lit(1), k))).alias("piece"))
        .groupBy("piece")
        .agg(F.sum("cnt").alias("cnt"))
        .filter((F.col("cnt") >= min_count) | (F.length("piece") == 1))
    )
    counts = written(counts, "unigram-counts")
    longer = counts.filter(F.length("piece") > 1)
    followed = longer.groupBy(F.expr("left(piece, length(piece) - 1)").alias("piece")).agg(F.max("cnt").alias("next"))
    nodes = longer.join(followed, "piece", "left").filter(F.col("next").isNull() | (F.col("next") < F.col("cnt")))
    nodes = nodes.orderBy(F.desc(F.col("cnt") * F.length("piece")), "piece").limit(n_seeds)
    single = counts.filter(F.length("piece") == 1)
    return single.unionByName(nodes.select("piece", "cnt")).select("piece", F.col("cnt").cast("double"))


def _grids(words: list[str], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words of one length, and their characters (place in the word, word); empty words are left out."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    first, order = np.cumsum(sizes) - sizes, np.argsort(sizes, kind="stable")
    for n in np.unique(sizes[sizes > 0]).tolist():
        same = order[np.searchsorted(sizes[order], n) : np.searchsorted(sizes[order], n, side="right")]
        most = max(1, GRID_CELLS // ((n + 1) * min(n, longest)))
        for at in range(0, len(same), most):
            some = same[at : at + most]
            yield some, codes[first[some] + np.arange(n)[:, None]]


def _hashes(grid: np.ndarray, longest: int, base: int) -> Iterator[tuple[int, np.ndarray]]:
    """``k`` and the hashes of the stretches of ``k`` characters from every place of the words of a grid."""
    n = len(grid)
    h = np.zeros(grid.shape, np.uint64)
    for k in range(1, min(n, longest) + 1):
        h = h[: n - k + 1] * np.uint64(base) + grid[k - 1 :] + np.uint64(1)
        x = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        yield k, x ^ (x >> np.uint64(31))


@dataclass
class PieceIndex:
    """Numbers of pieces by the hash of their characters: sorted hashes, and where those with equal leading bits begin."""

    keys: np.ndarray
    place: np.ndarray
    first: np.ndarray
    bits: int
    base: int
    longest: int

    @classmethod
    def of(cls, pieces: list[str]) -> PieceIndex:
        longest = max(map(len, pieces))
        base = HASH_BASE
        while True:
            keys = np.zeros(len(pieces), np.uint64)
            for some, grid in _grids(pieces, 1):
                for k, h in _hashes(grid, len(grid), base):
                    if k == len(grid):
                        keys[some] = h[0]
            place = np.argsort(keys)
            keys = keys[place]
            if (keys[1:] != keys[:-1]).all():
                break
            base += 2  # two pieces with one hash
        bits = max(8, len(pieces).bit_length() + 1)
        first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        return cls(keys, place.astype(np.int32), np.append(first, len(keys)).astype(np.int32), bits, base, longest)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the piece with each hash, -1 for none."""
        wanted = hashes.ravel()
        slot = (wanted >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.first[slot], self.first[slot + 1]
        out, open_ = np.full(len(wanted), -1, np.int32), np.flatnonzero(at < stop)
        while len(open_):
            hit = self.keys[at[open_]] == wanted[open_]
            out[open_[hit]] = self.place[at[open_[hit]]]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < stop[open_]]
        return out.reshape(hashes.shape)

    def lattice(self, grid: np.ndarray) -> np.ndarray:
        """Numbers of the pieces of ``k`` characters that end before place ``j``: (``j``, ``k - 1``, word)."""
        out = np.full((len(grid) + 1, min(len(grid), self.longest), grid.shape[1]), -1, np.int32)
        for k, h in _hashes(grid, self.longest, self.base):
            out[k:, k - 1] = self.find(h)
        return out


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=0)
    base = np.where(np.isneginf(top), 0.0, top)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - base).sum(axis=0)) + base


def _forward(steps: np.ndarray, join) -> np.ndarray:
    """For every place, ``join`` over all segmentations of what stands before it."""
    left = np.full((len(steps), steps.shape[2]), -np.inf)
    left[0] = 0.0
    for j in range(1, len(left)):
        k = min(j, steps.shape[1])
        left[j] = join(left[j - k : j][::-1] + steps[j, :k])
    return left


def _scored(found: np.ndarray, scores: np.ndarray) -> np.ndarray:
    return np.where(found >= 0, scores[found], -np.inf)


def expected_uses(grid: np.ndarray, index: PieceIndex, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of pieces, the words of a grid and the expected use of the piece there, over all segmentations."""
    found = index.lattice(grid)
    steps = _scored(found, scores)
    left, n = _forward(steps, _log_sum), len(grid)
    right = np.full(left.shape, -np.inf)
    right[n] = 0.0
    for i in range(n - 1, -1, -1):
        k = np.arange(1, min(n - i, steps.shape[1]) + 1)
        right[i] = _log_sum(steps[i + k, k - 1] + right[i + k])
    j, k, word = np.nonzero(found >= 0)
    whole = left[n, word]
    share = left[j - k - 1, word] + steps[j, k, word] + right[j, word]
    good = ~np.isneginf(whole) & ~np.isneginf(share)
    return found[j, k, word][good], word[good], np.exp(share[good] - whole[good])


def expected_counts(word: str, scores: dict[str, float], longest: int) -> list[tuple[str, float]]:
    """Expected use of each piece in one word, over all its segmentations."""
    pieces = [p for p in scores if len(p) <= longest]
    index, values = PieceIndex.of(pieces), np.array([scores[p] for p in pieces])
    parts = [expected_uses(grid, index, values) for _, grid in _grids([word], longest)]
    return [(pieces[i], x) for found, _, share in parts for i, x in zip(found.tolist(), share.tolist())]


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _numbers(table: pa.Table, column: str, n: int) -> np.ndarray:
    """Values by piece number, 0 for pieces without a row."""
    out = np.zeros(n)
    out[table["piece"].to_numpy()] = table[column].to_numpy()
    return out


def expectation(words: DataFrame, index: PieceIndex, scores: np.ndarray) -> np.ndarray:
    """E-step: expected count of every piece.  A task adds up its words; at most a row a piece leaves it."""
    model = words.sparkSession.sparkContext.broadcast((index, scores))  # at most seeds + characters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, scores = model.value
        total = np.zeros(len(scores))
        for batch in batches:
            counts = batch.column("cnt").to_numpy()
            for some, grid in _grids(_strings(batch.column("word")), index.longest):
                found, word, share = expected_uses(grid, index, scores)
                total += np.bincount(found, weights=share * counts[some[word]], minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.record_batch({"piece": pa.array(used.astype(np.int32)), "expected": pa.array(total[used])})

    parts = words.select("word", F.col("cnt").cast("double")).mapInArrow(run, "piece int, expected double")
    sums = parts.groupBy("piece").agg(F.sum("expected").alias("expected")).toArrow()  # at most seeds + characters
    model.unpersist()
    return _numbers(sums, "expected", len(scores))


def best_others(grid: np.ndarray, index: PieceIndex, scores: np.ndarray) -> np.ndarray:
    """Score of the most likely segmentation of each word of a grid into pieces that are not the whole word."""
    steps = _scored(index.lattice(grid), scores)
    if len(grid) <= steps.shape[1]:
        steps[len(grid), len(grid) - 1] = -np.inf
    return _forward(steps, lambda x: x.max(axis=0))[-1]


def likelihood_losses(seeds: DataFrame, index: PieceIndex, scores: np.ndarray, use: np.ndarray) -> np.ndarray:
    """What the log likelihood of the words loses if a piece goes and each of its uses becomes its most likely
    segmentation into the others; ``seeds`` holds every piece of the index, and others that are passed over."""
    model = seeds.sparkSession.sparkContext.broadcast((index, scores, use))  # at most seeds + characters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, scores, use = model.value
        for batch in batches:
            for _, grid in _grids(_strings(batch.column("piece")), index.longest):
                for k, h in _hashes(grid, len(grid), index.base):
                    whole = h
                own = index.find(whole[0])
                held = own >= 0
                own = own[held]
                loss = use[own] * (scores[own] - best_others(grid[:, held], index, scores))
                yield pa.record_batch({"piece": pa.array(own), "loss": pa.array(loss)})

    found = seeds.select("piece").mapInArrow(run, "piece int, loss double").toArrow()
    model.unpersist()
    return _numbers(found, "loss", len(scores))


def train_unigram(
    words: DataFrame,
    vocab_size: int,
    n_seeds: int = 1_000_000,
    rounds: int = 2,
    keep: float = 0.75,
    longest: int = 16,
    min_count: int = 2,
) -> DataFrame:
    """Pieces with log probabilities, pruned step by step until at most ``vocab_size`` are left.

    Each step re-estimates ``rounds`` times over all words, then keeps the share ``keep`` of the pieces of two
    or more characters whose loss would cost the most likelihood.  Parameters of the method: ``longest``
    characters of a piece and ``n_seeds`` candidates seen ``min_count`` times or more (they bound the table that
    goes to the tasks).  Characters always stay, so every word keeps a segmentation (and a vocabulary has at
    least one piece per character).  Null and empty words count for nothing; no words give no pieces.
    """
    spark = words.sparkSession
    # a fixed number of partitions: the tables are small in bytes but their passes are CPU work
    tasks = spark.sparkContext.defaultParallelism
    words = written(words.filter(F.length("word") > 0).repartition(tasks), "unigram-words")
    seeds = written(seed_pieces(words, n_seeds, longest, min_count).repartition(tasks), "unigram-seeds")
    table = seeds.toArrow()  # bounded: characters + n_seeds
    if not len(table):
        return spark.createDataFrame([], "piece string, score double")
    rows = sorted(zip(table["piece"].to_pylist(), table["cnt"].to_pylist()))
    pieces = np.array([p for p, _ in rows], dtype=object)
    shares = np.array([c for _, c in rows])
    scores = np.log(shares / shares.sum())
    single = np.array([len(p) == 1 for p in pieces])
    room = max(vocab_size - int(single.sum()), 0)

    def estimated(use: np.ndarray) -> np.ndarray:
        shares = np.maximum(use, 1e-3)
        return np.log(shares / shares.sum())

    while True:
        index = PieceIndex.of(pieces.tolist())
        use = np.zeros(len(pieces))
        for _ in range(rounds):
            use = expectation(words, index, scores)
            scores = estimated(use)
        longer = np.flatnonzero(~single)
        if len(longer) <= room:
            break
        losses = likelihood_losses(seeds.filter(F.length("piece") > 1), index, scores, use)[longer]
        longer = longer[np.argsort(-losses, kind="stable")]  # pieces stand in order, so ties go to the smaller one
        left = longer[: max(room, min(int(len(longer) * keep), len(longer) - 1))]
        kept = np.sort(np.concatenate([np.flatnonzero(single), left]))
        pieces, single, scores = pieces[kept], single[kept], estimated(use[kept])
    order = np.argsort(-scores, kind="stable")
    rows = list(zip(pieces[order].tolist(), scores[order].tolist()))
    return spark.createDataFrame(rows, "piece string, score double")
