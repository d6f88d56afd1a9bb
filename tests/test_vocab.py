"""Vocabulary training and encoding against plain Python."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import bytechars as bc
from tokenloom.functions import text as tx
from tokenloom.operators import bpe, unigram
from tokenloom.operators import vocab as vb
from tokenloom.operators.registry import build_tokenizer, register_tokenizer


def one_by_one(counts, n):
    """Textbook training: recount, take the best pair, rewrite, repeat."""
    words = {w: list(w) for w in counts}
    merges = []
    while len(merges) < n:
        pairs = Counter()
        for w, s in words.items():
            for p in zip(s, s[1:]):
                pairs[p] += counts[w]
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        merges.append(best)
        for w, s in words.items():
            out, i = [], 0
            while i < len(s):
                if i + 1 < len(s) and (s[i], s[i + 1]) == best:
                    out.append(s[i] + s[i + 1])
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            words[w] = out
    return merges


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abcd"), (3, "abcdefgh")])
def test_training_takes_the_same_merges_as_one_by_one(spark, seed, letters):
    rng = random.Random(seed)
    counts = Counter("".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(80))
    df = spark.createDataFrame(list(counts.items()), "word string, cnt long")
    state = df.select(bpe.initial_symbols(F.col("word")).alias("symbols"), "cnt")
    assert bpe.train_merges(state, 25, candidates=16, passes_per_checkpoint=3) == one_by_one(counts, 25)


def test_pairs_of_few_and_of_many_symbols_count_alike():
    names = ["a", "b", "c"]
    found = {}
    rows = [([0, 1, 0, 1], 3), ([2], 9), ([], 1), ([1, 2, 0, 1], 2)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows])], names=["ids", "cnt"])
    for size in (0, 1024):
        out = list(bpe._count_pairs(iter([batch, batch]), [], names, size))[0].to_pylist()
        found[size] = {(r["left"], r["right"]): r["cnt"] for r in out}
    assert found[0] == found[1024] == {("a", "b"): 16, ("b", "a"): 6, ("b", "c"): 4, ("c", "a"): 4}


def test_training_writes_no_table_a_pass(spark, monkeypatch):
    names, write = [], bpe.written
    monkeypatch.setattr(bpe, "written", lambda df, name: names.append(name) or write(df, name))
    df = spark.createDataFrame([(list("abcabcd"), 3), (list("abab"), 2), (list("ddd"), 5)], "symbols array<string>, cnt long")
    merges = bpe.train_merges(df, 6)
    assert len(merges) == 6 and names == ["bpe-symbols", "bpe-words"]


def test_merges_in_one_array():
    rng = random.Random(2)
    words = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(200)]
    merges = [(0, 0, 3), (3, 3, 4), (1, 2, 5), (5, 0, 6), (2, 2, 7)]
    ids, word = np.concatenate(words), np.repeat(np.arange(200), list(map(len, words)))
    got, of = bpe._merged(ids, word, merges)
    for i, parts in enumerate(words):
        for a, b, new in merges:
            out = []
            for x in parts:  # left to right, a merged symbol is not merged again by the same merge
                if out and out[-1] == (a, False) and x == b:
                    out[-1] = (new, True)
                else:
                    out.append((x, False))
            parts = [x for x, _ in out]
        assert got[of == i].tolist() == parts


def test_byte_fallback(spark):
    df = spark.createDataFrame([("aé",)], "w string").select(bpe.initial_symbols(F.col("w"), ["a"]).alias("s"))
    assert df.first()[0] == ["a", "<0xC3>", "<0xA9>"]


def test_control_characters_are_symbols_like_others(spark):
    counts = Counter({"a\u0001b": 3, "\u0001\u0001": 2, "ab": 2})
    df = spark.createDataFrame(list(counts.items()), "word string, cnt long")
    state = df.select("word", bpe.initial_symbols(F.col("word")).alias("symbols"), "cnt")
    found = {(r["left"], r["right"]): (r["cnt"], r["n_words"]) for r in bpe.pair_words(state).collect()}
    assert found == {("a", "\u0001"): (3, 1), ("\u0001", "b"): (3, 1), ("\u0001", "\u0001"): (2, 1), ("a", "b"): (2, 1)}
    assert bpe.train_merges(state, 5) == one_by_one(counts, 5)


def test_documents_without_words_keep_their_row(spark):
    docs = spark.createDataFrame([(1, ""), (2, "ab ab"), (3, None)], "doc_id long, text string")
    found = bpe.encode_by_join(docs, "doc_id", tx.pretokens(F.col("text")), [("a", "b")])
    sizes = {r["doc_id"]: len(r["ids"]) for r in found.collect()}
    assert sizes == {1: 0, 2: 3, 3: 0}


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(9)
    words = ["hug", "pug", "burger", "mug", "café", "naïve", "😀!"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = vb.word_counts(docs, tx.pretokens(F.col("text")))
    state = counts.select(bpe.initial_symbols(bc.to_byte_chars(F.col("word"))).alias("symbols"), "cnt")
    return docs, bpe.train_merges(state, 30)


def test_join_and_udf_encode_alike_and_decode_back(spark, trained):
    docs, merges = trained
    a = docs.select("doc_id", "text", bpe.encode_text(spark, F.col("text"), merges).alias("ids"))
    b = bpe.encode_by_join(docs, "doc_id", tx.pretokens(F.col("text")), merges, hot_words=2)
    joined = {r["doc_id"]: r["ids"] for r in b.collect()}
    for r in a.withColumn("back", bpe.decode_ids(spark, F.col("ids"), merges)).collect():
        assert joined[r["doc_id"]] == r["ids"]
        assert r["back"] == r["text"]


def test_recovered_merges_are_the_trained_ones(spark, trained):
    _, merges = trained
    pieces = bpe.byte_vocab(merges)
    vocab = spark.createDataFrame([(p, i) for i, p in enumerate(pieces)], "piece string, rank int")
    rows = bpe.recover_merges(vocab, {p: i for i, p in enumerate(pieces)}).orderBy("rank").collect()
    assert [(r["left"], r["right"]) for r in rows] == merges


def test_show_work_agrees_with_the_encoder(spark, trained):
    docs, merges = trained
    work = bpe.show_work_udtf(merges, ["<s>"])
    marked = docs.limit(5).select("doc_id", F.concat(F.lit("<s>"), "text").alias("text"))
    rows = marked.select("doc_id", tx.split_specials(F.col("text"), ["<s>"]).alias("t")).lateralJoin(work(F.col("t").outer()))
    ids = {}
    for r in sorted(rows.collect(), key=lambda r: (r["doc_id"], r["n"])):
        ids.setdefault(r["doc_id"], []).extend(r["ids"])
        assert r["is_special"] == (r["token"] == "<s>")
    plain = {r["doc_id"]: r["ids"] for r in docs.select("doc_id", bpe.encode_text(spark, F.col("text"), merges).alias("ids")).collect()}
    special = len(bpe.byte_vocab(merges))
    assert all(v == [special, *plain[k]] for k, v in ids.items())


def test_byte_chars_round_trip(spark):
    assert len(set(bc.byte_chars())) == 256
    df = spark.createDataFrame([("\x00 é\n😀\x7f",)], "t string")
    shown = df.select(bc.to_byte_chars(F.col("t")).alias("s"), "t")
    r = shown.select("s", "t", bc.from_byte_chars(F.col("s")).alias("back")).first()
    assert r["s"] == "".join(bc.byte_chars()[b] for b in r["t"].encode()) and r["back"] == r["t"]


def test_expected_counts_over_all_segmentations():
    scores = {p: math.log(x) for p, x in {"a": 0.3, "b": 0.2, "ab": 0.25, "ba": 0.15, "aba": 0.1}.items()}
    word = "ababa"
    total, want = 0.0, Counter()
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[at:i])
                at = i
        parts.append(word[at:])
        if all(p in scores for p in parts):
            p = math.exp(sum(scores[x] for x in parts))
            total += p
            for x in parts:
                want[x] += p
    got = Counter()
    for piece, share in unigram.expected_counts(word, scores, 3):
        got[piece] += share
    assert set(got) == set(want)
    assert all(got[p] == pytest.approx(want[p] / total) for p in want)


def test_unigram_keeps_characters_and_size(spark):
    df = spark.createDataFrame([("hugging", 5), ("hug", 9), ("bug", 4)], "word string, cnt long")
    vocab = {r["piece"]: r["score"] for r in unigram.train_unigram(df, 10, 50).collect()}
    assert len(vocab) == 10 and set("huginb") <= set(vocab)
    assert sum(math.exp(s) for s in vocab.values()) == pytest.approx(1.0)
    assert unigram.train_unigram(df.limit(0), 10).count() == 0


def segmentations(word):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        at = [0, *[i for i, c in enumerate(cuts, 1) if c], len(word)]
        yield [word[a:b] for a, b in zip(at, at[1:])]


def plain_seeds(counts, n_seeds, longest):
    found = Counter()
    for w, c in counts.items():
        for i in range(len(w)):
            for j in range(i + 1, min(len(w), i + longest) + 1):
                found[w[i:j]] += c
    after = Counter()
    for p, c in found.items():
        if c >= 2:
            after[p[:-1]] = max(after[p[:-1]], c)
    longer = [p for p, c in found.items() if len(p) > 1 and c >= 2 and after[p] < c]
    longer.sort(key=lambda p: (-found[p] * len(p), p))
    return {p: found[p] for p in [*longer[:n_seeds], *[p for p in found if len(p) == 1]]}


def plain_unigram(counts, size, n_seeds, rounds, keep, longest):
    """The same training by listing every segmentation of every word and piece."""
    def logs(shares):
        return {p: math.log(c / sum(shares.values())) for p, c in shares.items()}

    scores = logs(plain_seeds(counts, n_seeds, longest))
    while True:
        for _ in range(rounds):
            use = Counter()
            for w, c in counts.items():
                fits = [(s, math.exp(sum(scores[p] for p in s))) for s in segmentations(w) if all(p in scores for p in s)]
                for s, share in fits:
                    for p in s:
                        use[p] += c * share / sum(x for _, x in fits)
            scores = logs({p: max(use[p], 1e-3) for p in scores})
        longer = [p for p in scores if len(p) > 1]
        room = max(size - (len(scores) - len(longer)), 0)
        if len(longer) <= room:
            return scores
        loss = {}
        for p in longer:
            others = [sum(scores[x] for x in s) for s in segmentations(p) if len(s) > 1 and all(x in scores for x in s)]
            loss[p] = use[p] * (scores[p] - max(others))
        longer.sort(key=lambda p: (-loss[p], p))
        kept = longer[: max(room, min(int(len(longer) * keep), len(longer) - 1))]
        scores = logs({p: max(use[p], 1e-3) for p in scores if len(p) == 1 or p in kept})


@pytest.mark.parametrize("seed,n_seeds,longest", [(1, 1000, 16), (2, 12, 4)])
def test_unigram_equals_training_over_all_segmentations(spark, seed, n_seeds, longest):
    rng = random.Random(seed)
    parts = ["low", "new", "est", "er", "wid", "é", "😀"]
    counts = {"".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))): rng.randrange(1, 30) for _ in range(25)}
    df = spark.createDataFrame([*counts.items(), ("", 3), (None, 2)], "word string, cnt long")
    want = plain_unigram(counts, 24, n_seeds, 2, 0.75, longest)
    got = {r["piece"]: r["score"] for r in unigram.train_unigram(df, 24, n_seeds, longest=longest).collect()}
    assert set(got) == set(want)
    assert all(got[p] == pytest.approx(want[p], abs=1e-9) for p in want)


def test_unigram_training_is_dealt_to_all_tasks(spark, monkeypatch):
    dealt = {}

    def noted(df, name):
        dealt[name] = df.rdd.getNumPartitions()
        return df

    monkeypatch.setattr(unigram, "written", noted)
    df = spark.createDataFrame([("hugging", 5), ("hug", 9), ("bug", 4)], "word string, cnt long").coalesce(1)
    unigram.train_unigram(df, 10, 50)
    assert dealt["unigram-words"] == dealt["unigram-seeds"] == spark.sparkContext.defaultParallelism > 1


def test_pieces_are_found_where_hashes_share_their_leading_bits():
    rng = random.Random(4)
    pieces = sorted({"".join(rng.choice("abc😀") for _ in range(rng.randrange(1, 7))) for _ in range(900)})
    index = unigram.PieceIndex.of(pieces)
    index.bits, index.first = 2, np.append(np.searchsorted(index.keys >> np.uint64(62), np.arange(4)), len(pieces)).astype(np.int32)
    words = ["".join(rng.choice("abcd😀") for _ in range(rng.randrange(12))) for _ in range(50)]
    for some, grid in unigram._grids(words, index.longest):
        found = index.lattice(grid)
        for w, word in enumerate(words[i] for i in some):
            for j in range(1, len(word) + 1):
                want = [word[j - k : j] if k <= j and word[j - k : j] in pieces else None for k in range(1, found.shape[1] + 1)]
                assert [pieces[i] if i >= 0 else None for i in found[j, :, w].tolist()] == want


def test_unigram_seeds_of_a_word_longer_than_a_block(spark):
    rng = random.Random(3)
    counts = {"".join(rng.choice("ab") for _ in range(700)): 2}
    df = spark.createDataFrame(list(counts.items()), "word string, cnt long")
    assert {r[0]: r[1] for r in unigram.seed_pieces(df, 10**6, 16).collect()} == plain_seeds(counts, 10**6, 16)


def test_counts_of_characters_and_bytes(spark, monkeypatch):
    monkeypatch.setattr(vb, "RUN_BYTES", 7)
    rows = ["", None, "a", "é😀 a\n", "x" * 50, "", "日本", None, "a b c d e f g h"]
    df = spark.createDataFrame([(t,) for t in rows], "text string").coalesce(1)
    every = "".join(t or "" for t in rows)
    assert {r["ch"]: r["cnt"] for r in vb.char_counts(df, F.col("text")).collect()} == Counter(every)
    assert {r["byte"]: r["cnt"] for r in vb.byte_counts(df, F.col("text")).collect()} == Counter(every.encode())
    assert vb.char_counts(df.limit(0), F.col("text")).count() == 0
    assert vb.byte_counts(df.filter("text IS NULL"), F.col("text")).count() == 0


def test_slots(spark):
    vocab = spark.createDataFrame([(f"<unused{i}>", i) for i in range(4)] + [("a", 4)], "piece string, id int")
    got = {r["id"]: r["piece"] for r in vb.assign_special_slots(vocab, ["<x>", "<y>"]).collect()}
    assert got == {0: "<unused0>", 1: "<unused1>", 2: "<y>", 3: "<x>", 4: "a"}
    with pytest.raises(ValueError):
        vb.assign_special_slots(vocab, list("wxyz"))


def test_numbers(spark):
    vocab = spark.createDataFrame([("07", 3), ("a", 9)], "piece string, id int")
    got = {r["piece"]: r["id"] for r in vb.extend_with_numbers(vocab).collect()}
    assert len(got) == 1101 and got["a"] == 9 and got["00"] == 10 and got["07"] == 17 and got["999"] == 1109
    assert ("07", "0") in {(r["left"] + r["right"], r["left"]) for r in vb.number_merges(spark).collect()}


def test_registry(spark):
    df = spark.createDataFrame([("hé",)], "t string")
    assert df.select(build_tokenizer("bytes", spark)(F.col("t"))).first()[0] == [256, 104, 195, 169, 257]
    register_tokenizer("letters", lambda spark: lambda text: F.split(text, ""))
    assert df.select(build_tokenizer("letters", spark)(F.col("t"))).first()[0] == ["h", "é"]
    with pytest.raises(NotImplementedError):
        build_tokenizer("none", spark)


def test_user_symbols():
    symbols = vb.user_symbols()
    assert len(symbols) == 1212 == len(set(symbols))
