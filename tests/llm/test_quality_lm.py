"""Counts of the quality rules, held-out accuracy, and normalised probabilities of the language model."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from odd_rows import frame, no_docs, no_labels, odd_docs, some_labels, texts, words
from tokenloom.llm import lm, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again)


EXTRA = [
    (400, "a b c d e a b c d e f\nx\nx\n x\n\n\nx", "en", "s", 1),
    (401, "| # * | é|ü <> $%&\n\n", "en", "s", 1),
    (402, "\n\n", "en", "s", 1),
    (403, "a\n", "en", "s", 1),
]


def test_base_counts(spark):
    rows = [*texts(), *EXTRA]
    found = quality.judged(frame(spark, rows), some_labels(spark)).collect()
    wanted = Counter((r[0], *plain_counts(r[1])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == wanted
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_without_labels_only_the_base_rules_decide(spark):
    found = quality.judged(odd_docs(spark), no_labels(spark)).collect()
    assert all(r.kept != r.base_failed for r in found)
    assert quality.judged(no_docs(spark), no_labels(spark)).count() == 0
    assert quality.keep_good(no_docs(spark), some_labels(spark)).columns == no_docs(spark).columns


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    learn = labels.filter("doc_id % 4 <> 0")
    truth = {r.doc_id: r for r in labels.filter("doc_id % 4 = 0").collect()}
    found = {r.doc_id: r for r in quality.judged(docs, learn).collect()}
    clean = [i for i, t in truth.items() if t.quality == 1 and t.toxic == 0 and not found[i].base_failed]
    bad = [i for i, t in truth.items() if t.quality == 0]
    assert np.mean([found[i].kept for i in clean]) > 0.97
    assert np.mean([found[i].kept for i in bad]) < 0.03
    p = np.array([found[i].p_quality for i in truth])
    assert abs(p.mean() - np.mean([t.quality for t in truth.values()])) < 0.08


def test_base_scores(spark):
    rows = texts()
    found = lm.score_texts(odd_docs(spark), classes=20, head=30).collect()
    tokens = [(r[0], [w.lower() for w in WORD.findall(r[1] or "")]) for r in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in tokens]
    counts = Counter()
    for (_, words), h in zip(tokens, held):
        if not h:
            counts.update([*words, None])
    n, v = sum(counts.values()), len(counts)
    wanted = Counter()
    for (i, words), h in zip(tokens, held):
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words, None])
        wanted[i, h, len(words) + 1, sum(counts[w] > 0 for w in [*words, None]), n, round(score, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == wanted
    assert all(r.score < 0 for r in found)


def plain_model(vocabulary, parameters, counts):
    """Probability of a word (None: end of text) after the words before it, one score at a time."""
    own = vocabulary.words[: vocabulary.class_words]
    classes = {w: i for i, w in enumerate(own)}
    end = len(parameters["b"]) - 1
    beyond = Counter()
    for w, n in counts.items():
        if w not in classes:
            beyond[ending(vocabulary, w)] += n + 1

    def class_of(word):
        return end if word is None else classes.get(word, len(own) + ending(vocabulary, word))

    def probability(before, word):
        two, one = [class_of(w) for w in [None, None, *before]][-2:]
        hidden = parameters["r"][one] * parameters["c"][0] + parameters["r"][two] * parameters["c"][1]
        exps = [math.exp(sum(float(h) * float(q) for h, q in zip(hidden, row)) + float(b)) for row, b in zip(parameters["q"], parameters["b"])]
        share = 1.0
        if word is not None and word not in classes:
            share = (counts.get(word, 0) + 1) / (beyond[ending(vocabulary, word)] + 1)
        return exps[class_of(word)] / sum(exps) * share

    return probability


def ending(vocabulary, word):
    return int(lm.word_endings([word], vocabulary.endings)[0])


def test_probabilities_of_all_words_add_up_to_one(spark):
    train = frame(spark, [(i, "a a b c d e a b a\nf", "", "", 1) for i in range(6)])
    counts = {bytes(r.word): r.n for r in lm.count_words(train).collect()}
    vocabulary = lm.learn_vocabulary(lm.count_words(train), 6, classes=6, head=100)
    probability = plain_model(vocabulary, lm.train(train, vocabulary), counts)
    unseen = {}
    for i in range(100):
        unseen.setdefault(ending(vocabulary, b"unseen%d" % i), b"unseen%d" % i)
    assert len(unseen) == vocabulary.endings == 3 and vocabulary.class_words == 2
    for before in ([], [b"a"], [b"zz", b"b"]):
        assert abs(sum(probability(before, w) for w in [*counts, *unseen.values(), None]) - 1) < 1e-4


def test_scores_equal_a_plain_model(spark):
    docs = odd_docs(spark)
    training = docs.filter(~lm.is_held_out(docs.doc_id))
    table = lm.count_words(training)
    counts = {bytes(r.word): r.n for r in table.collect()}
    vocabulary = lm.learn_vocabulary(table, training.count(), classes=24, head=30)
    assert 0 < vocabulary.class_words < len(vocabulary.words) < len(counts)
    parameters = lm.train(training, vocabulary, rounds=2)
    probability, wanted = plain_model(vocabulary, parameters, counts), Counter()
    known = {}
    for doc_id, text, *_ in texts():
        words = [*(w.lower().encode() for w in WORD.findall(text or "")), None]
        total = 0.0
        for i, word in enumerate(words):
            key = (*[None, None, *words[:i]][-2:], word)
            if key not in known:
                known[key] = math.log10(probability(words[max(0, i - 2) : i], word))
            total += known[key]
        wanted[doc_id, round(total, 1)] += 1
    found = lm.score_with(docs, table, vocabulary, parameters).collect()
    for r in found:
        near = [k for k in wanted if k[0] == r.doc_id and abs(k[1] - r.score) < 0.06 + 1e-5 * abs(r.score)]
        assert near and wanted[near[0]] > 0
        wanted[near[0]] -= 1
    assert not +wanted


def test_words_of_any_length_and_sums_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN_IN", 2)
    monkeypatch.setattr(lm, "HEAD_BYTES", 5)
    rows = [(i, f"aa bb {'long' * 50} aa", "", "", 1) for i in range(20)]
    docs = frame(spark, rows).repartition(9)
    vocabulary = lm.learn_vocabulary(lm.count_words(docs), 20, classes=8)
    assert vocabulary.words == [b"aa", b"bb"] and vocabulary.tokens == 100
    split, whole = lm.train(docs, vocabulary), lm.start_parameters(vocabulary.class_counts())
    assert all(split[k].shape == whole[k].shape and np.isfinite(split[k]).all() for k in "rqcb")
    parts = spark.range(9, numPartitions=9).selectExpr("id AS seen").collect()
    blobs = spark.createDataFrame([(r.seen, np.array([1.0, r.seen]).tobytes()) for r in parts], "seen bigint, flat binary").repartition(9)
    sums = lm.added_up(blobs, 9)
    assert len(sums) <= 2 and sum(s for s, _ in sums) == 36 and np.sum([f for _, f in sums], axis=0).tolist() == [9.0, 36.0]
    assert len({round(r.score, 9) for r in lm.score_texts(docs, classes=8).collect()}) == 1


def test_model_learns_order_on_held_out_texts(spark):
    rng = np.random.default_rng(0)
    follow = {w: f"w{(int(w[1:]) * 5 + 3) % 40}" for w in (f"w{i}" for i in range(40))}
    rows = []
    for i in range(400):
        words = [f"w{rng.integers(40)}"]
        while len(words) < 60:
            words.append(follow[words[-1]] if rng.random() < 0.9 else f"w{rng.integers(40)}")
        rows.append((i, " ".join(words), "", "", 1))
    found = [r for r in lm.score_texts(frame(spark, rows).coalesce(1), rounds=12).collect() if r.held_out]
    assert sum(r.score for r in found) > 0.7 * sum(r.base_score for r in found)


def test_no_rows(spark):
    assert lm.score_texts(no_docs(spark)).count() == 0


def test_labels_of_one_class_say_so_for_every_text(spark):
    rows = [(i, words(random.Random(i), 30), "en", "s", 1) for i in range(60)]
    for mark in (0, 1):
        labels = spark.createDataFrame([(i, mark, 0) for i in range(50)], "doc_id bigint, quality int, toxic int")
        found = quality.judged(frame(spark, rows), labels).collect()
        assert {r.kept for r in found} == {mark == 1} and len(found) == 60
        assert all((r.p_quality >= 0.5) == (mark == 1) and r.p_toxic < 0.5 for r in found)
