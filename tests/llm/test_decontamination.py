"""Edited copies of test items against all alignments."""

import random

import pytest

from odd_rows import frame, words
from tokenloom.llm import decontamination
from test_other import plain_alignment


def edited(rng, item, rate):
    """Random words replaced, left out or preceded by another."""
    out = []
    for w in item.split():
        kind = rng.choice("rdi") if rng.random() < rate else "k"
        out += {"k": [w], "r": [f"x{rng.randrange(99)}"], "d": [], "i": [f"x{rng.randrange(99)}", w]}[kind]
    return " ".join(out)


def all_pairs(rows, items):
    wanted = {}
    for doc, text, *_ in rows:
        for i, item in items:
            words_of = item.lower().split()
            score = plain_alignment(words_of, text.lower().split()) / (2 * len(words_of))
            if score >= 0.5:
                wanted[doc, i] = round(score, 9)
    return wanted


def pairs_of(found):
    return {(r.doc_id, r.item_id): round(r.score, 9) for r in found.collect()}


def test_edited_copies_equal_all_alignments(spark):
    rng = random.Random(12)
    items = [(i, words(rng, rng.choice([3, 4, 8, 10, 25, 40]))) for i in range(24)]
    rows = []
    for i, item in items:
        for rate in (0.05, 0.1, 0.2, 0.3):
            text = f"{words(rng, 20)} {edited(rng, item, rate)} {words(rng, 20)}"
            rows.append((len(rows), text, "", "", 1))
    for i, item in items[:6]:
        w = item.split()
        for text in (" odd ".join(w), " ".join(x for k, x in enumerate(w) if k % 3 != 2), " ".join(w[: len(w) // 2 + 1])):
            rows.append((len(rows), f"{words(rng, 9)} {text}", "", "", 1))
    w = words(rng, 10).split()
    items.append((90, " ".join(w)))
    rows.append((900, " ".join(["start", *w[:7], "other", *w[8:], "end"]), "", "", 1))
    wanted = all_pairs(rows, items)
    assert pairs_of(decontamination.contaminated_pairs(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))) == wanted
    assert wanted[900, 90] == 0.85 and len(wanted) > 90


def test_scores_that_one_word_reaches_are_refused(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    with pytest.raises(ValueError):
        decontamination.contaminated_pairs(frame(spark, []), none, 0.3)


def test_items_of_equal_text_are_pairs_of_their_own(spark):
    text = words(random.Random(3), 12)
    table = spark.createDataFrame([(1, text), (2, text), (2, text)], "item_id bigint, text string")
    found = decontamination.contaminated_pairs(frame(spark, [(7, f"so {text} on", "", "", 1)]), table)
    assert sorted((r.doc_id, r.item_id, r.score) for r in found.collect()) == [(7, 1, 1.0), (7, 2, 1.0)]


def test_items_of_one_or_two_words_are_found_whole(spark):
    table = spark.createDataFrame(
        [(1, "cat sat"), (2, "Sat"), (3, "mat mat"), (4, ""), (5, None), (6, " \t"), (7, "on the cat")], "item_id bigint, text string"
    )
    rows = [
        (1, "the cat sat on", "", "", 1), (2, "cat on sat", "", "", 1), (3, "sat cat", "", "", 1), (4, "mat", "", "", 1),
        (5, "a MAT mat", "", "", 1), (6, None, "", "", 1), (7, "", "", "", 1), (8, "sat", "", "", 1), (9, "x " * 9000 + "cat sat", "", "", 1),
        (None, "cat sat", "", "", 1), (1, "the cat sat on", "", "", 1),
    ]
    found = decontamination.contaminated_pairs(frame(spark, rows), table).collect()
    short = sorted(((r.doc_id or 0, r.item_id) for r in found if r.item_id != 7))
    assert short == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (2, 2), (3, 2), (5, 3), (8, 2), (9, 1), (9, 2)]
    assert all(r.score == 1.0 for r in found if r.item_id != 7)
    kept = decontamination.keep_clean(frame(spark, rows), table.filter("item_id IN (1, 3)"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6, 7, 8]
