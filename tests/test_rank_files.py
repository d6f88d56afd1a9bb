"""Rank-file tokenizers against a tokenizer library and plain Python."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.functions.text import RANK_PATTERN
from tokenloom.operators import rank_files as rf
from tokenloom.operators.registry import build_tokenizer
from tokenloom.plans.catalog import table

tiktoken = pytest.importorskip("tiktoken")
PATH = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.tiktoken")
ODD = [
    "", " ", "\n\n  \t x", "it's 12345 o'clock", "naïve 😀😀 日本語テキスト", "é" * 300, "a" * 5000, "ab" * 900 + "😀",
    "x<|end_of_text|>y", "<|begin_of_text|><|reserved_special_token_7|> z", "<|no_such|> <|end_of_text|", "\x1c\x1d 　!?",
]


@pytest.fixture(scope="module")
def ranks():
    return rf.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding(
        "ranks", pat_str=RANK_PATTERN.removeprefix("(?U)"), mergeable_ranks=ranks, special_tokens=rf.special_ids(len(ranks))
    )


def places(library, text, ids):
    """Start of each token by going through its bytes."""
    starts, n = [], 0
    for token in library.decode_tokens_bytes(ids):
        inside = 0x80 <= token[0] < 0xC0
        starts.append(max(0, n - inside))
        n += len([b for b in token if not 0x80 <= b < 0xC0])
    return starts, [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


def test_merges_as_one_by_one(ranks):
    rng = random.Random(5)
    for _ in range(300):
        word = bytes(rng.choice(b"abcent \xc3\xa9") for _ in range(rng.randrange(40)))
        parts = [word[i : i + 1] for i in range(len(word))]
        while True:
            joins = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not joins:
                break
            i = min(joins)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert rf.merge_bytes(word, ranks) == parts or rf.merge_bytes(word, ranks) == [word] and word in ranks


def test_tokens_and_places(spark, ranks, library):
    small = [r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").select("text").collect()]
    df = spark.createDataFrame(list(enumerate([*ODD, *small, None])), "id long, text string")
    rows = df.select("id", "text", rf.rank_tokens(spark, F.col("text"), ranks).alias("t")).collect()
    for r in rows:
        ids = library.encode(r["text"] or "", allowed_special="all")
        starts, pieces = places(library, r["text"] or "", ids)
        assert (r["t"]["ids"], r["t"]["starts"], r["t"]["pieces"]) == (ids, starts, pieces)
        assert "".join(r["t"]["pieces"]) == (r["text"] or "")
    assert len(rows) == len(ODD) + len(small) + 1


def test_registered_tokenizer(spark, ranks, library):
    df = spark.createDataFrame([(t,) for t in [*ODD, None]], "text string")
    specials = rf.special_ids(len(ranks))
    for r in df.select("text", build_tokenizer("ranks", spark, path=PATH)(F.col("text")).alias("ids")).collect():
        own = library.encode_ordinary(r["text"] or "")
        assert r["ids"] == [specials["<|begin_of_text|>"], *own, specials["<|end_of_text|>"]]
    cut = df.select("text", rf.rank_ids(spark, F.col("text"), ranks, slice_chars=7).alias("ids")).collect()
    for r in cut:
        t = r["text"] or ""
        assert r["ids"] == [i for a in range(0, len(t), 7) for i in library.encode_ordinary(t[a : a + 7])]


def test_batches_are_worked_on_in_bounded_runs(monkeypatch):
    monkeypatch.setattr(rf, "RUN_WORDS", 10)
    rows = [["a"] * n for n in (3, 7, 1, 0, 25, 0, 2)] + [None, ["b"] * 9]
    runs = list(rf.row_runs(iter([pa.array(rows, pa.list_(pa.string())), pa.array([], pa.list_(pa.string())), pa.array([["c"]])])))
    assert [r for run in runs for r in run] == [*(r or [] for r in rows), ["c"]]
    assert all(len(run) == 1 or sum(map(len, run)) <= 10 for run in runs) and len(runs) < 7


def test_no_rank_file(tmp_path):
    with pytest.raises(ValueError):
        rf.read_ranks(str(tmp_path / "none"))
