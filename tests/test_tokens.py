"""Token functions, packing and fill-in-the-middle against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.functions import tokens as tk
from tokenloom.operators import corpus as cp
from tokenloom.operators import packing as pk

ODD = ["", " ", "\t\n", " ", "\x1c\x1d", "a", " a ", "é😀ß", "x　", "​", "<s>hi</s>", "</<s>s>"]


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id long, text string")


def test_blank_and_strip_follow_python(spark):
    df = texts(spark, ODD)
    kept = {r["text"] for r in cp.keep_nonblank(df).collect()}
    assert kept == {t for t in ODD if t.strip()}
    stripped = {r["id"]: r["s"] for r in df.select("id", tx.strip(F.col("text")).alias("s")).collect()}
    assert stripped == {i: t.strip() for i, t in enumerate(ODD)}


def test_null_text_is_dropped(spark):
    df = spark.createDataFrame([(None,), ("a",)], "text string")
    assert cp.keep_nonblank(df).count() == 1


def test_text_or_content(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("c", "d")], "text string, content string")
    body = tx.text_or_content(F.col("text"), F.col("content"))
    assert [r[0] for r in df.select(body).collect()] == ["a", "b", "c"]
    with pytest.raises(Exception, match="neither text nor content"):
        spark.createDataFrame([(None, None)], "text string, content string").select(body).collect()


def test_byte_round_trip_and_bad_bytes(spark):
    df = texts(spark, ODD).select("text", tk.byte_tokens(F.col("text")).alias("t"))
    for r in df.select("text", "t", tk.byte_text(F.col("t")).alias("back")).collect():
        assert r["t"] == [256, *r["text"].encode(), 257]
        assert r["back"] == r["text"]
    bad = [[0xFF, 65], [0xE2, 0x82, 66], [0xC3, 0xA9, 0x80], [0xED, 0xA0, 0x80], [0, 0xF0, 0x9F]]
    rows = spark.createDataFrame([(b,) for b in bad], "t array<int>").select("t", tk.byte_text(F.col("t")).alias("s"))
    for r in rows.collect():
        assert r["s"] == bytes(r["t"]).decode("utf-8", errors="backslashreplace")


def test_byte_offsets(spark):
    for r in texts(spark, ODD).select("text", tk.byte_offsets(F.col("text")).alias("o")).collect():
        assert r["o"] == [i for i, c in enumerate(r["text"]) for _ in c.encode()]


def test_pretokens_lose_nothing(spark):
    df = texts(spark, [*ODD, "It's  1234 well-known\r\n\n  x/y !!\n"])
    for r in df.select("text", tx.pretokens(F.col("text")).alias("p")).collect():
        assert "".join(r["p"]) == r["text"]
    special = df.select("text", tx.split_specials(F.col("text"), ["<s>", "</s>"]).alias("p")).collect()
    for r in special:
        assert "".join(r["p"]) == r["text"]
    assert next(r["p"] for r in special if r["text"] == "<s>hi</s>") == ["<s>", "hi", "</s>"]


def sequential_windows(sequences, length, step):
    stream = [t for s in sequences for t in s]
    return {k: stream[k * step : k * step + length] for k in range(len(stream)) if k * step + length <= len(stream)}


@pytest.mark.parametrize("length,step,parts", [(9, 8, 1), (5, 5, 7), (12, 4, 64), (3, 7, 7)])
def test_packing_is_the_sequential_packer(spark, length, step, parts):
    rng = random.Random(length)
    rows = [(i, i % 3 if rng.random() < 0.5 else 0, [rng.randrange(300) for _ in range(rng.choice([0, 1, 2, 5, 40]))]) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, shard int, t array<int>").repartition(parts)
    from tokenloom.operators.ordering import offset_by_id

    placed = offset_by_id(df, F.size("t"), "id", "start", ["shard"])
    got = pk.cut_windows(placed, "t", "start", length, step, ["shard"]).collect()
    for shard in {r[1] for r in rows}:
        want = sequential_windows([t for _, s, t in rows if s == shard], length, step)
        assert {r["window_id"]: r["window"] for r in got if r["shard"] == shard} == want


def test_split_by_end_token_loses_nothing(spark):
    rng = random.Random(4)
    rows = [([rng.choice([1, 5, 6, 7]) for _ in range(rng.randrange(15))],) for _ in range(100)] + [([],), ([1],), ([1, 1],)]
    df = spark.createDataFrame(rows, "t array<int>").select("t", tk.split_by_end_token(F.col("t"), 1).alias("c"))
    for r in df.collect():
        assert [x for c in r["c"] for x in c] == r["t"]
        assert all(1 not in c[:-1] for c in r["c"])


@pytest.mark.parametrize("truncate", [False, True])
def test_fill_in_middle(spark, truncate):
    rows = [(i, [256, *range(1, n + 1), 257]) for i, n in enumerate([0, 1, 2, 3, 4, 5, 9, 30] * 12)]
    rows += [(1000 + i, list(range(1, n + 1))) for i, n in enumerate([0, 1, 2, 3, 10])]
    df = spark.createDataFrame(rows, "id long, t array<int>")
    out = df.select("t", tk.fill_in_middle(F.col("t"), [F.col("id")], 7, 1.0, truncate=truncate).alias("f")).collect()
    changed = 0
    for r in out:
        t, f = r["t"], r["f"]
        if len(t) < 3:
            assert f == t
            continue
        if truncate:
            assert len(f) == len(t)
        if f == t:
            continue
        changed += 1
        assert (f[0] == 256) == (t[0] == 256) and (f[-1] == 257) == (t[-1] == 257)
        body = [x for x in f if x not in (256, 257)]
        p, s, m = (body.index(x) for x in (258, 259, 260))
        assert p == 0 and s < m
        prefix, suffix, middle = body[1:s], body[s + 1 : m], body[m + 1 :]
        original = [x for x in t if x not in (256, 257)]
        whole = prefix + middle + suffix
        assert whole == original[: len(whole)] and len(whole) == len(original) - (3 if truncate else 0)
    assert changed > 10


def test_fim_rate_zero_changes_nothing(spark):
    df = spark.createDataFrame([(1, [256, 1, 2, 3, 257])], "id long, t array<int>")
    assert df.select(tk.fill_in_middle(F.col("t"), [F.col("id")], 7, 0.0)).first()[0] == [256, 1, 2, 3, 257]


def test_labels_keep_the_pad_id_at_the_last_place(spark):
    df = spark.createDataFrame([([5, 6],), ([7],)], "ids array<int>")
    got = [r[0] for r in df.select(tk.next_token_labels(F.col("ids"), F.lit(3), 0)).collect()]
    assert got == [[6, 0, -100], [0, -100, -100]]


def test_long_text_slices(spark):
    df = texts(spark, ["", "abc", "é" * 10])
    for r in df.select("text", tk.split_long_text(F.col("text"), 4).alias("p")).collect():
        assert "".join(r["p"]) == r["text"] and all(len(p) <= 4 for p in r["p"])


@pytest.mark.parametrize("length,step,chunk,cut", [(9, 8, 1 << 19, 1 << 19), (5, 5, 7, 11), (40, 4, 1, 1), (3, 7, 16, 9)])
def test_byte_windows_are_those_of_the_tokens(spark, monkeypatch, length, step, chunk, cut):
    monkeypatch.setattr(pk, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(pk, "CUT_TOKENS", cut)
    rng = random.Random(length)
    words = ["", "a", "é", "\U0001f600 zero", "x" * 50, "line\nline", None]
    rows = [(i, i % 3, rng.choice(words)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, shard int, text string").repartition(5)
    got = pk.pack_text(df, "text", None, tk.byte_token_count(F.col("text")), "id", step, length - step + 1, ["shard"], step=step).collect()
    for shard in range(3):
        tokens = [[256, *t.encode(), 257] for _, s, t in rows if s == shard and t is not None]
        assert {r["window_id"]: r["window"] for r in got if r["shard"] == shard} == sequential_windows(tokens, length, step)


def test_byte_windows_go_on_behind_held_pieces(spark):
    fresh = spark.createDataFrame([(0, 5, "abcdefgh"), (1, 0, "xyz")], "shard int, s long, text string")
    held = spark.createDataFrame([(0, 2, [7, 8, 9]), (2, 0, [1])], "shard int, s long, t array<int>")
    got = {(r["shard"], r["window_id"]): r["window"] for r in pk.cut_byte_windows(fresh, "text", "s", 6, 2, ["shard"], held).collect()}
    stream = [7, 8, 9, 256, *b"abcdefgh", 257]
    wanted = {(0, k): stream[2 * k - 2 : 2 * k + 4] for k in range(1, 5)}
    assert {k: v for k, v in got.items() if k[0] == 0} == wanted
    assert not any(k[0] == 2 for k in got)


def test_packing_queries_build_no_token_arrays_of_whole_texts(spark):
    df = spark.createDataFrame([(1, "text")], "id long, text string")
    plan = pk.pack_text(df, "text", None, tk.byte_token_count(F.col("text")), "id", 4, 2)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ascii" not in plan


def test_window_sums_are_those_of_the_expressions(spark):
    from tokenloom.functions import arrays as ar

    rows = [([5, 6, 7],), ([],), (None,), ([257] * 300,)]
    df = spark.createDataFrame(rows, "t array<int>").repartition(1)
    t = F.col("t")
    for r in df.select(ar.window_sum(t), ar.array_sum(t), ar.window_checksum(t), ar.checksum(t)).collect():
        assert r[0] == r[1] and r[2] == r[3]
