"""The near-dedup stage against all pairs of texts."""

import random
import time
from collections import Counter

import pytest

import corpus_pipeline
from odd_rows import frame, no_docs, texts, words
from tokenloom.llm import near_dedup


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_kept(rows):
    rows = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, x) in enumerate(rows):
        for j, (_, y) in enumerate(rows[:i]):
            if x == y or len(x & y) >= 0.8 * len(x | y):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return Counter(set(least.values()))


@pytest.mark.parametrize("often, sample, block", [(8, 16, 1024), (2, 1, 3)])
def test_stage_equals_all_pairs(spark, monkeypatch, often, sample, block):
    monkeypatch.setattr(near_dedup, "MET_BLOCK", block)
    monkeypatch.setattr(near_dedup, "OFTEN", often)
    monkeypatch.setattr(near_dedup, "SAMPLE", sample)
    rng, rows = random.Random(21), texts()
    common = words(rng, 30)
    for i in range(12):
        base = words(rng, rng.choice([60, 120, 300])).split()
        rows.append((1000 + 10 * i, " ".join(base), "", "", 1))
        for k in range(1, 7):
            now = list(base)
            for at in rng.sample(range(len(now)), max(1, len(now) * k // 100)):
                now[at] = f"x{rng.randrange(999)}"
            rows.append((1000 + 10 * i + k, " ".join(now), "", "", 1))
        rows.append((2000 + i, f"{words(rng, 40)} {common}", "", "", 1))
    wanted = plain_kept(rows)
    found = Counter(r.doc_id for r in corpus_pipeline.near_dedup(spark, frame(spark, rows), "").collect() if r.doc_id is not None)
    assert found == wanted
    assert 30 < len(wanted) < len(rows) - 20


def staged_rows(monkeypatch):
    """Rows of every table that the stage writes, by name."""
    counts, write = Counter(), near_dedup.staged

    def counted(df, name):
        out = write(df, name)
        counts[name] += out.count()
        return out

    monkeypatch.setattr(near_dedup, "staged", counted)
    return counts


def kept(spark, rows):
    return Counter(r.doc_id for r in corpus_pipeline.near_dedup(spark, frame(spark, rows), "").collect() if r.doc_id is not None)


def test_unlike_texts_of_one_passage_make_no_pairs(spark, monkeypatch):
    counts = staged_rows(monkeypatch)
    rng = random.Random(4)
    common = words(rng, 90)
    rows = [(i, f"{words(rng, 34, 900)} {common}", "", "", 1) for i in range(80)]
    wanted = plain_kept(rows)
    assert kept(spark, rows) == wanted and len(wanted) > 70
    assert counts["near-rest"] < 80


def test_rounds_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "ROUND_PAIRS", 2)
    monkeypatch.setattr(near_dedup, "MET_BLOCK", 4)
    rng, rows = random.Random(6), []
    base = words(rng, 200, 900).split()
    for i in range(24):
        now = list(base)
        for at in range(0, 8 * (i % 6), 8):
            now[at] = f"x{i % 6}"
        rows.append((i, " ".join([*now, f"end{i}"]), "", "", 1))
    assert kept(spark, rows) == plain_kept(rows)


def test_fingerprints_bring_pairs(spark, monkeypatch):
    counts = staged_rows(monkeypatch)
    rng = random.Random(9)
    base = words(rng, 400, 900)
    rows = [(1, base, "", "", 1), (2, f"{base} end", "", "", 1), (3, words(rng, 50), "", "", 1)]
    assert kept(spark, rows) == Counter([1, 3])
    assert counts["near-points"] in (2, 3) and counts["near-first"] == 1
    prints = near_dedup.set_prints(frame(spark, rows))
    assert near_dedup.simhash_pairs(prints).count() == 1


def test_no_rows(spark):
    assert near_dedup.keep_one(no_docs(spark)).count() == 0


def test_failed_pairs_are_not_fetched_again(spark, monkeypatch):
    """Texts of 0.79 similarity pass the bitmaps round after round, but their sets travel once."""
    counts = staged_rows(monkeypatch)
    monkeypatch.setattr(near_dedup, "ROUND_PAIRS", 1)
    monkeypatch.setattr(near_dedup, "ROUND_GROWTH", 2)
    rng, rows = random.Random(12), []
    base = words(rng, 300, 900).split()
    for i in range(12):
        rows.append((i, " ".join([*base, *words(rng, 40, 900).split()]), "", "", 1))
    wanted = plain_kept(rows)
    assert kept(spark, rows) == wanted and len(wanted) == 12
    assert counts["near-fresh"] <= 12 * 11 // 2
    assert counts["near-rest"] > counts["near-fresh"]


def test_folded_bitmaps_are_those_of_fewer_bits():
    rng = random.Random(3)
    sets = [near_dedup.np.array(sorted(rng.sample(range(1 << 62), n)), near_dedup.np.uint64) for n in (0, 3, 300, 5000)]
    for shingles in sets:
        plain = bytearray(near_dedup.MET_BITS // 8)
        for x in shingles.tolist():
            at = x % near_dedup.MET_BITS
            plain[at // 8] ^= 0x80 >> at % 8
        assert near_dedup.folded(near_dedup.parity(shingles), len(plain)) == bytes(plain)
    assert len(near_dedup.parity(sets[3])) == 4096


def test_shuffle_files_go_with_the_written_table(spark):
    def shuffle_mb():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(i) for i in range(files.size())]
        return sum(f.length() for f in names if f.getName().startswith("shuffle_")) / 1e6

    before = shuffle_mb()
    rows = spark.range(400_000).selectExpr("id", "md5(cast(id AS string)) AS x").repartition(4, "x")
    assert near_dedup.staged(rows, "cleanup").count() == 400_000
    for _ in range(50):  # the files go in the background
        if shuffle_mb() < before + 1:
            break
        time.sleep(0.1)
    assert shuffle_mb() < before + 1
