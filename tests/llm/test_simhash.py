"""Fingerprints, anchors and components against plain versions."""

import random
import re
from collections import Counter

import numpy as np
import xxhash

from odd_rows import frame, no_docs, odd_docs, texts
from tokenloom.llm import simhash
from tokenloom.llm.components import components


def plain_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(points):
    """Smallest id by fingerprint, by comparing all pairs."""
    prints = sorted({p for _, p in points})
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[i + 1 :]:
            if (p ^ q).bit_count() <= 3:
                parent[root(p)] = root(q)
    least = {}
    for d, p in points:
        least[root(p)] = min(d, least.get(root(p), d))
    return {p: least[root(p)] for p in prints}


def test_code_covers_every_point():
    points = np.random.default_rng(0).integers(0, 1 << 32, 2000)
    rows = simhash.anchors_of(points)
    assert (np.bitwise_count(rows[:, 0] ^ (points & 0x7FFFFFFF)) <= 1).all()
    for bit in range(31):
        moved = simhash.anchors_of(points ^ (1 << bit))
        assert ((rows[:, None, :] == moved[:, :, None]).any(axis=(1, 2))).all()


def test_near_links_and_blocks(spark):
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(30)]
    prints = set(centres)
    for c in centres:
        for _ in range(30):
            prints.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5]))))
    points = [(i, p) for i, p in enumerate(sorted(prints, key=lambda p: p * 7 % 1009))]
    table = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in points], "rep bigint, fp bigint")
    wanted = plain_components(points)
    for limit in (2048, 8):
        found = dict(map(tuple, components(simhash.near_links(table, group_limit=limit)).collect()))
        assert all(found.get(i, i) == wanted[p] for i, p in points)


def ran_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_copies_and_repeated_rows_are_not_broadcast(spark, tmp_path):
    """Both come from files far smaller than their rows, below a threshold that the rows exceed."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "200000")
        pairs = spark.range(1500).selectExpr("id", "xxhash64(id) AS fp")
        points = pairs.selectExpr("fp", "id AS rep").unionByName(pairs.selectExpr("fp ^ 5 AS fp", "id + 1500 AS rep"))
        points.write.parquet(str(tmp_path / "points"))
        links = simhash.near_links(spark.read.parquet(str(tmp_path / "points")))
        assert {(min(r), max(r)) for r in links.collect()} == {(i, i + 1500) for i in range(1500)}
        assert "BroadcastHashJoin" not in ran_plan(links)
        docs = spark.range(30_000).selectExpr("id AS doc_id", "CAST(NULL AS string) AS text")
        found = simhash.near_duplicates(docs.unionByName(docs.selectExpr("CAST(NULL AS bigint) AS doc_id", "text")))
        assert Counter((r.fp, r.component_id) for r in found.collect()) == {(0, 0): 60_000}
        assert re.search(r"SortMergeJoin(\(skew=true\))? \[fp#\d+L\], \[of#", ran_plan(found))
    finally:
        spark.conf.set(name, before)


def test_components_of_a_chain_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)] + [(7, 7), (100, 101), (101, 100)]
    found = dict(map(tuple, components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()))
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_documents(spark):
    found = simhash.near_duplicates(odd_docs(spark)).collect()
    rows = texts()
    assert Counter((r.doc_id, r.fp % (1 << 64)) for r in found) == Counter((r[0], plain_print(r[1])) for r in rows)
    named = plain_components([(r[0], plain_print(r[1])) for r in rows if r[0] is not None])
    assert all(r.component_id == named.get(r.fp % (1 << 64)) for r in found)


def test_keep_one(spark):
    docs = odd_docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = Counter(r.doc_id for r in kept.collect())
    rows = [r for r in texts() if r[0] is not None]
    named = plain_components([(r[0], plain_print(r[1])) for r in rows])
    assert found == Counter({**{i: 1 for i in named.values()}, None: 2})
    assert simhash.keep_one(no_docs(spark)).count() == 0
    assert simhash.keep_one(frame(spark, [(1, "a", "", "", 1), (1, "a", "", "", 1)])).count() == 1
