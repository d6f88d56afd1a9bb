"""Ranks, offsets and quantiles on skewed data, against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import ordering as od
from tokenloom.operators import profiling as pf
from tokenloom.operators import batching as bt


def clustered_ids(n=3000):
    rng = random.Random(5)
    near = rng.sample(range(10_000), n // 2)
    far = [10**15 + rng.randrange(10**9) for _ in range(n - len(near) - 1)]
    return sorted({*near, *far, 2**62, -7})


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_rank_by_id_with_clustered_ids(spark, parts):
    ids = clustered_ids()
    df = spark.createDataFrame([(i, "hot" if k % 10 else "cold") for k, i in enumerate(ids)], "id long, s string")
    got = od.rank_by_id(df.repartition(parts), "id").collect()
    assert [r["rank"] for r in sorted(got, key=lambda r: r["id"])] == list(range(len(ids)))
    by_shard = od.rank_by_id(df.repartition(parts), "id", "rank", ["s"]).collect()
    for shard in ("hot", "cold"):
        rows = sorted((r for r in by_shard if r["s"] == shard), key=lambda r: r["id"])
        assert [r["rank"] for r in rows] == list(range(len(rows)))


def test_buckets_are_filled_evenly_enough(spark):
    ids = clustered_ids()
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    counts = df.groupBy(od.ordered_bucket(df, "id").alias("b")).count()
    assert counts.agg(F.max("count")).first()[0] <= len(ids) / 50


def test_hash_rank_is_a_permutation_and_stable(spark):
    df = spark.range(500)
    first = {r["id"]: r["rank"] for r in od.rank_by_hash(df.repartition(3), 1, "id").collect()}
    again = {r["id"]: r["rank"] for r in od.rank_by_hash(df.repartition(64), 1, "id").collect()}
    assert first == again and sorted(first.values()) == list(range(500))
    assert first != {r["id"]: r["rank"] for r in od.rank_by_hash(df, 2, "id").collect()}


def test_previous_row_and_running_min(spark):
    rng = random.Random(1)
    rows = [(i, "a" if rng.random() < 0.8 else "b", rng.random()) for i in range(400)]
    df = spark.createDataFrame(rows, "step long, run string, loss double").repartition(5)
    seen = {r["step"]: r for r in od.previous_row(df, F.col("loss"), "step", "prev", ["run"]).collect()}
    best = {r["step"]: r["best"] for r in od.running_min(df, F.col("loss"), "step", "best", ["run"]).collect()}
    last, low = {}, {}
    for step, run, loss in rows:
        assert seen[step]["prev"] == last.get(run)
        assert best[step] == low.get(run)
        last[run] = loss
        low[run] = min(loss, low.get(run, loss))


@pytest.mark.parametrize("shape", ["ties", "spread"])
def test_exact_quantiles(spark, shape):
    rng = np.random.default_rng(3)
    x = rng.normal(size=1501)
    if shape == "ties":
        x[:900] = 0.0
    df = spark.createDataFrame([("x", float(v)) for v in x], "name string, x double").repartition(6)
    shares = [0.0, 1e-7, 0.05, 0.3, 0.5, 0.77, 0.999, 1.0]
    got = {r["q"]: r["value"] for r in pf.exact_quantiles(df, "name", "x", shares).collect()}
    for q in shares:
        assert got[q] == pytest.approx(np.quantile(x, q), abs=1e-12)


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_exact_quantiles_of_many_scales(spark, rounds):
    rng = np.random.default_rng(4)
    columns = {
        "wide": np.exp(rng.normal(size=3000) * 40) * rng.choice([-1, 1], size=3000),
        "one": np.array([7.5]),
        "same": np.full(500, -0.25),
        "whole": rng.integers(-5, 5, size=2000).astype(float),
    }
    rows = [(n, float(v)) for n, x in columns.items() for v in x] + [("wide", None), ("none", None)]
    df = spark.createDataFrame(rows, "name string, x double").repartition(5)
    shares = [0.0, 0.001, 0.3, 0.5, 0.9999, 1.0]
    got = {(r["name"], r["q"]): r["value"] for r in pf.exact_quantiles(df, "name", "x", shares, rounds).collect()}
    assert set(got) == {(n, q) for n in columns for q in shares}
    for n, x in columns.items():
        for q in shares:
            assert got[n, q] == pytest.approx(np.quantile(x, q), rel=1e-12)


def test_exact_quantiles_next_to_infinities(spark):
    x = [float("-inf"), *range(100), float("inf"), float("inf")]
    df = spark.createDataFrame([("x", float(v)) for v in x], "name string, x double")
    got = {r["q"]: r["value"] for r in pf.exact_quantiles(df, "name", "x", [0.1, 0.5, 0.9]).collect()}
    assert got == {q: pytest.approx(np.quantile(x, q)) for q in (0.1, 0.5, 0.9)}


def test_moments_follow_the_sample_deviation(spark):
    x = np.random.default_rng(0).gamma(2.0, size=300)
    df = spark.createDataFrame([("x", float(v)) for v in x], "name string, x double")
    row = pf.moments(df, "name", "x").first()
    z = (x - x.mean()) / x.std(ddof=1)
    assert row["skew"] == pytest.approx((z**3).mean())
    assert row["kurtosis"] == pytest.approx((z**4).mean())


def test_profile_can_drop_infinity(spark):
    df = spark.createDataFrame([("x", v) for v in (1.0, 2.0, float("inf"))], "name string, x double")
    stats = {r["stat"]: r["value"] for r in pf.profile(df, "name", "x", remove_inf=True).collect()}
    assert stats["count"] == 2 and stats["max"] == 2.0


def test_shuffled_files_follow_the_rank(spark):
    df = spark.range(300)
    ranks = {r["id"]: r["rank"] for r in od.global_shuffle(df, 9, "id").collect()}
    files = od.shuffled_for_write(df, 9, "id", 6).rdd.glom().collect()
    order = [r["id"] for part in files for r in part]
    assert [ranks[i] for i in order] == list(range(300))


@pytest.mark.parametrize("n,world", [(10, 4), (3, 8), (8, 4)])
def test_sampler_pads_by_starting_over(spark, n, world):
    rows = bt.distributed_sampler(spark.range(n), "id", world, 1, 0).collect()
    total = -(-n // world) * world
    order = [r["id"] for r in sorted(rows, key=lambda r: r["place"])]
    assert len(order) == total and order == [order[i % n] for i in range(total)]
    assert all(r["rank"] == r["place"] % world for r in rows)


def test_next_fit(spark):
    rng = random.Random(2)
    rows = [(c, i, rng.choice([1, 3, 7, 40])) for c in range(3) for i in range(50)]
    df = spark.createDataFrame(rows, "call long, id long, n long").repartition(5)
    got = {(r["call"], r["id"]): r["batch"] for r in bt.batch_by_token_budget(df, "id", "n", 20, "call").collect()}
    for call in range(3):
        batch, used = 0, 0
        for c, i, n in rows:
            if c != call:
                continue
            if used and used + n > 20:
                batch, used = batch + 1, 0
            used += n
            assert got[c, i] == batch


def plain_next_fit(lengths, budget):
    batches, batch, used = [], 0, 0
    for i, n in enumerate(lengths):
        if i and used + n > budget:
            batch, used = batch + 1, 0
        used += n
        batches.append(batch)
    return batches


def test_next_fit_over_requests_of_any_size(spark):
    rng = random.Random(4)
    requests = {
        1: [rng.choice([0, 1, 3, 7, 20, 40]) for _ in range(700)],
        2: [5],
        3: [50, 0, 0, 50, 20, 0, 1],
        4: [0] * 30,
        5: [20] * 65,
        6: [1] * 200,
    }
    rows = [(c, 1000 - 3 * i if c == 2 else 3 * i, n) for c, lengths in requests.items() for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "call long, id long, n long").repartition(5)
    got = {(r["call"], r["id"]): r["batch"] for r in bt.batch_requests_of_any_size(df, "id", "n", 20, "call").collect()}
    wanted = {}
    for c, lengths in requests.items():
        ids = sorted(i for k, i, _ in rows if k == c)
        wanted |= {(c, i): b for i, b in zip(ids, plain_next_fit(lengths, 20), strict=True)}
    assert got == wanted
    assert bt.batch_requests_of_any_size(df.limit(0), "id", "n", 20, "call").count() == 0
    null = spark.createDataFrame([(1, 1, None), (1, 2, 20), (1, 3, None), (1, 4, 1)], "call long, id long, n long")
    assert sorted((r.id, r.batch) for r in bt.batch_requests_of_any_size(null, "id", "n", 20, "call").collect()) == [(1, 0), (2, 0), (3, 0), (4, 1)]


def test_slices_and_ranks_by_text_keys(spark):
    keys = [f"{'é' if i % 3 else 'a'}{i * 7919 % 1000:04d}" for i in range(900)] + ["", "a", "same-start-1", "same-start-2"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    wanted = sorted(keys, key=lambda k: k.encode())
    found = {r["rank"]: r["k"] for r in od.rank_by_id(df, "k", "rank").collect()}
    assert [found[i] for i in range(len(keys))] == wanted
    for start, end in ((0, 5), (100, 130), (890, 2000), (5000, 5001)):
        part = {r["row_idx"]: r["k"] for r in od.slice_rows(df, "k", start, end).collect()}
        assert [part[i] for i in sorted(part)] == wanted[start:end]
        assert sorted(part) == list(range(start, min(end, len(wanted)))) or not part
