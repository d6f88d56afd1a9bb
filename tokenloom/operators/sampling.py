"""Samples, splits and weighted choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.arrays import array_sum, let
from tokenloom.functions.hashing import md5_uniform
from tokenloom.operators.ordering import rank_by_hash, row_total


def bernoulli_sample(df: DataFrame, seed: str | int, *keys: Column, percentage: float = 10) -> DataFrame:
    """Keep each row with probability ``percentage / 100``; a per-row filter, no shuffle."""
    return df.filter(md5_uniform(seed, *keys) < percentage / 100.0)


def split_exact(df: DataFrame, seed: str | int, key: str, test_size: float = 0.2) -> DataFrame:
    """Random permutation split with an exact test share (rounded up)."""
    ranked = rank_by_hash(df, seed, key, "rank")
    n_test = F.ceil(row_total(df) * F.lit(test_size))
    return ranked.withColumn("split", F.when(F.col("rank") < n_test, "test").otherwise("train"))


def split_bernoulli(df: DataFrame, seed: str | int, key: str, test_size: float = 0.2) -> DataFrame:
    """A row trains when its uniform is above ``test_size``."""
    drawn = md5_uniform(seed, F.col(key)) > test_size
    return df.withColumn("split", F.when(drawn, "train").otherwise("test"))


def by_probability(p: Column) -> Column:
    """``p, item`` of an array of probabilities, the most probable first, equal ones by item."""
    pairs = F.transform(p, lambda x, i: F.struct((-x).alias("n"), i.alias("item")))
    return F.transform(F.array_sort(pairs), lambda s: F.struct((-s["n"]).alias("p"), s["item"].alias("item")))


def normalised(items: Column) -> Column:
    """``item, p_norm``: the probabilities of the items over their sum."""
    return let(
        items,
        lambda kept: let(
            array_sum(F.transform(kept, lambda s: s["p"]), "double"),
            lambda total: F.transform(kept, lambda s: F.struct(s["item"].alias("item"), (s["p"] / total).alias("p_norm"))),
        ),
    )


def nucleus_select(p: Column, top_p: float) -> Column:
    """Most probable items of a row until their mass before the item passes ``top_p``, as ``item, p_norm``.

    The cut is counted along the sorted array, then sliced off; no array grows and no row moves.
    """
    start = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("mass"))

    def add(acc: Column, x: Column) -> Column:
        more = F.struct((acc["n"] + 1).alias("n"), (acc["mass"] + x["p"]).alias("mass"))
        return F.when(acc["mass"] <= top_p, more).otherwise(acc)

    def cut(items: Column) -> Column:
        return F.slice(items, F.lit(1), F.aggregate(items, start, add, lambda acc: acc["n"]))

    return normalised(let(by_probability(p), cut))


def at_least_kth(p: Column, k: int) -> Column:
    """``p, item`` of all items at least as probable as the k-th largest."""
    return let(
        by_probability(p),
        lambda s: F.filter(s, lambda x: x["p"] >= F.get(s, F.least(F.lit(k), F.size(s)) - 1)["p"]),
    )


def topk_with_ties(p: Column, k: int) -> Column:
    """All items at least as probable as the k-th largest, renormalised, as ``item, p_norm``."""
    return normalised(at_least_kth(p, k))


def categorical_draw(items: Column, uniform: Column) -> Column:
    """One weighted draw from ``p, item`` in order: the first item whose cumulative share passes the uniform.

    Rounding can leave the target at the very end: then the last item is drawn.
    """

    def draw(items: Column, target: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("upto"), F.lit(None).cast("int").alias("hit"), F.lit(None).cast("int").alias("last"))

        def add(acc: Column, x: Column) -> Column:
            upto = acc["upto"] + x["p"]
            hit = F.coalesce(acc["hit"], F.when(upto > target, x["item"]))
            return F.struct(upto.alias("upto"), hit.alias("hit"), x["item"].alias("last"))

        return F.aggregate(items, start, add, lambda acc: F.coalesce(acc["hit"], acc["last"]))

    total = lambda kept: array_sum(F.transform(kept, lambda s: s["p"]), "double")
    return let(items, lambda kept: let(uniform * total(kept), lambda target: draw(kept, target)))
