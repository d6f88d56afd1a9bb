"""Weighted source mixtures and the assignment of shards to ranks."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.hashing import md5_uniform
from tokenloom.operators.ordering import rank_by_id

# Draws of one document that share a join key; more epochs are spread over salts.
EPOCHS_PER_SALT = 64


def choose_source(weights: Mapping[str, float], seed: str | int, draw: Column) -> Column:
    """Source of each draw, with probability weight / sum of weights.

    The mixture is configuration, so it becomes an expression: no join at all.
    """
    if not weights or min(weights.values()) < 0 or sum(weights.values()) <= 0:
        raise ValueError("weights must be non-negative and not all zero")
    names = list(weights)
    upto = list(accumulate(float(weights[n]) for n in names))
    target = md5_uniform(seed, draw) * F.lit(upto[-1])
    choice = F.lit(names[-1])
    for name, bound in reversed(list(zip(names[:-1], upto[:-1]))):
        choice = F.when(target < bound, name).otherwise(choice)
    return choice


def source_slots(docs: DataFrame, key: str, source: str, weights: Mapping[str, float]) -> DataFrame:
    """``key, source, slot``: the place of each document in its source, for the sources of the mixture."""
    wanted = docs.filter(F.col(source).isin(*weights)).select(key, F.col(source).alias("source"))
    return rank_by_id(wanted, key, "slot", ["source"])


def hand_out(draws: DataFrame, slots: DataFrame, draw: str, key: str) -> DataFrame:
    """The document of each draw: ``draws`` has ``draw, source, ordinal`` (earlier draws of its source).

    Sources start over when they end.  A small source with a large weight repeats each document very often; its
    draws are salted by epoch, and the documents are copied once per ``EPOCHS_PER_SALT`` epochs, so that no
    join key holds more than that many draws.
    """
    # one row per configured source
    sizes = slots.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    uses = draws.groupBy("source").agg(F.count(F.lit(1)).alias("n_draws"))
    salts = F.ceil(F.col("n_draws") / (F.col("n_docs") * EPOCHS_PER_SALT)).cast("bigint")
    stats = sizes.join(uses, "source").select("source", "n_docs", salts.alias("n_salts"))
    stats = F.broadcast(stats)  # bounded by the number of sources in the configuration
    left = (
        draws.join(stats, "source")
        .withColumn("epoch", F.floor(F.col("ordinal") / F.col("n_docs")).cast("bigint"))
        .withColumn("slot", F.col("ordinal") % F.col("n_docs"))
        .withColumn("salt", F.col("epoch") % F.col("n_salts"))
        .drop("n_docs", "n_salts", "ordinal")
    )
    right = (
        slots.join(stats, "source")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_salts") - 1)))
        .drop("n_docs", "n_salts")
    )
    return left.join(right, ["source", "slot", "salt"]).select(draw, "source", "epoch", key)


def mixture_draws(
    docs: DataFrame, key: str, source: str, draws: DataFrame, draw: str, weights: Mapping[str, float], seed: str | int
) -> DataFrame:
    """Each draw takes the next document of its source: draw, source, epoch, document key."""
    drawn = draws.select(F.col(draw)).withColumn("source", choose_source(weights, seed, F.col(draw)))
    return hand_out(rank_by_id(drawn, draw, "ordinal", ["source"]), source_slots(docs, key, source, weights), draw, key)


def assign_shards(chunks: DataFrame, path: str, world: int) -> DataFrame:
    """Which chunk each rank reads, and with which stride and offset.

    More chunks than ranks: one chunk each, the rest unused.  Otherwise ``world``
    must be a multiple of the number of chunks, and the ranks of a chunk take
    every k-th line.  The chunk list is a listing of file names.
    """
    n_chunks = chunks.count()
    if n_chunks == 0:
        raise ValueError("no chunks")
    used = min(n_chunks, world)
    if world % used:
        raise ValueError(f"world size {world} is not a multiple of {n_chunks} chunks")
    per_chunk = world // used
    ordered = chunks.withColumn("_no", F.row_number().over(Window.orderBy(path)) - 1).filter(F.col("_no") < used)
    offsets = F.explode(F.sequence(F.lit(0), F.lit(per_chunk - 1)))
    return ordered.withColumn("offset", offsets).select(
        (F.col("_no") * per_chunk + F.col("offset")).cast("int").alias("rank"),
        F.col(path),
        F.lit(per_chunk).alias("block_size"),
        "offset",
    )
