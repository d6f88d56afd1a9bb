"""Batches: block shuffle, token budgets, prompt packs, samplers, padded examples."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.hashing import md5_uniform
from tokenloom.operators.ordering import offset_by_id, ordered_bucket, rank_by_hash, rank_by_id, row_total, running_offset
from tokenloom.session import written


def block_shuffle(
    df: DataFrame,
    index: str,
    batch_size: int,
    prefetch: int,
    seed: str | int,
    shard: Sequence[str] = (),
    drop_incomplete: bool = True,
) -> DataFrame:
    """Shuffle inside blocks of ``prefetch * batch_size`` consecutive sequences and cut batches.

    A window group is one block, bounded by the two parameters.  A finite table's
    last block may be short; its unfilled batch is dropped unless asked for, which
    the same window decides.
    """
    block_rows = batch_size * prefetch
    blocks = df.withColumn("block", F.floor(F.col(index) / block_rows).cast("bigint"))
    keys = [F.col(c) for c in shard]
    group = Window.partitionBy(*shard, "block")
    order = group.orderBy(md5_uniform(seed, *keys, F.col(index)), F.col(index))
    placed = blocks.withColumn("_rn", F.row_number().over(order) - 1).withColumn(
        "_no", F.floor(F.col("_rn") / batch_size)
    )
    if drop_incomplete:
        placed = placed.withColumn("_n", F.count(F.lit(1)).over(group))
        placed = placed.filter((F.col("_no") + 1) * batch_size <= F.col("_n")).drop("_n")
    return (
        placed.withColumn("batch", F.col("block") * prefetch + F.col("_no"))
        .withColumn("pos_in_batch", (F.col("_rn") % batch_size).cast("int"))
        .drop("_rn", "_no")
    )


def batch_rows(
    df: DataFrame, key: str, batch_size: int, shuffle_seed: str | int | None = None, drop_last: bool = False
) -> DataFrame:
    """Fixed-size batches in id order or in a seeded random order."""
    ranked = rank_by_id(df, key, "_rn") if shuffle_seed is None else rank_by_hash(df, shuffle_seed, key, "_rn")
    out = ranked.withColumn("batch", F.floor(F.col("_rn") / batch_size).cast("bigint")).withColumn(
        "pos_in_batch", (F.col("_rn") % batch_size).cast("int")
    )
    if drop_last:
        out = out.filter((F.col("batch") + 1) * batch_size <= row_total(df))
    return out.drop("_rn")


def distributed_sampler(
    df: DataFrame, key: str, world: int, seed: int, epoch: int, shuffle: bool = True
) -> DataFrame:
    """Rank r takes rows r, r + world, ... of the epoch's permutation, which is padded
    to a multiple of ``world`` by starting over at its head."""
    ranked = rank_by_hash(df, seed + epoch, key, "_rn") if shuffle else rank_by_id(df, key, "_rn")
    total = row_total(df)
    padded = F.ceil(total / F.lit(world)) * world
    # row i also fills the places i + n, i + 2n, ... below the padded length
    copies = F.sequence(F.col("_rn"), padded - 1, total)
    placed = ranked.filter(F.col("_rn") < padded).withColumn("place", F.explode(copies)).drop("_rn")
    return placed.withColumn("rank", (F.col("place") % world).cast("int")).withColumn(
        "step", F.floor(F.col("place") / world).cast("bigint")
    )


def batch_by_token_budget(
    df: DataFrame, key: str, length: str, max_elements: int, call: str
) -> DataFrame:
    """Next-fit batches: a batch closes when the next prompt would pass the budget;
    a prompt above the budget gets a batch of its own.

    Each prompt's batch depends on the one before it, so one call's prompts are
    folded in order.  Only (key, length) enter the fold, and ``call`` must be a
    bounded request of prompts (``batch_requests_of_any_size`` has no such bound).
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key, kind="stable")
        batches, batch, used = [], 0, 0
        for i, n in enumerate(pdf[length].tolist()):
            if i and used + n > max_elements:
                batch, used = batch + 1, 0
            used += n
            batches.append(batch)
        return pdf.assign(batch=batches)

    narrow = df.select(F.col(call).cast("bigint"), F.col(key).cast("bigint"), F.col(length).cast("bigint"))
    return narrow.groupBy(call).applyInPandas(fold, f"{call} bigint, {key} bigint, {length} bigint, batch bigint")


def batch_requests_of_any_size(df: DataFrame, key: str, length: str, max_elements: int, call: str) -> DataFrame:
    """The same next-fit batches ``(call, key, length, batch)`` without a task that holds a request.

    Where the batch after the one that starts at a row begins follows from prefix sums: before the first row
    that ends beyond the row's offset plus the budget.  The steps from start to start are doubled in each round,
    so the starts that are known double too: after ``r`` rounds they are the first ``2^r`` of every request.
    A round exchanges three numbers a row.  Keys are unique within a request; a null length counts as 0.
    """
    n = F.coalesce(F.col(length).cast("bigint"), F.lit(0).cast("bigint"))
    narrow = df.select(F.col(call).cast("bigint"), F.col(key).cast("bigint"), n.alias(length))
    ranked = rank_by_id(narrow, key, "_at", [call])
    rows = written(offset_by_id(ranked, F.col(length), key, "_from", [call]), "request-rows")
    ends = rows.select(call, "_at", (F.col("_from") + F.col(length)).alias("_x"), F.lit(1).alias("_end"))
    limits = rows.select(call, "_at", (F.col("_from") + max_elements).alias("_x"), F.lit(0).alias("_end"))
    both = ends.unionByName(limits)
    # a limit comes after the ends it equals, so it counts every row that fits
    order = [F.col("_x"), F.desc("_end")]
    fits = running_offset(both, F.col("_end"), ordered_bucket(both, "_x"), order, "_fit", [call]).filter("_end = 0")
    steps = written(fits.select(call, "_at", F.greatest(F.col("_at") + 1, "_fit").alias("_next")), "request-steps")
    starts = steps.filter("_at = 0").select(call, "_at")
    while True:
        further = written(starts.join(steps, [call, "_at"]).select(call, F.col("_next").alias("_at")), "request-starts")
        if further.isEmpty():
            break
        starts = starts.unionByName(further)
        after = steps.select(F.col(call).alias("_call"), F.col("_at").alias("_to"), F.col("_next").alias("_after"))
        twice = steps.join(after, (F.col(call) == F.col("_call")) & (F.col("_next") == F.col("_to")))
        steps = written(twice.select(call, "_at", F.col("_after").alias("_next")), "request-steps")
    first = F.coalesce("_first", F.lit(0))
    marked = rows.join(starts.withColumn("_first", F.lit(1)), [call, "_at"], "left").withColumn("_first", first)
    counted = running_offset(marked, F.col("_first"), ordered_bucket(rows, "_at"), [F.col("_at")], "batch", [call])
    return counted.select(call, key, length, (F.col("batch") + F.col("_first") - 1).alias("batch"))


def pack_prompts(df: DataFrame, batch: str, position: str, tokens: str) -> DataFrame:
    """One row per batch: concatenated tokens and the lengths of the parts (batch size bounds the group)."""
    parts = F.array_sort(F.collect_list(F.struct(position, tokens)))
    return (
        df.groupBy(batch)
        .agg(parts.alias("_parts"))
        .select(
            batch,
            F.flatten(f"_parts.{tokens}").alias("tokens"),
            F.transform("_parts", lambda p: F.size(p[tokens])).alias("lengths"),
        )
    )


def with_batch_width(df: DataFrame, batch: str, tokens: str) -> DataFrame:
    """Longest sequence of the batch, next to every row of it."""
    return df.withColumn("width", F.max(F.size(tokens)).over(Window.partitionBy(batch)))


def collate(df: DataFrame, batch: str, fn: Callable[[pd.DataFrame], pd.DataFrame] | None, schema: str) -> DataFrame:
    """Hand each batch (a bounded group) to the user's function."""
    if fn is None:
        raise ValueError("a collate function is required")
    return df.groupBy(batch).applyInPandas(fn, schema)


def every_n_steps(step: Column, freq: int, acc_step: Column, at: int | None = None, acc_freq: int | None = None) -> Column:
    """Gate: ``step % freq == 0`` and, when given, the accumulation step too."""
    gate = step % freq == 0
    if at is not None:
        gate = gate & (acc_step == at)
    elif acc_freq is not None:
        gate = gate & (acc_step % acc_freq == 0)
    return gate
