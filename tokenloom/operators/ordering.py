"""Global ranks, running offsets and batches without a one-partition window.

Every order is cut into buckets that follow it.  Bucket totals are a small
table (at most ``FINE_BUCKETS`` rows per shard, whatever the data size); its
running sum gives each bucket its base, and a window inside the bucket gives
the rest.  A hot shard is spread over its buckets, so no task holds a shard.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.arrays import let
from tokenloom.functions.hashing import md5_bucket, md5_uniform

COARSE_SPLITS = 255
FINE_PER_SPLIT = 256
FINE_BUCKETS = (COARSE_SPLITS + 1) * FINE_PER_SPLIT


def _leading_number(key: str) -> str:
    """The first seven bytes of a string as a number: it follows the order of strings."""
    return f"cast(conv(rpad(hex(substring(cast(`{key}` AS binary), 1, 7)), 14, '0'), 16, 10) AS bigint)"


def ordered_bucket(df: DataFrame, key: str) -> Column:
    """Bucket number (below ``FINE_BUCKETS``) that never decreases with ``key``, a number or a string.

    Approximate quantiles place the coarse borders, so clustered or sparse keys
    still fill the buckets evenly; between two borders the key is interpolated.
    One pass over the key column fetches the 255 borders to the driver; as
    literals they are the same in every branch of the plan and in every retry.
    """
    text = df.schema[key].dataType.typeName() in ("string", "varchar", "char")
    number = F.expr(_leading_number(key)) if text else F.col(key)
    shares = ", ".join(str(i / (COARSE_SPLITS - 1)) for i in range(COARSE_SPLITS))
    found = df.select(number.alias("_key")).select(F.expr(f"percentile_approx(_key, array({shares}), 10000)")).first()[0]
    kind = np.float64 if df.schema[key].dataType.typeName() in ("double", "float") else np.int64
    borders = np.array(sorted(set(found or [0])), dtype=kind)
    every, value = F.lit(borders), number

    def passed(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= value))

    def fine(coarse: Column) -> Column:
        low, high = F.get(every, coarse - 1), F.get(every, coarse)
        inside = F.floor((value - low).cast("double") * FINE_PER_SPLIT / (high - low).cast("double"))
        return coarse * FINE_PER_SPLIT + F.coalesce(F.least(inside, F.lit(FINE_PER_SPLIT - 1)), F.lit(0))

    # every 16th border first, then the 15 between two of those
    block = passed(F.lit(borders[15::16])) if len(borders) > 15 else F.lit(0)
    coarse = let(block, lambda g: g * 16 + passed(F.slice(every, g * 16 + 1, F.lit(15))))
    # never null: otherwise a join on the bucket would test it for null below the aggregation
    return F.coalesce(let(coarse, fine).cast("int"), F.lit(0))


_AGGREGATES = {"sum": F.sum, "min": F.min, "max": F.max}


def running(
    df: DataFrame,
    value: Column,
    bucket: Column,
    order: Sequence[Column],
    out: str,
    shard: Sequence[str] = (),
    how: str = "sum",
) -> DataFrame:
    """Add ``out`` = sum, min or max of ``value`` over all earlier rows of the shard.

    ``bucket`` must follow ``order``.  What came before a bucket enters its window
    as an opening row, so the rows are exchanged once and joined with nothing.
    """
    aggregate = _AGGREGATES[how]
    keys = [*shard, "_bucket"]
    work = df.withColumn("_bucket", bucket).withColumn("_value", value)
    totals = work.groupBy(*keys).agg(aggregate("_value").alias("_total"))
    before = Window.partitionBy(*shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    opening = totals.select(*keys, aggregate("_total").over(before).alias("_value"), F.lit(0).alias("_row"))
    rows = work.withColumn("_row", F.lit(1)).unionByName(opening, allowMissingColumns=True)
    inside = Window.partitionBy(*keys).orderBy("_row", *order).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn(out, aggregate("_value").over(inside)).filter("_row = 1")
    return found.drop("_bucket", "_value", "_row")


def running_offset(
    df: DataFrame, value: Column, bucket: Column, order: Sequence[Column], out: str, shard: Sequence[str] = ()
) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the shard (0 for the first one)."""
    sums = running(df, value.cast("bigint"), bucket, order, out, shard)
    return sums.withColumn(out, F.coalesce(out, F.lit(0).cast("bigint")))


def running_min(df: DataFrame, value: Column, key: str, out: str, shard: Sequence[str] = ()) -> DataFrame:
    """Smallest earlier value in key order; null for the first row."""
    return running(df, value, ordered_bucket(df, key), [F.col(key)], out, shard, "min")


def previous_row(df: DataFrame, value: Column, key: str, out: str, shard: Sequence[str] = ()) -> DataFrame:
    """Value of the row before this one in key order.

    A running maximum of (key, value): it needs no task that holds a whole shard.
    """
    pair = F.struct(F.col(key).alias("k"), value.alias("v"))
    found = running(df, pair, ordered_bucket(df, key), [F.col(key)], "_prev", shard, "max")
    return found.withColumn(out, F.col("_prev.v")).drop("_prev")


def rank_by_id(
    df: DataFrame, key: str, out: str = "rank", shard: Sequence[str] = (), ids: DataFrame | None = None
) -> DataFrame:
    """Zero-based position in id order, per shard.

    ``ids`` may be any table with about the same ids: buckets are placed with it,
    so that an expensive ``df`` is not computed just for its id column.
    """
    return running_offset(df, F.lit(1), ordered_bucket(ids or df, key), [F.col(key)], out, shard)


def rank_by_hash(
    df: DataFrame, seed: str | int, key: str, out: str = "rank", shard: Sequence[str] = ()
) -> DataFrame:
    """Zero-based position in a seeded random order, per shard."""
    order = [md5_uniform(seed, F.col(key)), F.col(key)]
    return running_offset(df, F.lit(1), md5_bucket(seed, F.col(key)), order, out, shard)


def offset_by_id(
    df: DataFrame,
    value: Column,
    key: str,
    out: str = "start",
    shard: Sequence[str] = (),
    ids: DataFrame | None = None,
) -> DataFrame:
    """Sum of ``value`` over the rows before this one in id order, per shard."""
    return running_offset(df, value, ordered_bucket(ids or df, key), [F.col(key)], out, shard)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows evenly to ``partitions`` tasks before CPU-heavy work; None leaves them where they are."""
    return df if partitions is None else df.repartition(partitions)


def row_total(df: DataFrame) -> Column:
    """Row count as a scalar subquery, computed inside the same query."""
    return df.agg(F.count(F.lit(1))).scalar()


def ranked_slice(
    df: DataFrame, bucket: Column, order: Sequence[Column], start: int, end: int, out: str = "row_idx"
) -> DataFrame:
    """The rows whose zero-based place in the order lies in ``[start, end)``, with the place.

    The bucket totals (at most ``FINE_BUCKETS`` rows for a plain key) tell which buckets meet the slice,
    so only the rows of those buckets are exchanged.
    """
    work = df.withColumn("_at", bucket)
    totals = sorted(work.groupBy("_at").agg(F.count(F.lit(1)).alias("n")).collect())
    first = last = None
    before = skipped = 0
    for at, n in totals:
        if before + n > start and before < end:
            skipped = before if first is None else skipped
            first, last = at if first is None else first, at
        before += n
    if first is None:
        return work.drop("_at").withColumn(out, F.lit(0).cast("bigint")).limit(0)
    near = work.filter(F.col("_at").between(first, last))
    ranked = running_offset(near, F.lit(1), F.col("_at"), order, out).drop("_at").withColumn(out, F.col(out) + skipped)
    return ranked.filter((F.col(out) >= start) & (F.col(out) < end))


def slice_rows(df: DataFrame, key: str, start: int, end: int) -> DataFrame:
    """Rows ``[start, end)`` in id order."""
    return ranked_slice(df, ordered_bucket(df, key), [F.col(key)], start, end)


def global_shuffle(df: DataFrame, seed: str | int, key: str, out: str = "rank") -> DataFrame:
    """Whole-table seeded shuffle: every row gets its place in the new order."""
    return rank_by_hash(df, seed, key, out)


def shuffled_for_write(df: DataFrame, seed: str | int, key: str, partitions: int) -> DataFrame:
    """The same order as files: range exchange plus a spilling sort per task."""
    work = df.withColumn("_u", md5_uniform(seed, F.col(key)))
    return work.repartitionByRange(partitions, "_u", key).sortWithinPartitions("_u", key).drop("_u")


def repeat_epochs(df: DataFrame, epochs: int, out: str = "current_iter") -> DataFrame:
    """Every row once per epoch, made by a generator instead of a product join."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
