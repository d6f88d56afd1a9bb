"""Statistics of numeric columns, vector groups and metric tables."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.session import written

# The quantiles of a profile.
QUANTILES = (
    0.0000001, 0.000001, 0.00001, 0.0001, 0.001, 0.01,
    0.05, 0.1, 0.3, 0.5, 0.7, 0.9, 0.95,
    0.99, 0.999, 0.9999, 0.99999, 0.999999, 0.9999999,
)


SEGMENTS = 16
FINE = 1024


def _cell(value: Column, borders: Column) -> Column:
    """Cell number that never decreases with the value: segments between borders, each of ``FINE`` cells of even width.

    A segment that reaches to an infinity is one cell; numbers that are no numbers lie in the last.
    """

    # one comparison for each border, which compiles; a lambda over the array would not
    passed = [F.when(F.get(borders, F.lit(i)) < value, 1).otherwise(0) for i in range(SEGMENTS + 1)]
    segment = reduce(operator.add, passed)
    low, high = F.get(borders, segment - 1), F.get(borders, segment)
    inside = F.floor((value - low) * FINE / (high - low))
    # never null: otherwise a join on the cell would evaluate it once more to test it
    return segment * FINE + F.coalesce(F.greatest(F.least(inside, F.lit(FINE - 1)), F.lit(0)), F.lit(0))


def _narrowed(rows: DataFrame, spans: DataFrame, name: str, value: str) -> tuple[DataFrame, DataFrame]:
    """The rows and spans of the cells that hold a wanted rank, after cutting every span into cells.

    Sketches place the borders, counts by cell are exact; no value is exchanged.
    """
    shares = ", ".join(str(i / SEGMENTS) for i in range(SEGMENTS + 1))
    borders = rows.groupBy(name, "_span").agg(
        F.array_sort(F.array_distinct(F.expr(f"percentile_approx(`{value}`, array({shares}), 10000)"))).alias("_borders")
    )
    celled = rows.join(written(borders, "quantile-borders"), [name, "_span"]).select(
        name, "_span", value, _cell(F.col(value).cast("double"), F.col("_borders").cast("array<double>")).alias("_cell")
    )
    totals = celled.groupBy(name, "_span", "_cell").agg(F.count(F.lit(1)).alias("_total"))
    before = Window.partitionBy(name, "_span").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.join(spans, [name, "_span"]).withColumn(
        "_start", F.col("_start") + F.coalesce(F.sum("_total").over(before), F.lit(0))
    )
    first, stop = F.col("_start").cast("double"), (F.col("_start") + F.col("_total")).cast("double")
    # rank q * last lies between two rows; the cell is needed when it holds one of them
    held = F.filter("_targets", lambda q: (q * F.col("_last") > first - 1) & (q * F.col("_last") < stop))
    inner = F.col("_span") * (SEGMENTS + 2) * FINE + F.col("_cell")
    needed = placed.select(name, "_span", "_cell", inner.alias("_inner"), "_start", "_last", held.alias("_targets"))
    needed = written(needed.filter(F.size("_targets") > 0), "quantile-spans")
    kept = celled.join(needed.select(name, "_span", "_cell", "_inner"), [name, "_span", "_cell"])
    return (
        kept.select(name, value, F.col("_inner").alias("_span")),
        needed.select(name, F.col("_inner").alias("_span"), "_start", "_last", "_targets"),
    )


def exact_quantiles(
    df: DataFrame, name: str, value: str, shares: Sequence[float] = QUANTILES, rounds: int = 1
) -> DataFrame:
    """Interpolated quantiles ``(name, q, value)`` over all values of each name.

    Each round cuts the values of a name that still matter into some 16,000 cells and keeps the cells that hold
    a wanted rank, at most two for each quantile.  Only what is left after ``rounds`` rounds is exchanged,
    equal values as one row, and put in order.  No task sees a whole column.  Null values count for nothing.
    """
    rows = df.select(name, value, F.lit(0).cast("bigint").alias("_span")).filter(F.col(value).isNotNull())
    sizes = rows.groupBy(name, "_span").agg(F.count(F.lit(1)).alias("_size"))
    spans = sizes.select(
        name,
        "_span",
        F.lit(0).cast("bigint").alias("_start"),
        (F.col("_size") - 1).cast("double").alias("_last"),
        F.lit(np.array([float(q) for q in shares])).alias("_targets"),
    )
    for _ in range(rounds):
        rows, spans = _narrowed(rows, spans, name, value)

    counts = rows.groupBy(name, "_span", value).agg(F.count(F.lit(1)).alias("_n")).join(spans, [name, "_span"])
    inside = Window.partitionBy(name, "_span").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("_from", F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    hits = ranked.select(name, F.col(value).alias("_x"), "_from", "_n", "_last", F.explode("_targets").alias("q"))
    hits = hits.withColumn("_at", F.col("q") * F.col("_last"))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_from") + F.col("_n")), F.col("_x")))

    ends = hits.groupBy(name, "q", "_at").agg(
        at_rank(F.floor("_at")).alias("_low"), at_rank(F.ceil("_at")).alias("_high")
    )
    return ends.select(
        name, "q", (F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_at") - F.floor("_at"))).alias("value")
    )


def moments(df: DataFrame, name: str, value: str) -> DataFrame:
    """Mean, sample deviation, skewness and (not excess) kurtosis standardised by it, and extremes.

    One aggregation with partial sums.
    """
    x = F.col(value)
    shrink = (F.count(x) - 1) / F.count(x)
    return df.groupBy(name).agg(
        F.count(x).cast("double").alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        (F.skewness(x) * F.pow(shrink, F.lit(1.5))).alias("skew"),
        ((F.kurtosis(x) + 3) * F.pow(shrink, F.lit(2.0))).alias("kurtosis"),
        F.avg(F.abs(x)).alias("abs_mean"),
        F.max(x).alias("max"),
        F.min(x).alias("min"),
    )


def profile(df: DataFrame, name: str, value: str, remove_inf: bool = False) -> DataFrame:
    """Long table ``(name, stat, value)`` of the moments and the quantiles."""
    data = df.filter(F.col(value).isNotNull())
    if remove_inf:
        data = data.filter(F.abs(F.col(value)) < float("inf"))
    first = moments(data, name, value)
    stats = [c for c in first.columns if c != name]
    long = first.unpivot(name, stats, "stat", "value")
    quantiles = exact_quantiles(data, name, value)
    return long.unionByName(
        quantiles.select(name, F.concat(F.lit("q"), F.col("q").cast("string")).alias("stat"), "value")
    )


def init_stats(df: DataFrame, group: str, value: str, tiny: float = 1e-6) -> DataFrame:
    x = F.col(value)
    return df.groupBy(group).agg(
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.avg((F.abs(x) < tiny).cast("int")).alias("near_zero"),
    )


def range_checks(df: DataFrame, group: str, value: str, max_range: float = 1e3, max_std: float = 1e3) -> DataFrame:
    """Flags of suspicious groups: empty, not finite, wide, spread out, all zero."""
    x = F.col(value)
    bad = F.isnan(x) | (F.abs(x) == float("inf"))
    return df.groupBy(group).agg(
        (F.count(x) == 0).alias("is_empty"),
        F.coalesce(F.bool_or(bad), F.lit(False)).alias("not_finite"),
        F.coalesce(F.max(x) - F.min(x) > max_range, F.lit(False)).alias("wide_range"),
        F.coalesce(F.stddev_samp(x) > max_std, F.lit(False)).alias("large_std"),
        F.coalesce(F.max(F.abs(x)) == 0, F.lit(False)).alias("all_zero"),
    )


def variance_and_nan(df: DataFrame, group: str, value: str) -> DataFrame:
    x = F.col(value)
    return df.groupBy(group).agg(F.var_samp(x).alias("variance"), F.bool_or(F.isnan(x)).alias("has_nan"))


def rank_mean_max(df: DataFrame, metric: str, rank: str, value: str) -> DataFrame:
    """Unweighted mean of the ranks' means, and the largest value."""
    per_rank = df.groupBy(metric, rank).agg(F.avg(value).alias("_mean"), F.max(value).alias("_max"))
    return per_rank.groupBy(metric).agg(F.avg("_mean").alias("mean"), F.max("_max").alias("max"))
