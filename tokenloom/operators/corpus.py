"""Corpus preparation: filters, counts, caps, validation heads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.operators.ordering import FINE_BUCKETS, ordered_bucket, ranked_slice, slice_rows


def keep_nonblank(df: DataFrame, text: str = "text") -> DataFrame:
    """Drop null and blank texts; the others pass unchanged, not even stripped."""
    return df.filter(F.col(text).isNotNull() & ~tx.is_blank(F.col(text)))


def count_by(df: DataFrame, group: str, out: str = "line_count") -> DataFrame:
    """Rows per group: partial counts before the one exchange."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias(out))


def union_branches(df: DataFrame, group: str, values: Sequence[str]) -> DataFrame:
    """One branch per value.  Branches that differ only in the value share one scan,
    instead of a union that would read the table once per branch."""
    return df.filter(F.col(group).isin(*values)).withColumn("branch", F.col(group))


def listed_order(column: Column, values: Sequence[str]) -> Column:
    """Zero-based place of the value in the list, null when it is not listed."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), column)
    return F.when(place > 0, place - 1).cast("int")


def capped_by_listed_order(
    df: DataFrame, group: str, values: Sequence[str], key: str, cap: int
) -> DataFrame:
    """Read the groups in the listed order until ``cap`` rows are taken altogether."""
    listed = df.withColumn("_place", listed_order(F.col(group), values)).filter(F.col("_place").isNotNull())
    bucket = F.col("_place") * FINE_BUCKETS + ordered_bucket(df, key)
    return ranked_slice(listed, bucket, [F.col("_place"), F.col(key)], 0, cap, "rank").drop("_place")


def explode_sentences(df: DataFrame, text: str = "text") -> DataFrame:
    return df.select("*", F.posexplode(tx.sentences(F.col(text))).alias("sent_no", "sentence")).drop(text)


def take_then_filter(df: DataFrame, key: str, n: int, predicate: Column) -> DataFrame:
    """The first ``n`` rows in id order, and only then the predicate."""
    return slice_rows(df, key, 0, n).filter(predicate)


def validation_head(df: DataFrame, chunk: str, rank: str, k: int) -> DataFrame:
    """Mark the first ``k`` rows of every chunk.

    Chunks are dealt round robin, so a row's place in its chunk follows from
    its global rank and no window over the chunk is needed.
    """
    return df.withColumn("is_validation", F.col(rank) < k)


def minus_validation(df: DataFrame, validation: DataFrame, key: str) -> DataFrame:
    """Training rows: those whose id is not in the validation part."""
    return df.join(validation.select(key), key, "left_anti")


def missing_sources(configured: DataFrame, present: DataFrame, source: str = "source") -> DataFrame:
    """Configured sources that have no data; must be empty."""
    return configured.join(present.select(source).distinct(), source, "left_anti")


def assert_sources_exist(configured: DataFrame, present: DataFrame, source: str = "source") -> None:
    lost = [r[0] for r in missing_sources(configured, present, source).orderBy(source).limit(20).collect()]
    if lost:
        raise ValueError(f"sources without data: {lost}")
