"""Scores of texts and predictions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.arrays import argmax, array_sum, log_softmax_at
from tokenloom.functions.tokens import IGNORE_LABEL


def validation_metrics(df: DataFrame, path: str, scores: str, text: str) -> DataFrame:
    """Per source the mean over documents (not over tokens) of the summed score, the
    score per token and per character, and the length.

    A document without tokens (or characters) has no score per token (or character) and is left out of
    that mean.  The score keeps the sign of the log likelihood.  Sources that share a base
    name get numbered names.
    """
    total = array_sum(F.col(scores), "double")
    rows = df.select(
        path, total.alias("_sum"), F.size(scores).alias("_n"), F.length(text).alias("_chars")
    )
    per_source = rows.groupBy(path).agg(
        F.avg("_sum").alias("nll"),
        F.avg(F.try_divide("_sum", "_n")).alias("nll_per_token"),
        F.avg(F.try_divide("_sum", "_chars")).alias("nll_per_char"),
        F.avg("_n").alias("avg_seqlen"),
    )
    base = F.substring_index(path, "/", -1)
    # one row per source by now
    again = F.row_number().over(Window.partitionBy(base).orderBy(path)) - 1
    return per_source.withColumn("_again", again).withColumn(
        "name", F.when(F.col("_again") == 0, base).otherwise(F.concat(base, F.lit("_"), F.col("_again").cast("string")))
    ).drop("_again")


def masked_accuracy(df: DataFrame, logits: str, gold: str) -> DataFrame:
    """Correct and counted predictions over the labels that are not ignored."""
    kept = F.col(gold) != IGNORE_LABEL
    hit = kept & (argmax(F.col(logits)) == F.col(gold))
    return df.agg(F.count_if(hit).alias("n_correct"), F.count_if(kept).alias("n_word"))


def masked_cross_entropy(df: DataFrame, logits: str, gold: str) -> DataFrame:
    """Mean of -log softmax at the gold class over the labels that are not ignored."""
    kept = df.filter(F.col(gold) != IGNORE_LABEL)
    return kept.agg(F.avg(-log_softmax_at(F.col(logits), F.col(gold))).alias("loss"), F.count(F.lit(1)).alias("n"))


def mean_loss(df: DataFrame, batch: str, loss: str, n_batches: int | None) -> DataFrame:
    """Mean over the first ``n_batches`` batch losses; NaN when there is none."""
    rows = df if n_batches is None else df.filter(F.col(batch) < n_batches)
    per_batch = rows.groupBy(batch).agg(F.avg(loss).alias("_loss"))
    return per_batch.agg(
        F.coalesce(F.avg("_loss"), F.lit(float("nan"))).alias("mean_loss"), F.count(F.lit(1)).alias("n_batches")
    )


def epoch_ratios(df: DataFrame, epoch: str, loss: str, correct: str, words: str) -> DataFrame:
    """Loss and hits per word of each epoch; null for an epoch without words."""
    total = F.sum(words)
    return df.groupBy(epoch).agg(
        F.try_divide(F.sum(loss), total).alias("loss_per_word"), F.try_divide(F.sum(correct), total).alias("accuracy")
    )


def uniform_args(df: DataFrame, group: str, args: Column) -> DataFrame:
    """True where every record of the group carries the same arguments (constant memory per group)."""
    text = F.to_json(args)
    return df.groupBy(group).agg((F.min(text) == F.max(text)).alias("is_uniform"))


def lookup_scores(tokens: Column, table: Mapping[int, float]) -> Column:
    """Score of each token from a table over the byte values."""
    values = F.array(*[F.lit(float(table.get(i, 0.0))) for i in range(256)])
    return F.transform(tokens, lambda t: F.get(values, t))
