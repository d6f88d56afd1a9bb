"""Run logs and snapshot manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.ordering import previous_row, running_min


def running_best(df: DataFrame, run: str, step: str, loss: str, save_every: int, forced: Column) -> DataFrame:
    """Best loss before each step and whether the step is saved: forced, on schedule, or improved."""
    seen = running_min(df, F.col(loss), step, "best_before", [run])
    improved = F.coalesce(F.col(loss) < F.col("best_before"), F.lit(True))
    return seen.withColumn("saved", forced | (F.col(step) % save_every == 0) | improved)


def attention_flops(n_layers: int, seq_len: int, dim: int) -> float:
    """Causal attention, forward and backward, per token."""
    return 3.5 * ((4 * n_layers * seq_len * dim) // 2)


def flops_per_token(params: int, n_layers: int, dim: int, seq_len: int) -> float:
    return 6 * params + attention_flops(n_layers, seq_len, dim)


def throughput(df: DataFrame, run: str, step: str, time: str, words: str, flops: float) -> DataFrame:
    """Rates since the run's log line before: seconds, steps/s, words/s and FLOPS."""
    last = previous_row(df, F.struct(F.col(time).alias("t"), F.col(step).alias("s")), step, "_last", [run])
    seconds = F.timestamp_diff("MICROSECOND", F.col("_last.t"), F.col(time)) / F.lit(1e6)
    rated = last.withColumn("seconds", seconds).withColumn("steps", F.col(step) - F.col("_last.s")).drop("_last")
    positive = F.when(F.col("seconds") > 0, F.col("seconds"))
    return (
        rated.withColumn("steps_per_second", F.col("steps") / positive)
        .withColumn("wps", F.col(words) / positive)
        .withColumn("flops", F.col("wps") * F.lit(float(flops)))
    )


def metric_entries(df: DataFrame, step: str, prefix: str = "evals/") -> DataFrame:
    """One row per metric whose key holds ``/``; the key is renamed for the log."""
    keys = [c for c in df.columns if "/" in c]
    values = F.create_map(*[x for c in keys for x in (F.lit(c), F.col(f"`{c}`").cast("double"))])
    rows = df.select(step, F.explode(values).alias("key", "value"))
    return rows.select(step, F.concat(F.lit(prefix), F.replace("key", F.lit("/"), F.lit("."))).alias("name"), "value")


def snapshot_step(path: Column) -> Column:
    """Last number in a folder name."""
    return F.try_element_at(F.regexp_extract_all(path, F.lit("[0-9]+"), F.lit(0)), F.lit(-1)).cast("bigint")


def snapshot_kind(path: Column) -> Column:
    return F.when(path.startswith("checkpoint"), "checkpoint").when(path.startswith("eval"), "eval").otherwise("other")


def latest_with_state(manifest: DataFrame, path: str = "path", has_state: str = "has_state") -> DataFrame:
    """Newest folder that has the state file: one value per task before the exchange."""
    step = snapshot_step(F.col(path))
    return manifest.filter(F.col(has_state)).agg(F.max_by(path, step).alias(path), F.max(step).alias("step"))


def retained(manifest: DataFrame, limits: dict[str, int], path: str = "path") -> DataFrame:
    """The last ``limit`` folders of each kind; 0 keeps all, and so do kinds without a limit.

    The newest ones come from a top-n per task, so a kind with most of the
    folders sends only ``limit`` rows per task.
    """
    known = manifest.withColumn("kind", snapshot_kind(F.col(path))).withColumn("step", snapshot_step(F.col(path)))
    capped = {k: n for k, n in limits.items() if n > 0}
    kept = known.filter(~F.col("kind").isin(*capped)) if capped else known
    for kind, limit in capped.items():
        newest = known.filter(F.col("kind") == kind).orderBy(F.desc("step"), path).limit(limit)
        kept = kept.unionByName(newest)
    return kept


def to_remove(manifest: DataFrame, keep: DataFrame, path: str = "path") -> DataFrame:
    return manifest.select(path).join(keep.select(path), path, "left_anti")
