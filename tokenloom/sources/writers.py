"""Writers: text and JSONL shards, snapshots, metric logs, tokenizer files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.ordering import global_shuffle, rank_by_id, spread


def write_text_shards(
    df: DataFrame,
    path: str,
    text: str = "text",
    group: str | None = "lang",
    chunk_size: int = 35_000,
    line_sep: str = "\n",
) -> None:
    """Text files of at most ``chunk_size`` records, one folder per group, none of them empty.

    The rows stay in their scan partitions: no shuffle, and a hot language is
    written by all tasks that hold it.
    """
    columns = [text] if group is None else [group, text]
    writer = df.select(*columns).write.mode("overwrite").option("maxRecordsPerFile", chunk_size)
    writer = writer.option("lineSep", line_sep)
    (writer if group is None else writer.partitionBy(group)).text(path)


def shard_plan(df: DataFrame, key: str, group: str, chunk_size: int) -> DataFrame:
    """Shard number of every record when records are numbered per group."""
    ranked = rank_by_id(df, key, "row_no", [group])
    return ranked.withColumn("shard_no", F.floor(F.col("row_no") / chunk_size).cast("bigint"))


def write_line_counts(counts: DataFrame, path: str, group: str = "lang", count: str = "line_count") -> None:
    line = F.concat(F.lit("line_count: "), F.col(count).cast("string")).alias("value")
    counts.select(F.col(group), line).write.mode("overwrite").partitionBy(group).text(path)


def write_jsonl(df: DataFrame, path: str, tasks: int | None = 64) -> None:
    """Uncompressed JSON lines, written by ``tasks`` tasks; None writes them as they are read."""
    spread(df, tasks).write.mode("overwrite").option("compression", "none").json(path)


def round_robin_chunks(df: DataFrame, key: str, seed: str | int, n_chunks: int) -> DataFrame:
    """Line i of the shuffled corpus goes to chunk ``i mod n_chunks``."""
    shuffled = global_shuffle(df, seed, key, "rank")
    return shuffled.withColumn("chunk", (F.col("rank") % n_chunks).cast("int"))


def chunk_name(prefix: str, suffix: str, chunk: str = "chunk"):
    """At least two digits; larger numbers keep all of theirs."""
    return F.concat(F.lit(prefix), F.format_string("%02d", F.col(chunk).cast("bigint")), F.lit(suffix))


def write_snapshot(df: DataFrame, path: str, split: str = "split") -> None:
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Append metric rows as JSON lines, stamped with the time of writing."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    df.withColumn("created_at", stamp).write.mode("append").json(path)


def write_tokenizer(vocab: DataFrame, merges: DataFrame, config: DataFrame, path: str) -> None:
    """The tokenizer's tables and its one configuration row, as JSON."""
    vocab.write.mode("overwrite").json(f"{path}/vocab")
    merges.write.mode("overwrite").json(f"{path}/merges")
    config.write.mode("overwrite").json(f"{path}/config")


def write_tokenizer_file(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    """One tokenizer JSON document; vocabularies are bounded by their configured size."""
    pieces = vocab.agg(F.map_from_entries(F.collect_list(F.struct("piece", "id"))).alias("vocab"))
    ranked = merges.agg(F.array_sort(F.collect_list(F.struct("rank", "left", "right"))).alias("m"))
    lines = ranked.select(F.transform("m", lambda x: F.concat_ws(" ", x["left"], x["right"])).alias("merges"))
    document = pieces.withColumn("merges", lines.scalar())
    document.select(F.struct("vocab", "merges").alias("model")).write.mode("overwrite").json(path)
