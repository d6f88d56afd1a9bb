"""Streaming queries, each run to the end of its input; the results equal the batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.functions.arrays import window_checksum, window_sum
from tokenloom.operators.ordering import rank_by_id
from tokenloom.operators import mixture as mx
from tokenloom.plans.catalog import ORACLES, register
from tokenloom.plans.corpus import SEED, documents
from tokenloom.plans.loader import (
    BATCH,
    PREFETCH,
    SEQ_LEN,
    STREAM_SQL,
    WEIGHTS,
    WINDOW,
    clean_documents,
    packed_windows,
)
from tokenloom.session import scratch_path, written
from tokenloom.sources import jsonl, writers
from tokenloom.streaming import jobs


@register("stream_jsonl_resumable", "SELECT doc_id, text FROM documents")
def stream_jsonl_resumable(spark, sf_dir):
    """Two runs over one checkpoint: the first ends inside a file, the second goes on behind its last line."""
    base = scratch_path(spark, "stream-jsonl")
    writers.write_jsonl(documents(spark, sf_dir, "doc_id", "text"), f"{base}/in", tasks=None)
    half = spark.read.text(f"{base}/in").agg(F.sum(F.octet_length("value") + 1)).first()[0] // 2
    for limit in ({"untilBytes": half}, {}):
        lines = jsonl.stream_lines(spark, f"{base}/in", **limit)
        jobs.append_to(jsonl.parsed(lines, "doc_id bigint, text string"), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("doc_id", "text")


@register("stream_pack_tokens", f"WITH {STREAM_SQL} SELECT * FROM full_windows")
def stream_pack_tokens(spark, sf_dir):
    """Documents arrive in three parts in id order; windows run on across micro-batches."""
    base = scratch_path(spark, "stream-pack")
    ids = documents(spark, sf_dir, "doc_id")
    ordered = rank_by_id(clean_documents(spark, sf_dir), "doc_id", "rn", ids=ids)
    third = F.floor(F.col("rn") * 3 / ids.agg(F.count(F.lit(1))).scalar())
    ordered.withColumn("part", third.cast("int")).drop("rn").write.partitionBy("part").parquet(f"{base}/staged")
    stream_dir = f"{base}/in"
    step = jobs.pack_step(
        "doc_id",
        "shard",
        "text",
        WINDOW,
        SEQ_LEN,
        f"{base}/out",
        f"{base}/state",
    )
    for part in range(3):
        # the next part of the stream arrives, then the query goes on from its checkpoint
        spark.read.parquet(f"{base}/staged/part={part}").write.mode("append").parquet(stream_dir)
        jobs.run_batches(jobs.stream_table(spark, stream_dir, "*.parquet"), step, f"{base}/checkpoint")
    w = F.col("window")
    return spark.read.parquet(f"{base}/out").select(
        "shard",
        "window_id",
        F.size(w).alias("n_tokens"),
        window_sum(w).alias("token_sum"),
        window_checksum(w).alias("check_sum"),
    )


@register("stream_block_shuffle", ORACLES["block_shuffle_batches"])
def stream_block_shuffle(spark, sf_dir):
    """Windows arrive in several files; a block comes out when its last window is in.

    A row without a checksum says how many windows its shard has, so that a short last block comes out too.
    """
    base = scratch_path(spark, "stream-block")
    windows = packed_windows(spark, sf_dir).select("shard", "window_id", window_checksum(F.col("window")).alias("check_sum"))
    windows.repartition(4).write.parquet(f"{base}/in")
    ends = spark.read.parquet(f"{base}/in").groupBy("shard").agg(F.count(F.lit(1)).alias("window_id"))
    ends.withColumn("check_sum", F.lit(None).cast("bigint")).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = jobs.stream_table(spark, f"{base}/in", "*.parquet", 1)
    mixed = jobs.block_shuffle_stream(stream, "window_id", "check_sum", BATCH, PREFETCH, SEED, "shard")
    jobs.append_to(mixed, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select(
        "shard",
        F.col("idx").alias("window_id"),
        F.col("payload").alias("check_sum"),
        "batch",
        "pos_in_batch",
    )


@register(
    "stream_metric_rollup",
    """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(count(*) / 3600.0, 6) AS rate, round(avg(value), 6) AS mean
       FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
       GROUP BY ALL""",
)
def stream_metric_rollup(spark, sf_dir):
    """Hourly metrics; a window is final once the watermark has passed its end."""
    base = scratch_path(spark, "stream-metrics")
    events = jobs.stream_table(spark, sf_dir, "events.parquet").withColumn("time", F.col("ts").cast("timestamp"))
    rolled = jobs.metric_rollup(events, "time", ["event_type"], "value", "1 hour", "10 minutes")
    jobs.append_to(rolled, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "event_type",
        "n",
        F.round("rate", 6).alias("rate"),
        F.round("mean", 6).alias("mean"),
    )


@register("stream_mixture", ORACLES["mixture_weighted_draws"])
def stream_mixture(spark, sf_dir):
    """Draws arrive in three parts; each is handed the next document of its source, epoch after epoch."""
    base = scratch_path(spark, "stream-mixture")
    docs = documents(spark, sf_dir, "doc_id", "lang")
    slots = written(mx.source_slots(docs, "doc_id", "lang", WEIGHTS), "mixture-slots")
    draws = docs.select(F.col("doc_id").alias("draw_id"))
    ranked = rank_by_id(draws, "draw_id", "rn")
    third = F.floor(F.col("rn") * 3 / draws.agg(F.count(F.lit(1))).scalar()).cast("int")
    ranked.select("draw_id", third.alias("part")).write.partitionBy("part").parquet(f"{base}/staged")
    step = jobs.mixture_step("draw_id", WEIGHTS, SEED, slots, "doc_id", f"{base}/out", f"{base}/state")
    for part in range(3):
        spark.read.parquet(f"{base}/staged/part={part}").write.mode("append").parquet(f"{base}/in")
        jobs.run_batches(jobs.stream_table(spark, f"{base}/in", "*.parquet"), step, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("draw_id", "source", "epoch", "doc_id")
