"""Structured Streaming twins of the batch operators.

State that one group can hold within fixed bounds lives in the state store.
Where a single key could be hot (a source, a shard), the micro-batch is ranked
with the batch operators and only a small carry-over table moves from one batch
to the next; it is written under the batch number, so a batch that is run again
after a failure overwrites its own files and starts from the same state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tokenloom.functions.arrays import slice_from
from tokenloom.functions.hashing import md5_uniform
from tokenloom.functions.tokens import byte_token_count, byte_tokens
from tokenloom.operators.mixture import choose_source, hand_out
from tokenloom.operators.ordering import offset_by_id, rank_by_id
from tokenloom.operators.packing import cut_byte_windows


def run_to_end(writer) -> None:
    """Process everything that is there, in as many micro-batches as the source gives."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def stream_jsonl(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """JSON-lines shards as a stream; the checkpoint remembers which files were read."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def stream_table(spark: SparkSession, folder: str, pattern: str, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as a stream; without a limit a micro-batch takes all that have arrived."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("pathGlobFilter", pattern).parquet(folder)


def append_to(df: DataFrame, out: str, checkpoint: str) -> None:
    run_to_end(df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint))


def metric_rollup(df: DataFrame, time: str, keys: list[str], value: str, width: str, delay: str) -> DataFrame:
    """Counts, rate and mean per time window; the watermark bounds the state."""
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    return (
        df.withWatermark(time, delay)
        .groupBy(F.window(time, width), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(
            F.col("window.start").alias("window_start"),
            *keys,
            "n",
            (F.col("n") / seconds).alias("rate"),
            (F.col("total") / F.col("n")).alias("mean"),
        )
    )


def block_shuffle_stream(
    df: DataFrame, index: str, payload: str, batch_size: int, prefetch: int, seed: str | int, shard: str
) -> DataFrame:
    """Hold each block of ``prefetch * batch_size`` sequences until it is complete, then emit it shuffled.

    The group is one block of one shard, so its state never exceeds the block,
    and it is removed once the block is out.  A row with a null payload ends its
    shard: ``index`` is then how many sequences the shard has, and a short last
    block comes out with them (its full batches, as in the batch operator).
    """
    block_rows = prefetch * batch_size
    keyed = df.select(
        F.col(shard).cast("int").alias("shard"),
        F.floor(F.col(index) / block_rows).cast("bigint").alias("block"),
        F.col(index).cast("bigint").alias("idx"),
        F.col(payload).cast("bigint").alias("payload"),
        md5_uniform(seed, F.col(shard), F.col(index)).alias("u"),
    )

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState):
        held, wanted = [], block_rows
        if state.exists:
            *columns, wanted = state.get
            held = list(zip(*columns))
        for pdf in frames:
            ends = pdf["payload"].isna()
            for end in pdf["idx"][ends].tolist():
                wanted = end - key[1] * block_rows
            rows = pdf[~ends]
            held += list(zip(rows["u"].tolist(), rows["idx"].tolist(), rows["payload"].astype("int64").tolist()))
        if len(held) < wanted:
            columns = [list(column) for column in zip(*held)] or [[], [], []]
            state.update((*columns, wanted))
            return
        if state.exists:
            state.remove()
        held = sorted(held)[: len(held) // batch_size * batch_size]
        rows = range(len(held))
        yield pd.DataFrame(
            {
                "shard": [key[0]] * len(held),
                "idx": [h[1] for h in held],
                "payload": [h[2] for h in held],
                "batch": [key[1] * prefetch + i // batch_size for i in rows],
                "pos_in_batch": [i % batch_size for i in rows],
            }
        )

    return keyed.groupBy("shard", "block").applyInPandasWithState(
        step,
        "shard int, idx bigint, payload bigint, batch bigint, pos_in_batch int",
        "u array<double>, idx array<bigint>, payload array<bigint>, wanted bigint",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def _carried(spark: SparkSession, state: str, batch_id: int, schema: str) -> DataFrame:
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{state}/batch={batch_id - 1}")


def mixture_step(
    draw: str, weights: Mapping[str, float], seed: str | int, slots: DataFrame, key: str, out: str, state: str
) -> Callable[[DataFrame, int], None]:
    """Hand the next document of its source to each draw; sources go on from micro-batch to micro-batch.

    ``slots`` is a written table of ``key, source, slot`` (see ``source_slots``).  The carry-over is one counter
    per source, so a hot source is no task's state.
    """
    schema = "source string, used bigint"

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _carried(spark, state, batch_id, schema)
        drawn = batch.select(draw).withColumn("source", choose_source(weights, seed, F.col(draw)))
        ranked = rank_by_id(drawn, draw, "_rank", ["source"])
        counters = F.broadcast(before)  # one row per configured source
        placed = ranked.join(counters, "source", "left").select(
            draw, "source", (F.coalesce("used", F.lit(0)) + F.col("_rank")).alias("ordinal")
        )
        hand_out(placed, slots, draw, key).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        fresh = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("used"))
        total = before.unionByName(fresh).groupBy("source").agg(F.sum("used").alias("used"))
        total.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    return step


def pack_step(
    key: str, shard: str, text: str, length: int, step_size: int, out: str, state: str
) -> Callable[[DataFrame, int], None]:
    """Pack the byte tokens of each micro-batch behind the unfinished window of the batches before.

    Carry-over per shard: the number of tokens seen and the fewer than ``length``
    tokens that the next window starts with.
    """
    schema = f"{shard} int, seen bigint, rest array<int>"
    n_tokens = byte_token_count(F.col(text))

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _carried(spark, state, batch_id, schema)
        placed = offset_by_id(batch.withColumn("_n", n_tokens), F.col("_n"), key, "_start", [shard])
        base = before.select(shard, "seen")
        fresh = placed.join(base, shard, "left").select(
            shard,
            (F.coalesce("seen", F.lit(0)) + F.col("_start")).alias("s"),
            "_n",
            text,
        )
        held = before.select(shard, (F.col("seen") - F.size("rest")).alias("s"), F.col("rest").alias("t"))
        windows = cut_byte_windows(fresh, text, "s", length, step_size, [shard], held)
        windows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        sizes = batch.groupBy(shard).agg(F.sum(n_tokens).cast("bigint").alias("seen"))
        seen = before.select(shard, "seen").unionByName(sizes).groupBy(shard).agg(F.sum("seen").alias("seen"))
        done = F.when(F.col("seen") >= length, F.floor((F.col("seen") - length) / step_size) + 1).otherwise(0)
        ends = seen.withColumn("_from", (done * step_size).cast("bigint"))
        # tokens are built for the rows behind the last whole window alone
        behind = fresh.join(F.broadcast(ends), shard).filter(F.col("s") + F.col("_n") > F.col("_from"))
        built = behind.select(shard, "s", "_from", byte_tokens(F.col(text)).cast("array<int>").alias("t"))
        kept = held.join(ends.select(shard, "_from"), shard).filter(F.col("s") + F.size("t") > F.col("_from"))
        tails = built.unionByName(kept)
        cut = F.greatest(F.col("_from") - F.col("s"), F.lit(0))
        pieces = tails.select(shard, F.struct("s", slice_from(F.col("t"), cut, F.size("t") - cut).alias("p")).alias("x"))
        rest = pieces.groupBy(shard).agg(F.flatten(F.array_sort(F.collect_list("x"))["p"]).alias("rest"))
        carry = ends.join(rest, shard, "left").select(
            shard, "seen", F.coalesce("rest", F.array().cast("array<int>")).alias("rest")
        )
        carry.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    return step


def run_batches(df: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    run_to_end(df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint))
