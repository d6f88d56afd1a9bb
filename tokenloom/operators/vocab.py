"""Vocabulary work over distinct-word tables."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import SPACE_MARK

# Special tokens with their ids below 256.
RANK_SPECIALS = {
    "<|begin_of_text|>": 0,
    "<|end_of_text|>": 1,
    "<|fim_prefix|>": 2,
    "<|fim_middle|>": 3,
    "<|fim_end_fill|>": 253,
    "<|fim_pad|>": 254,
    "<|fim_suffix|>": 255,
}
# Symbols a vocabulary reserves.
TABLE_TAGS = "table caption thead tbody tfoot tr th td".split()
HEADING_TAGS = "h1 h2 h3 h4 h5 h6 blockquote".split()
INLINE_TAGS = "strong em b i u s sub sup code".split()
OTHER_SYMBOLS = ["\t", "<mask>", "<2mass>", "[@BOS@]"]
CONTROL_SYMBOLS = ["<start_of_turn>", "<end_of_turn>", "<system_prompt>", "<language>", "</language>"]
UNUSED_SLOTS = 99
LONGEST_RUN = 31


def user_symbols() -> list[str]:
    """Line-break runs, space runs, tags, unused slots and the numbers 00-99 and 100-999."""
    runs = ["\n" * n for n in range(1, LONGEST_RUN + 1)] + [SPACE_MARK * n for n in range(2, LONGEST_RUN + 1)]
    tags = [form.format(t) for group in (TABLE_TAGS, HEADING_TAGS, INLINE_TAGS) for form in ("<{}>", "</{}>") for t in group]
    unused = [f"<unused{i}>" for i in range(UNUSED_SLOTS)]
    numbers = [f"{i:02d}" for i in range(100)] + [str(i) for i in range(100, 1000)]
    return runs + tags + OTHER_SYMBOLS + unused + numbers


def symbols_frame(spark: SparkSession, user: Sequence[str], control: Sequence[str]) -> DataFrame:
    rows = [(i, s, "user") for i, s in enumerate(user)]
    rows += [(len(rows) + i, s, "control") for i, s in enumerate(control)]
    return spark.createDataFrame(rows, "ord int, symbol string, kind string")


def write_symbols_yaml(spark: SparkSession, path: str, user: Sequence[str], control: Sequence[str]) -> None:
    """The inventory as one YAML file below ``path``; JSON strings are YAML strings."""
    sections = {"user_defined_symbols": user, "control_symbols": control}
    lines = [x for name, symbols in sections.items() for x in (f"{name}:", *(f"  - {json.dumps(s)}" for s in symbols))]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)


def symbols_from_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Symbol table from a YAML file with the keys user_defined_symbols and control_symbols."""
    import yaml

    lines = [r[0] for r in spark.read.text(path, wholetext=True).collect()]  # one configuration file
    data = yaml.safe_load(lines[0])
    return symbols_frame(spark, data.get("user_defined_symbols", []), data.get("control_symbols", []))


def word_counts(df: DataFrame, words: Column) -> DataFrame:
    """Distinct words with their counts; partial counts are made before the exchange."""
    return df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


RUN_BYTES = 1 << 20
CODE_POINTS = 0x110000


def _text_runs(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of an Arrow column of texts, in runs of whole texts of about ``RUN_BYTES``."""
    texts = column.cast(pa.large_string())
    if not len(texts) or texts.buffers()[2] is None:
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    at = ends[0]
    while at < ends[-1]:
        # at least one text that is not empty
        last = max(np.searchsorted(ends, at + RUN_BYTES, side="right") - 1, np.searchsorted(ends, at, side="right"))
        yield data[at : ends[last]]
        at = ends[last]


def byte_counts(df: DataFrame, text: Column) -> DataFrame:
    """``byte, cnt``: how often each byte value occurs in the UTF-8 texts; a task exchanges at most 256 rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            for run in _text_runs(batch.column(0)):
                total += np.bincount(run, minlength=256)
        found = np.flatnonzero(total)
        yield pa.record_batch({"byte": pa.array(found.astype(np.int32)), "cnt": pa.array(total[found])})

    parts = df.select(text.alias("text")).mapInArrow(count, "byte int, cnt bigint")
    return parts.groupBy("byte").agg(F.sum("cnt").alias("cnt"))


def char_counts(df: DataFrame, text: Column) -> DataFrame:
    """``ch, cnt``: how often each code point occurs; a task exchanges one row for each that it has seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODE_POINTS, np.int64)
        for batch in batches:
            for run in _text_runs(batch.column(0)):
                codes = np.frombuffer(run.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
                seen = np.bincount(codes)
                total[: len(seen)] += seen
        found = np.flatnonzero(total)
        yield pa.record_batch({"ch": pa.array([chr(c) for c in found], pa.string()), "cnt": pa.array(total[found])})

    parts = df.select(text.alias("text")).mapInArrow(count, "ch string, cnt bigint")
    return parts.groupBy("ch").agg(F.sum("cnt").alias("cnt"))


def coverage_alphabet(counts: DataFrame, coverage: float) -> DataFrame:
    """Smallest most-frequent-first character set that covers ``coverage`` of the text.

    ``counts`` has one row per code point, so the ordered window is bounded.
    """
    order = Window.orderBy(F.desc("cnt"), "ch")
    before = F.coalesce(F.sum("cnt").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("cnt").over(Window.partitionBy())
    ranked = counts.withColumn("_before", before).withColumn("_total", total)
    return ranked.filter(F.col("_before") < F.lit(coverage) * F.col("_total")).drop("_before", "_total")


def top_pieces(counts: DataFrame, piece: str, n: int) -> DataFrame:
    """The ``n`` most frequent pieces with ids 0..n-1 (per-task top n, then one merge)."""
    top = counts.orderBy(F.desc("cnt"), piece).limit(n)
    order = Window.orderBy(F.desc("cnt"), piece)
    return top.select(F.col(piece).alias("piece"), (F.row_number().over(order) - 1).alias("id"), "cnt")


def vocab_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pieces of either vocabulary after ``▁`` -> space, and where each occurs; one exchange."""

    def marked(df: DataFrame, side: str) -> DataFrame:
        return df.select(
            F.translate("piece", SPACE_MARK, " ").alias("piece"),
            F.lit(side == "left").alias("in_left"),
            F.lit(side == "right").alias("in_right"),
        )

    return placed(marked(left, "left").unionByName(marked(right, "right")))


def placed(marks: DataFrame) -> DataFrame:
    """Where each ``piece`` of ``piece, in_left, in_right`` occurs."""
    seen = marks.groupBy("piece").agg(F.bool_or("in_left").alias("in_left"), F.bool_or("in_right").alias("in_right"))
    place = F.when(F.col("in_left") & F.col("in_right"), "both").when(F.col("in_left"), "left").otherwise("right")
    return seen.select("piece", place.alias("place"))


def number_pieces(spark: SparkSession) -> DataFrame:
    """``00``-``99`` then ``000``-``999``, with their ordinal."""
    short = spark.range(100).select((F.col("id") + 1).alias("no"), F.lpad(F.col("id").cast("string"), 2, "0").alias("piece"))
    long = spark.range(1000).select((F.col("id") + 101).alias("no"), F.lpad(F.col("id").cast("string"), 3, "0").alias("piece"))
    return short.unionByName(long)


def extend_with_numbers(vocab: DataFrame) -> DataFrame:
    """Add the number pieces with ids after the largest one; an existing piece is numbered anew."""
    numbers = F.broadcast(number_pieces(vocab.sparkSession))  # 1,100 rows
    top = vocab.agg(F.max("id")).scalar()
    renewed = vocab.join(numbers.select("piece"), "piece", "left_anti").select("piece", F.col("id").cast("bigint"))
    return renewed.unionByName(numbers.select("piece", (top + F.col("no")).alias("id")))


def number_merges(spark: SparkSession) -> DataFrame:
    """Each number is merged from all but its last digit and the last digit."""
    p = F.col("piece")
    return number_pieces(spark).select("no", p.substr(F.lit(1), F.length(p) - 1).alias("left"), F.right(p, F.lit(1)).alias("right"))


def reserved_specials(spark: SparkSession, offset: Column) -> DataFrame:
    """The 256 special ids: named ones, the rest reserved, all after the ranked tokens."""
    named = F.create_map(*[F.lit(x) for name, i in RANK_SPECIALS.items() for x in (i, name)])
    ids = spark.range(256).withColumn("id", F.col("id").cast("int"))
    name = F.coalesce(named[F.col("id")], F.concat(F.lit("<|reserved_special_token_"), F.col("id").cast("string"), F.lit("|>")))
    return ids.select(name.alias("name"), (F.col("id") + offset).cast("bigint").alias("id"))


def unused_pieces(vocab: DataFrame) -> DataFrame:
    return vocab.filter(F.col("piece").rlike("^<unused\\d+>"))


def assign_special_slots(vocab: DataFrame, specials: Sequence[str]) -> DataFrame:
    """Put special tokens into the unused slots, from the highest slot down."""
    free = unused_pieces(vocab).count()
    if len(specials) > free - 1:
        raise ValueError(f"{len(specials)} special tokens for {free - 1} free slots")
    rows = [(f"<unused{free - 1 - i}>", s) for i, s in enumerate(specials)]
    slots = F.broadcast(vocab.sparkSession.createDataFrame(rows, "piece string, special string"))  # below 99 rows
    return vocab.join(slots, "piece", "left").select(
        F.coalesce("special", "piece").alias("piece"), "id", F.col("special").isNotNull().alias("is_special")
    )


def piece_ids(pieces: DataFrame, vocab: DataFrame, unk_id: int) -> DataFrame:
    """Id of every piece, ``unk_id`` for the unknown ones; Spark chooses the join by the size it measures."""
    side = vocab.select("piece", F.col("id").alias("_id"))
    return pieces.join(side, "piece", "left").withColumn("id", F.coalesce("_id", F.lit(unk_id))).drop("_id")
