"""JSON-lines shards by line number, by stride and by byte place.

A shard is a folder of files in name order, or a single file.  Line numbers and byte places come from the
splits that Spark reads: every task counts lines and bytes within its splits, and prefix sums over the splits
of a shard (a row each) give where each begins.  No line is exchanged.

The stream resumes at a byte of a file in an epoch: its offset is ``(epoch, file, position)``, and a batch is
cut into byte ranges that any task can read.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

LINE_FIELDS = "file string, block bigint, line_in bigint, end_in bigint"
STREAM_FIELDS = "value string, file string, position bigint, current_iter int"
PIECE = 1 << 20
TAIL = 1 << 16


# ---- batch -------------------------------------------------------------------


def _split_lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    lines = reader.text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _numbered_in_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line and end byte of each line within its split; the lines of a split come on end and in file order."""
    key, line, end = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        sizes = batch.column("n_bytes").to_numpy(zero_copy_only=False)
        keys = list(zip(files, blocks, strict=True))
        edges = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        lines, ends = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        for a, b in zip([0, *edges], [*edges, len(keys)], strict=True):
            if keys[a] != key:
                key, line, end = keys[a], 0, 0
            lines[a:b] = line + np.arange(b - a)
            ends[a:b] = end + np.cumsum(sizes[a:b])
            line, end = line + b - a, int(ends[b - 1])
        columns = [batch.column(c) for c in ("value", "file", "block")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(lines), pa.array(ends)], names=["value", "file", "block", "line_in", "end_in"])


def folder_of(file: Column) -> Column:
    return F.regexp_extract(file, "^(.*)/[^/]*$", 1)


def numbered_lines(
    spark: SparkSession, path: str, shard: Column | None = None, pattern: str = "*", value: Column | None = None
) -> DataFrame:
    """``value, file, shard, line_no, position``: every line with its number in the shard from 0 and the byte behind it in its file.

    ``shard`` is an expression over ``file`` (default: its folder); the files of a shard follow one another
    by name.  A last line without a line feed counts as if it had one.  Files below ``path`` that match
    ``pattern`` are read; empty files have no lines.  ``value`` is what is wanted of a line, an expression over
    it (default: the line): nothing else of it goes through Python.
    """
    shard = folder_of(F.col("file")) if shard is None else shard
    lines = _split_lines(spark, path, pattern)
    n_bytes = F.octet_length("value").cast("bigint") + 1
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"), F.sum(n_bytes).alias("bytes"))
    earlier = Window.partitionBy("shard").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    based = splits.withColumn("shard", shard).select(
        "file", "block", "shard",
        F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("first_line"),
        F.coalesce(F.sum("bytes").over(in_file), F.lit(0)).alias("first_byte"),
    )
    wanted = lines.select((F.col("value") if value is None else value).alias("value"), "file", "block", n_bytes.alias("n_bytes"))
    fields = T.StructType([T.StructField("value", wanted.schema["value"].dataType), *T.StructType.fromDDL(LINE_FIELDS)])
    placed = wanted.mapInArrow(_numbered_in_split, fields).join(based, ["file", "block"])
    number, position = F.col("first_line") + F.col("line_in"), F.col("first_byte") + F.col("end_in")
    return placed.select("value", "file", "shard", number.alias("line_no"), position.alias("position"))


def strided(lines: DataFrame, block_size: int, offset: int | None = None) -> DataFrame:
    """Which of ``block_size`` readers takes each line (``offset``), or the lines of one of them."""
    if block_size < 1:
        raise ValueError("block_size must be at least 1")
    if offset is not None and not 0 <= offset < block_size:
        raise ValueError(f"offset {offset} is outside [0, {block_size})")
    dealt = lines.withColumn("offset", (F.col("line_no") % block_size).cast("int"))
    return dealt if offset is None else dealt.filter(F.col("offset") == offset)


def json_field(name: str, kind: str) -> Column:
    """One field of a line's JSON object, as a ``value`` of ``numbered_lines``."""
    return F.from_json("value", f"{name} {kind}")[name]


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """The lines with the fields of their JSON objects in place of ``value``."""
    others = [c for c in lines.columns if c != "value"]
    return lines.withColumn("_json", F.from_json("value", schema)).select("_json.*", *others)


def validation_lines(
    spark: SparkSession, path: str, max_steps: int | None, pattern: str = "*.val.jsonl", value: Column | None = None
) -> DataFrame:
    """``value, source, step, current_iter``: one pass over the validation files of each source (a folder
    directly below ``path``), at most ``max_steps`` lines of each; ``value`` as in ``numbered_lines``."""
    source = F.regexp_extract(F.col("file"), "^.*/([^/]+)/[^/]*$", 1)
    lines = numbered_lines(spark, path, source, pattern, value)
    rows = lines.select("value", F.col("shard").alias("source"), F.col("line_no").alias("step"), F.lit(0).alias("current_iter"))
    return rows if max_steps is None else rows.filter(F.col("step") < max_steps)


# ---- stream ------------------------------------------------------------------


@dataclass
class ByteRange(InputPartition):
    """Lines of a file that begin in ``[start, stop)``; ``whole`` if ``start`` is known to begin a line."""

    file: str
    start: int
    stop: int
    whole: bool
    epoch: int


class LineStreamReader(DataSourceStreamReader):
    """Lines of all files below a folder, in name order, ``epochs`` times over."""

    def __init__(self, options: dict):
        self.system, self.folder = fs.FileSystem.from_uri(options["path"]) if "://" in options["path"] else (fs.LocalFileSystem(), options["path"])
        self.suffix, self.epochs = options.get("suffix", ".json"), int(options.get("epochs", 1))
        self.range_bytes = int(options.get("rangebytes", 64 << 20))
        self.until = int(options["untilbytes"]) if "untilbytes" in options else None

    def files(self) -> list[tuple[str, int]]:
        found = self.system.get_file_info(fs.FileSelector(self.folder, recursive=True, allow_not_found=True))
        return sorted((f.path, f.size) for f in found if f.is_file and f.size and f.path.endswith(self.suffix) and not posixpath.basename(f.path).startswith(("_", ".")))

    def last_line_end(self, file: str, size: int) -> int:
        """The place behind the last line feed before ``size``."""
        with self.system.open_input_file(file) as f:
            while size > 0:
                low = max(0, size - TAIL)
                f.seek(low)
                if (at := f.read(size - low).rfind(b"\n")) >= 0:
                    return low + at + 1
                size = low
        return 0

    def initialOffset(self) -> dict:
        return {"epoch": 0, "file": "", "position": 0}

    def latestOffset(self) -> dict:
        """The end of what is there: behind the last whole line, or that before ``untilBytes`` bytes of an epoch."""
        files, left, last = self.files(), self.until, None
        for file, size in files:
            if left is not None and size > left:
                return {"epoch": 0, "file": file, "position": self.last_line_end(file, left)}
            left, last = None if left is None else left - size, (file, size)
        if last is None:
            return self.initialOffset()
        return {"epoch": self.epochs - 1, "file": last[0], "position": self.last_line_end(*last)}

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        out, files = [], self.files()
        for epoch in range(start["epoch"], end["epoch"] + 1):
            for file, size in files:
                low = start["position"] if (epoch, file) == (start["epoch"], start["file"]) else 0
                last = (epoch, file) == (end["epoch"], end["file"])
                high = end["position"] if last else self.last_line_end(file, size)
                if (epoch, file) < (start["epoch"], start["file"]) or (epoch, file) > (end["epoch"], end["file"]):
                    continue
                out += [ByteRange(file, a, min(a + self.range_bytes, high), a == low, epoch) for a in range(low, high, self.range_bytes)]
        return out

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        with self.system.open_input_file(partition.file) as raw:
            place, rest = partition.start, b""
            if not partition.whole:  # the line that began before belongs to another range
                place -= 1
                raw.seek(place)
                while (piece := raw.read(PIECE)) and (at := piece.find(b"\n")) < 0:
                    place += len(piece)
                if not piece:
                    return
                place, rest = place + at + 1, piece[at + 1 :]
            else:
                raw.seek(place)
            more = True
            while place < partition.stop and more:
                piece = raw.read(max(PIECE, len(rest)))
                more = bool(piece)
                *lines, rest = (rest + piece).split(b"\n")
                ends = place + np.cumsum([len(line) + 1 for line in lines], dtype=np.int64)
                n = int(np.searchsorted(np.append(place, ends), partition.stop)) if lines else 0
                n = min(n, len(lines))
                if n:
                    columns = [pa.array(lines[:n], pa.binary()).cast(pa.string()), pa.array([partition.file] * n)]
                    columns += [pa.array(ends[:n]), pa.array([partition.epoch] * n, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["value", "file", "position", "current_iter"])
                    place = int(ends[n - 1])
                if n < len(lines):
                    return


class LineSource(DataSource):
    """``spark.readStream.format("tokenloom_jsonl")``; options ``path``, ``suffix``, ``epochs``, ``rangeBytes``, ``untilBytes``."""

    @classmethod
    def name(cls) -> str:
        return "tokenloom_jsonl"

    def schema(self) -> str:
        return STREAM_FIELDS

    def streamReader(self, schema) -> LineStreamReader:
        return LineStreamReader({k.lower(): v for k, v in self.options.items()})


def stream_lines(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """``value, file, position, current_iter`` of the whole lines below ``path``, in name order and ``epochs`` times.

    The folder must be one that Arrow's file systems reach from every executor.  A line that is still without
    its line feed waits for the next batch; files that come later must sort behind those already read.
    """
    spark.dataSource.register(LineSource)
    reader = spark.readStream.format(LineSource.name()).option("path", path)
    for name, value in options.items():
        reader = reader.option(name, str(value))
    return reader.load()
