"""Readers: Parquet by language, JSON lines, CSV pairs, text globs, logs, tokenizer files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.operators.ordering import slice_rows

TEXT_SCHEMA = "text string, content string"
PAIR_SCHEMA = "en string, fr string"
METRIC_SCHEMA = "global_step bigint, run bigint, kind string, `loss/out` double, `speed/k` bigint, created_at string"


def read_languages(spark: SparkSession, base: str, languages: Sequence[str], folder: str = "{}") -> DataFrame:
    """Parquet files below one folder per language, tagged with the language of their path."""
    paths = [f"{base.rstrip('/')}/{folder.format(lang)}" for lang in languages]
    found = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(*paths)
    )
    named = folder.format(f"({'|'.join(languages)})")
    return found.withColumn("lang", F.regexp_extract(F.col("_metadata.file_path"), f".*/{named}/", 1))


def read_documents(spark: SparkSession, path: str, text_key: str = "text") -> DataFrame:
    """Parquet documents with a configurable text column; only that column is read."""
    return spark.read.parquet(path).select(F.col(text_key).alias("text"))


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: str = TEXT_SCHEMA) -> DataFrame:
    """JSON lines with a stated schema: no inference pass over the files."""
    return spark.read.schema(schema).json(paths if isinstance(paths, str) else list(paths))


def hadoop_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files below a folder (the listing only, no data)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names, files = [], fs.listFiles(root, True)
    while files.hasNext():
        name = files.next().getPath().toString()
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            names.append(name)
    return sorted(names)


def read_auto(spark: SparkSession, path: str, schema: str = TEXT_SCHEMA) -> DataFrame:
    """Choose the reader from the one extension found: Parquet or JSON lines."""
    extensions = {name.rsplit(".", 1)[-1] for name in hadoop_files(spark, path)}
    if not extensions:
        raise ValueError(f"no files below {path}")
    if len(extensions) > 1:
        raise ValueError(f"mixed file types below {path}: {sorted(extensions)}")
    kind = extensions.pop()
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind in ("json", "jsonl"):
        return read_jsonl(spark, path, schema)
    raise NotImplementedError(f"no reader for .{kind} files")


def read_csv_pairs(spark: SparkSession, path: str, schema: str = PAIR_SCHEMA) -> DataFrame:
    """CSV with a header and quoted line breaks; an empty unquoted field is null."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def read_text_glob(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """Lines of the text files that match; no match is an error."""
    df = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("lineSep", "\n")
        .text(path)
    )
    if not df.inputFiles():
        raise ValueError(f"no training files match {pattern} below {path}")
    return df


def read_allowed(spark: SparkSession, base: str, allow_patterns: str, kind: str = "parquet") -> DataFrame:
    """Files that match one of the comma-separated include globs."""
    globs = [f"{base.rstrip('/')}/{p.strip()}" for p in allow_patterns.split(",") if p.strip()]
    return spark.read.option("basePath", base).format(kind).load(globs)


def read_metric_log(spark: SparkSession, path: str, schema: str = METRIC_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_tokenizer(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Tokenizer JSON -> ``vocab(piece, id)`` and ``merges(rank, left, right)``."""
    schema = T.StructType(
        [
            T.StructField(
                "model",
                T.StructType(
                    [
                        T.StructField("vocab", T.MapType(T.StringType(), T.IntegerType())),
                        T.StructField("merges", T.ArrayType(T.StringType())),
                    ]
                ),
            )
        ]
    )
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    vocab = raw.select(F.explode("model.vocab").alias("piece", "id"))
    merges = raw.select(F.posexplode("model.merges").alias("rank", "pair")).select(
        "rank",
        F.substring_index("pair", " ", 1).alias("left"),
        F.substring_index("pair", " ", -1).alias("right"),
    )
    return vocab, merges


def slice_cached(
    df: DataFrame, key: str, cache: str, name: str, start: int, end: int, force_reload: bool = False
) -> DataFrame:
    """Rows ``[start, end)``, written once under name and range and read from there."""
    spark = df.sparkSession
    path = f"{cache.rstrip('/')}/{name}_{start}_{end}"
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    fs = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if force_reload or not fs.exists(done):
        slice_rows(df, key, start, end).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
