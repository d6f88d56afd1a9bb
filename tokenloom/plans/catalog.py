"""Registry of queries over the test tables and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Pieces of DuckDB SQL shared by the checks.


def sql_uniform(seed: str | int, key: str) -> str:
    return f"(CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT) / 4294967296.0)"


def sql_bytes(text: str) -> str:
    """List of the UTF-8 byte values of a text."""
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::INT)"


def sql_tokens(text: str, bos: int = 256, eos: int = 257) -> str:
    return f"list_concat(list_concat([{bos}], {sql_bytes(text)}), [{eos}])"


def sql_checksum(tokens: str) -> str:
    return f"CAST(coalesce(list_sum(list_transform({tokens}, lambda x, i: x::BIGINT * i)), 0) AS BIGINT)"
