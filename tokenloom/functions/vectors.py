"""Column expressions over vectors and token scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.arrays import array_sum


def all_near_zero(vector: Column, tolerance: float = 1e-8) -> Column:
    return F.forall(vector, lambda x: F.abs(x) <= tolerance)


def continuation_score(scores: Column, prompt_len: Column) -> Column:
    """Sum of the scores after the prompt."""
    return array_sum(
        F.slice(scores, prompt_len.cast("int") + 1, F.greatest(F.size(scores) - prompt_len, F.lit(0)).cast("int")),
        "double",
    )


def continuation_greedy(greedy: Column, prompt_len: Column) -> Column:
    """True when every token after the prompt was the greedy choice."""
    rest = F.slice(greedy, prompt_len.cast("int") + 1, F.greatest(F.size(greedy) - prompt_len, F.lit(0)).cast("int"))
    return F.forall(rest, lambda g: g)


def flatten_struct(df, sep: str = "/"):
    """Nested struct columns as flat columns whose names join the keys with ``sep``."""

    def walk(fields, path: list[str]):
        for field in fields:
            here = [*path, field.name]
            if hasattr(field.dataType, "fields"):
                yield from walk(field.dataType.fields, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here))

    return df.select(*walk(df.schema.fields, []))
