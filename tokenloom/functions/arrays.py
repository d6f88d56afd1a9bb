"""Array helpers built on Spark's higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    Without it the optimizer may inline an expensive array into the inside of
    a lambda and rebuild it for every element.
    """
    return F.transform(F.array(value), body).getItem(0)


def array_sum(values: Column, kind: str = "bigint") -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda acc, x: acc + x.cast(kind))


def checksum(tokens: Column) -> Column:
    """Order-sensitive sum: element i counts i + 1 times."""
    return array_sum(F.transform(tokens, lambda x, i: x.cast("bigint") * (i + 1)))


def _list_sums(lists: pa.Array, weighted: bool) -> pa.Array:
    """Of each list its sum, or its ``checksum``; null stays null."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy().astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    if weighted:
        values = values * (np.arange(1, len(values) + 1) - np.repeat(ends - sizes, sizes))
    upto = np.concatenate([[0], np.cumsum(values)])
    return pa.array(upto[ends] - upto[ends - sizes], mask=lists.is_null().to_numpy(zero_copy_only=False))


@F.arrow_udf(LongType())
def window_sum(windows: pa.Array) -> pa.Array:
    """``array_sum`` of integer lists of bounded size without nulls, a batch in one numpy step."""
    return _list_sums(windows, False)


@F.arrow_udf(LongType())
def window_checksum(windows: pa.Array) -> pa.Array:
    """``checksum`` of integer lists of bounded size without nulls, a batch in one numpy step."""
    return _list_sums(windows, True)


def slice_from(values: Column, start0: Column, length: Column) -> Column:
    """``values[start0 : start0 + length]`` with a zero-based start."""
    return F.slice(values, start0.cast("int") + 1, length.cast("int"))


def exclusive_cumsum(values: Column) -> Column:
    """Start offset of every segment: ``[0, v0, v0+v1, ...]`` without the total."""
    sums = F.aggregate(
        values,
        F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("run")),
        lambda acc, x: F.struct(
            F.concat(acc["out"], F.array(acc["run"])).alias("out"),
            (acc["run"] + x.cast("bigint")).alias("run"),
        ),
    )
    return sums["out"]


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    """Numerically stable softmax of ``logits / temperature``."""
    scaled = F.transform(logits, lambda x: x.cast("double") / F.lit(float(temperature)))
    return let(
        scaled,
        lambda v: let(
            F.array_max(v),
            lambda top: let(
                F.transform(v, lambda x: F.exp(x - top)),
                lambda e: let(array_sum(e, "double"), lambda total: F.transform(e, lambda x: x / total)),
            ),
        ),
    )


def log_softmax_at(logits: Column, index: Column) -> Column:
    """log softmax(logits)[index] with the log-sum-exp shift."""
    doubles = F.transform(logits, lambda x: x.cast("double"))
    return let(
        doubles,
        lambda v: let(
            F.array_max(v),
            lambda top: v[index] - top - F.log(array_sum(F.transform(v, lambda x: F.exp(x - top)), "double")),
        ),
    )


def argmax(values: Column) -> Column:
    """Zero-based place of the largest element; the first one wins a tie."""
    return let(values, lambda v: F.array_position(v, F.array_max(v)) - 1)


def entropy(probabilities: Column) -> Column:
    """-sum(p log p); masked terms (p = 0) count zero."""
    return F.aggregate(
        probabilities,
        F.lit(0.0),
        lambda acc, p: acc - F.when(p == 0, F.lit(0.0)).otherwise(p * F.log(p)),
    )
