"""Fixed-size bitmaps of 64-bit keys: they let most rows without a partner skip an exchange.

A bitmap never misses a key it was built from, so a join behind it gives the same rows.  Its size is
fixed, whatever the number of keys: with too many it only lets more rows pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 23


def key_bitmap(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Words of 64 bits, ``2 ** bits`` in all; at most ``2 ** (bits - 6)`` rows reach the driver."""
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = keys.filter(F.col(column).isNotNull()).select((F.shiftright(slot, 6)).alias("word"), slot.bitwiseAND(F.lit(63)).alias("bit"))
    found = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("set")).collect()
    bitmap = np.zeros(1 << (bits - 6), dtype=np.uint64)
    for row in found:
        bitmap[row["word"]] = row["set"] & 0xFFFFFFFFFFFFFFFF
    return bitmap


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False where a key is certainly not in the bitmap."""
    slot = keys.view(np.uint64) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
