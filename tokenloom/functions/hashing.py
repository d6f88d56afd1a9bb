"""Deterministic uniforms.

``rand()`` depends on how rows are partitioned, so a task re-run after a lost
executor could draw other numbers.  These draws depend on seed and key alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def md5_hex(seed: str | int, *keys: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]).cast("binary"))


def md5_uniform(seed: str | int, *keys: Column) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of an md5."""
    return F.conv(F.substring(md5_hex(seed, *keys), 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


def md5_bucket(seed: str | int, *keys: Column, hex_digits: int = 4) -> Column:
    """The leading bits of the same draw: buckets are in the order of ``md5_uniform``."""
    return F.conv(F.substring(md5_hex(seed, *keys), 1, hex_digits), 16, 10).cast("int")


def gaussian(seed: str | int, *keys: Column) -> Column:
    """Standard normal draw (Box-Muller over two uniforms)."""
    u1 = F.greatest(md5_uniform(f"{seed}/r", *keys), F.lit(1.0 / TWO_32))
    u2 = md5_uniform(f"{seed}/a", *keys)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * F.pi() * u2)
