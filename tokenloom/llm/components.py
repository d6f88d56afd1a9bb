"""Connected components of a link table, by large-star and small-star steps.

Every step is an aggregation and a join; nothing is gathered.  Tables are written to the shared
folder between the steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.storage import staged


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
    found = both.join(least, F.col("a") == F.col("of")).filter("b > a")
    return found.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
    moved = down.join(least, F.col("a") == F.col("of")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("of").alias("a"), F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node that has a link; ``links`` has non-null ``a, b``.

    A component is named by its smallest node.  Loops and repeated links change nothing; no links
    give no rows.  The steps end when the links form stars and no longer change.
    """
    now = staged(links.select("a", "b").filter("a <> b").distinct(), "links")
    mark = _mark(now)
    while True:
        now = staged(_small_star(staged(_large_star(now), "links")), "links")
        if (then := _mark(now)) == mark:
            break
        mark = then
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
