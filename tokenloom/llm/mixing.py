"""Mixing sources to target weights.

Each source gets a token budget (its share of the whole, never above ``max_repeat`` times
its size).  A budget is filled with complete epochs first; what is left is filled with
documents in Efraimidis-Spirakis order: the exponential key ``-ln(u) / quality`` ascending,
prefix-summed inside the source.  Prefix sums run over buckets of the key, so a source that
holds most rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.storage import staged
from tokenloom.operators.ordering import running_offset

WORD = r"[^\x20\x09-\x0D]+"
KEY_BUCKETS = 4096


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(seed: str, key: Column) -> Column:
    """Uniform double inside (0, 1) from 52 bits of an md5 of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def label_quality(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``labelled, quality`` per labelled document: 2 if good, 0.5 if bad.

    Several labels of one document count as bad if one of them does; null labels count as none.
    """
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("labelled")).agg(F.min("quality").alias("mark"))
    return marks.select("labelled", F.when(F.col("mark") == 1, 2.0).when(F.col("mark") == 0, 0.5).alias("quality"))


def sized_rows(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """``doc_id, source, text_hash, size, quality``: what the mix needs to know of a row; texts stay behind.

    Rows without a ``quality`` (see ``label_quality``) weigh 1.
    """
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("size"))
    if quality is None:
        return rows.withColumn("quality", F.lit(1.0))
    met = rows.join(quality, F.col("doc_id") == F.col("labelled"), "left").drop("labelled")
    return met.withColumn("quality", F.coalesce("quality", F.lit(1.0)))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_repeat: float = 2.0
) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources in code-point order (null last) take ``weights`` in turn.  Together they share
    ``share`` times all sizes; no target passes ``max_repeat`` times its source, and what is
    cut off goes to the others by weight until none is above.  In order of size over weight
    the full sources come first, so one running sum finds the level.  One row per source.
    """
    known = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)
    size = F.col("source_size").cast("double")
    known = known.withColumn("weight", weight).withColumn("cap", size * max_repeat)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum(size).over(every) * share - before) / left
    known = known.withColumn("level", level)
    water = F.max(F.when(F.col("cap") > F.col("weight") * F.col("level"), F.col("level"))).over(every)
    target = F.least("cap", F.coalesce(F.col("weight") * water, F.col("cap")))
    return known.select("source", "source_size", target.alias("target"))


def mix_sources(
    rows: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    max_repeat: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """``doc_id, source, text_hash, size, source_size, target, copies`` for every row of ``sized_rows``.

    ``copies`` is how often the mix takes a document: the complete epochs of its source, plus one
    if the document's middle word lies inside the rest of the budget (so the sum is nearest to the
    target).  Null text or no words: size 0.  A null source is a source.  Equal keys are ordered by
    id and text, so runs agree; repeated rows are drawn one by one.  Quality must be positive.
    No rows give no rows.
    """
    key = -F.log(uniform(seed, F.col("doc_id"))) / F.col("quality")
    sized = staged(rows.withColumn("key", key), "mix-sizes")
    bucket = F.floor(F.col("key") / (F.col("key") + 1) * KEY_BUCKETS).cast("int")
    order = [F.col("key"), F.col("doc_id"), F.col("text_hash")]
    drawn = running_offset(sized, F.col("size"), bucket, order, "before", ["source"])
    targets = source_targets(sized, weights, share, max_repeat).withColumnRenamed("source", "of")
    both = drawn.join(targets, F.col("source").eqNullSafe(F.col("of")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    inside = F.col("before") + F.col("size") / 2.0 <= rest
    return both.withColumn("epochs", epochs).select(
        "doc_id", "source", "text_hash", "size", "source_size", "target",
        (F.col("epochs") + inside.cast("bigint")).alias("copies"),
    )


def mixed_rows(docs: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """The rows of the mix itself: every document as often as it is taken, columns as they were.

    Rows and copies meet by id, source and text hash.  Repeated rows have copies that differ by one
    at most, so their sum is dealt out evenly again.
    """
    taken = mix_sources(sized_rows(docs, quality), **options)
    keys = ["_id", "_source", "_hash"]
    copies = taken.groupBy(*[F.col(c).alias(k) for c, k in zip(("doc_id", "source", "text_hash"), keys, strict=True)])
    copies = copies.agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")).filter("_copies > 0")
    packed = docs.select(
        F.struct("*").alias("doc"), F.col("doc_id").alias("id"), F.col("source").alias("source"),
        F.xxhash64("text").alias("hash"),
    )
    same = F.lit(True)
    for c, k in zip(("id", "source", "hash"), keys, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(k))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    own = F.floor(F.col("_copies") / F.col("_rows")) + (number <= F.col("_copies") % F.col("_rows")).cast("bigint")
    met = packed.join(copies, same).withColumn("_own", own).filter("_own > 0")
    return met.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_own")))).select("doc.*")


MIX_SQL = r"""
WITH marks AS (SELECT doc_id, min(quality) AS mark FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source,
    CAST(coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
        / 4503599627370496.0::DOUBLE)
      / (CASE mark WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END)::DOUBLE AS key
  FROM documents d LEFT JOIN marks m ON d.doc_id = m.doc_id),
known AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) * 2 AS DOUBLE) AS cap,
    CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM known),
targets AS (
  SELECT source, source_size,
    least(cap, coalesce(weight * max(level) FILTER (cap > weight * level) OVER (), cap)) AS target FROM levels),
drawn AS (
  SELECT s.*, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN before + size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END)
    AS BIGINT) AS taken
FROM drawn
"""
