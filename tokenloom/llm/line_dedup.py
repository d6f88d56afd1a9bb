"""Removal of repeated passages by overlapping windows of three lines.

Lines that are empty or only spaces do not count.  Every three consecutive other lines are a window, known
by two 64-bit hashes.  A window that stands anywhere before (in order of id, then place) is a later
occurrence, and the lines of all later occurrences go.  Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.storage import staged

WINDOW = 3


def _numbered(text: Column) -> Column:
    """``at, line`` of every line that is not blank."""
    lines = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("at"), line.alias("line")))
    return F.filter(lines, lambda x: F.trim(x["line"]) != "")


def line_windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``row_key, doc_id, one, two, lines``: the hashes and line numbers of every window."""
    hashed = F.transform(
        "full", lambda x: F.struct(x["at"].alias("at"), F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit("#"), x["line"]).alias("b"))
    )
    rows = docs.withColumn("full", _numbered(F.col("text"))).filter(F.size("full") >= width)
    rows = rows.select("row_key", "doc_id", hashed.alias("h"))
    starts = F.sequence(F.lit(1), F.size("h") - (width - 1))
    rows = rows.withColumn("w", F.explode(F.transform(starts, lambda i: F.slice("h", i, F.lit(width)))))
    return rows.select(
        "row_key", "doc_id",
        F.xxhash64("w.a").alias("one"), F.xxhash64("w.b").alias("two"), F.col("w.at").alias("lines"),
    )


def later_lines(windows: DataFrame) -> DataFrame:
    """``row_key, gone``: the numbers of the lines that later occurrences cover, per row that has some."""
    place = F.struct("doc_id", "row_key", F.get("lines", F.lit(0)).alias("at"))
    firsts = windows.groupBy(F.col("one").alias("_one"), F.col("two").alias("_two"))
    firsts = firsts.agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    met = windows.join(firsts, (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two")))
    later = met.filter(~place.eqNullSafe(F.col("_first")))
    return later.groupBy("row_key").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("gone"))


def dedup_lines(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_text`` of every row of ``docs`` (``doc_id``, ``text``).

    Lines end at line feeds.  Texts of fewer than ``width`` lines with content lose nothing.  Null text has no
    lines and keeps null.  Rows that repeat id and text are one place: they lose the same lines.  A null id
    comes first in the order.  No rows give no rows.
    """
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), "doc_id", "text")
    windows = staged(line_windows(rows, width).distinct(), "line-windows")
    gone = later_lines(windows).withColumnRenamed("row_key", "_key")
    met = rows.join(gone, F.col("row_key") == F.col("_key"), "left")
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    return met.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        kept.alias("kept_text"),
    )


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents),
content AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM lines WHERE trim(line) <> ''),
windows AS (
  SELECT a.doc_id, a.k, a.pos, b.pos AS pos2, c.pos AS pos3, a.line || chr(10) || b.line || chr(10) || c.line AS w
  FROM content a JOIN content b ON a.doc_id = b.doc_id AND b.k = a.k + 1
    JOIN content c ON a.doc_id = c.doc_id AND c.k = a.k + 2),
placed AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS turn FROM windows),
gone AS (
  SELECT DISTINCT doc_id, unnest([pos, pos2, pos3]) AS pos FROM placed WHERE turn > 1)
SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
  md5(coalesce(string_agg(CASE WHEN g.pos IS NULL THEN line END, chr(10) ORDER BY l.pos), '')) AS kept_md5
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
GROUP BY l.doc_id
"""
