"""How far the sources of a language differ in their words, over run-length columns.

Terms are counted per language and source.  The vocabulary of a language is ordered so that terms with the
same counts in all sources stand together (by a hash over the counts), and each source becomes a column of
runs: stretches of the vocabulary with one count.  For two sources the boundaries of their runs are
intersected, and the divergence of a stretch is that of one term times its length.  The order only makes
runs long; sums are exact under any order.

A task holds a stretch of the vocabulary of at most ``BLOCK`` counts and one pair of source tiles; partial
sums are added up by source pair.  Documents, terms and sources are never gathered.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.batches import text_chunks
from tokenloom.llm.storage import staged

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
SCALE = 1_000_000_000
HELD = 1 << 17
HELD_BYTES = 1 << 25
BLOCK = 1 << 18
TILE = 1024


def term_partials(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: counts of each task's terms, and a row with a null term per group."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in groups.items():
                terms = [None, *n]
                columns = [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string())]
                columns.append(pa.array(terms, pa.binary()).cast(pa.string()))
                columns += [pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in n)], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            groups.clear()

        held = held_bytes = 0
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for chunk in text_chunks(batch.column("text")):
                for row, text in enumerate(chunk.texts(), chunk.first):
                    n, docs = groups.setdefault((langs[row], sources[row]), (Counter(), Counter()))
                    own, before = Counter(TERM.findall(text.lower())), len(n)
                    n.update(own)
                    docs.update(own.keys())
                    held += len(n) - before
                held_bytes += len(chunk.data)
                if held > HELD or len(groups) > HELD or held_bytes > HELD_BYTES and held > HELD // 8:
                    yield from flush()
                    held = held_bytes = 0
        yield from flush()

    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(*named, "text").mapInArrow(work, "lang string, source string, term string, n bigint, docs bigint")


def kept_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """``lang, source, term, n, total, likeness`` of the terms that each language keeps, and null-term rows.

    ``total`` counts the term in the language; ``likeness`` is equal for terms of equal counts in all
    sources.  One exchange, by language and term.
    """
    counts = term_partials(docs).repartition("lang", "term").groupBy("lang", "source", "term")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    seen = counts.select(
        "lang", "source", "term", "n",
        F.sum("n").over(same).alias("total"),
        F.sum("docs").over(same).alias("seen"),
        F.bit_xor(F.xxhash64("source", "n")).over(same).alias("likeness"),
    )
    return seen.filter((F.col("seen") >= min_docs) | F.col("term").isNull()).drop("seen")


def group_sizes(kept: DataFrame) -> DataFrame:
    """``lang, source, source_no, n_sources, size, lang_size, terms``: a row for every group of the documents.

    ``size`` and ``lang_size`` sum the kept counts, ``terms`` is how many terms the language keeps.
    """
    sized = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    firsts = kept.filter(F.col("term").isNotNull()).groupBy("lang").agg(F.countDistinct("term").alias("terms"))
    of_lang = Window.partitionBy("lang")
    numbered = sized.select(
        "lang", "source", "size",
        (F.row_number().over(of_lang.orderBy("source")) - 1).alias("source_no"),
        F.count(F.lit(1)).over(of_lang).cast("int").alias("n_sources"),
        F.sum("size").over(of_lang).alias("lang_size"),
    )
    return numbered.join(firsts, "lang", "left").withColumn("terms", F.coalesce("terms", F.lit(0).cast("bigint")))


def share(n: Column, size: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / (size + terms))`` in exact arithmetic."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", above, (size + terms).cast("decimal(20,0)")) + 1


def shares(n: np.ndarray, size: np.ndarray | int, terms: int) -> np.ndarray:
    """``share`` by long division, which does not overflow below 9e17 terms."""
    below = np.asarray(size, dtype=np.int64) + terms
    whole, rest = np.divmod(np.asarray(n, dtype=np.int64) + 1, below)
    for _ in range(9):
        digit, rest = np.divmod(rest * 10, below)
        whole = whole * 10 + digit
    return whole + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def runs(at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and counts of the runs of a column that holds ``n`` at the ascending places ``at`` and else 0."""
    if not len(at):
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    fresh = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(n) != 0)))
    begin, stop = at[fresh], at[np.append(fresh[1:], len(at)) - 1] + 1
    gaps = stop[np.append(begin[1:] != stop[:-1], True)]
    if begin[0] > 0:
        gaps = np.append(gaps, 0)
    starts, counts = np.concatenate([begin, gaps]), np.concatenate([n[fresh], np.zeros(len(gaps), np.int64)])
    order = np.argsort(starts)
    return starts[order], counts[order]


def pair_sums(columns: list[tuple[np.ndarray, np.ndarray]], left: range, right: range, length: int) -> np.ndarray:
    """``sums[i, j]`` and ``sums[j, i]``: divergence of columns ``i`` of ``left`` and ``j`` of ``right`` over ``length`` terms.

    A column is the starts of its runs and the share of each; a run that starts at ``length`` is empty.
    """
    sums = np.zeros((len(columns), len(columns)), dtype=np.int64)
    for i in left:
        for j in right:
            if i < j:
                (a, p), (b, q) = columns[i], columns[j]
                starts = np.union1d(a, b)
                many = np.diff(np.append(starts, length))
                p, q = p[np.searchsorted(a, starts, "right") - 1], q[np.searchsorted(b, starts, "right") - 1]
                sums[i, j], sums[j, i] = gap(p, q) @ many, gap(q, p) @ many
    return sums


def changes(column: pa.Array) -> np.ndarray:
    """Whether a row differs from the one before it; the first does not count."""
    differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
    return np.append(False, differs.to_numpy(zero_copy_only=False).astype(bool))


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value``: numbers of two sources and their divergence, for every two sources of a language.

    The table of groups (numbers only) is at every task: its rows are the square root of the result's.
    """
    spark = kept.sparkSession
    listed: dict[str, list] = {}
    for r in groups.select("lang", "source_no", "size", "terms").orderBy("lang", "source_no").collect():
        listed.setdefault(r["lang"], []).append((r["size"], r["terms"]))
    shared = spark.sparkContext.broadcast({lang: (np.array([s for s, _ in v], np.int64), v[0][1]) for lang, v in listed.items()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums, seen, parts, entries = None, None, 0, [], 0

        def members() -> tuple[np.ndarray, int, int]:
            lang, a, b = key
            n = len(shared.value[lang][0])
            first, second = np.arange(a * TILE, min((a + 1) * TILE, n)), np.arange(b * TILE, min((b + 1) * TILE, n))
            return (first, len(first), len(first)) if a == b else (np.concatenate([first, second]), len(first), 0)

        def add() -> None:
            nonlocal sums, seen, parts, entries
            numbers, inner, start = members()
            sizes, terms = shared.value[key[0]]
            if sums is None:
                sums = np.zeros((len(numbers), len(numbers)), dtype=np.int64)
            if entries:
                term, source, n = (np.concatenate(p) for p in zip(*parts, strict=True))
                length = int(term[-1] - term[0]) + 1
                place = np.searchsorted(numbers, source)
                order = np.lexsort((term, place))
                term, place, n = term[order] - term[0], place[order], n[order]
                cuts = np.searchsorted(place, np.arange(len(numbers) + 1))
                columns = []
                for i, number in enumerate(numbers):
                    starts, counts = runs(term[cuts[i] : cuts[i + 1]], n[cuts[i] : cuts[i + 1]])
                    columns.append((starts[starts < length], shares(counts, sizes[number], terms)[starts < length]))
                sums += pair_sums(columns, range(inner), range(0 if start else inner, len(numbers)), length)
                seen += length
            parts, entries = [], 0

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal sums, seen
            if key is not None:
                add()
                numbers, inner, _ = members()
                i, j = np.nonzero(~np.eye(len(numbers), dtype=bool))
                if key[1] != key[2]:
                    across = (i < inner) != (j < inner)
                    i, j = i[across], j[across]
                columns = [pa.array([key[0]] * len(i), pa.string()), pa.array(numbers[i]), pa.array(numbers[j])]
                columns += [pa.array(sums[i, j]), pa.array(np.full(len(i), seen, np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "value", "seen"])
            sums, seen = None, 0

        ordinal, last = -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            named = [batch.column("lang"), batch.column("tile_a"), batch.column("tile_b"), batch.column("term").fill_null("")]
            moved = np.array([changes(c) for c in named])
            first = tuple(c[0].as_py() for c in named)
            number = np.cumsum(moved.any(axis=0)) + ordinal + (first != last)
            ordinal, last = int(number[-1]), tuple(c[-1].as_py() for c in named)
            edges = [*np.flatnonzero(moved[:3].any(axis=0) | (np.arange(batch.num_rows) == 0)).tolist(), batch.num_rows]
            source, n = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False), dtype=np.int64) for c in ("source_no", "n"))
            real = batch.column("term").is_valid().to_numpy(zero_copy_only=False)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                here = tuple(c[a].as_py() for c in named[:3])
                if here != key:
                    yield from done()
                    key = here
                good = real[a:b]
                if good.any():
                    if entries >= BLOCK and number[a:b][good][0] != parts[-1][0][-1]:
                        add()
                    parts.append((number[a:b][good], source[a:b][good], n[a:b][good]))
                    entries += int(good.sum())
        yield from done()

    fields = "lang string, term string, likeness bigint, source_no int, n bigint, tile_a int, tile_b int"
    other = F.explode(F.sequence(F.lit(0), F.floor((F.col("n_sources") - 1) / TILE).cast("int")))
    own = F.floor(F.col("source_no") / TILE).cast("int")
    rows = kept.join(groups.select("lang", "source", "source_no", "n_sources"), ["lang", "source"]).withColumn("other", other)
    rows = rows.select("*", F.least(own, "other").alias("tile_a"), F.greatest(own, "other").alias("tile_b"))
    rows = rows.select(*(f.split()[0] for f in fields.split(", ")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["lang", "tile_a", "tile_b", "likeness", "term"]
    found = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = found.mapInArrow(work, "lang string, a bigint, b bigint, value bigint, seen bigint")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``: divergence of each source from the others, and its own terms.

    ``docs`` has ``text, lang, source``; nulls count as empty, every row as a document of its own, so repeated
    rows count as often as they stand.  Part ``pair`` has every other source of the language, part ``term``
    the ``top`` terms that the source uses more than its language does.  A term is a run of letters of ASCII
    (lower-cased) or of any characters beyond.  A source without terms has its rows, a language of one source
    no pairs, a language that keeps no term has pairs of value 0, and an empty table gives no rows.
    """
    kept = staged(kept_counts(docs, min_docs), "divergence-counts")
    groups = staged(group_sizes(kept), "divergence-groups")

    own = kept.filter("term IS NOT NULL").join(groups, ["lang", "source"])
    own = own.withColumn("p", share(F.col("n"), F.col("size"), F.col("terms")))
    own = own.withColumn("q", share(F.col("total"), F.col("lang_size"), F.col("terms"))).filter("n > 0 AND p > q")
    own = own.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))

    names = groups.select("lang", "source", "source_no", F.col("size"), "terms")
    pairs = pair_values(kept, groups)
    pairs = pairs.join(names.withColumnRenamed("source_no", "a"), ["lang", "a"])
    others = names.select("lang", F.col("source").alias("item"), F.col("source_no").alias("b"), F.col("size").alias("other_size"))
    pairs = pairs.join(others, ["lang", "b"])
    zero = F.lit(0).cast("bigint")
    nowhere = pairs.filter("terms > 0").withColumn("p", share(zero, F.col("size"), F.col("terms")))
    nowhere = nowhere.withColumn("q", share(zero, F.col("other_size"), F.col("terms")))
    filled = nowhere.select("lang", "source", "item", F.expr("value + (terms - seen) * ((p - q) * (p - q) div q)").alias("value"))
    bare = pairs.filter("terms = 0").select("lang", "source", "item", zero.alias("value"))
    pairs = filled.unionByName(bare).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [d.withColumn("rank", F.row_number().over(best)) for d in (pairs, own.filter("value IS NOT NULL"))]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top))


DIVERGENCE_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
vocab AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN vocab USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(total) AS s FROM vocab GROUP BY lang),
g AS (SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(n), 0) AS s
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN l USING (lang) LEFT JOIN c USING (lang, source) GROUP BY ALL),
dense AS (SELECT g.lang, g.source, vocab.term, coalesce(n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (g.s + g.v) AS p,
    1 + 1000000000::HUGEINT * (total + 1) // (l.s + l.v) AS q
  FROM g JOIN vocab USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = vocab.term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM dense WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
