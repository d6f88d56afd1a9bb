"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""

from __future__ import annotations

import random

CLASHES = (
    "size bigint, key string, row_key bigint, component_id bigint, _bucket int, _value int, _row int, doc string, "
    "fp bigint, n bigint, start bigint, spans string, quality int, copies int, shard int"
)
DOCS = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHES}"
FILL = (9, "x", 9, 9, 9, 9, 9, "x", 9, 9, 9, "x", 9, 9, 9)


def words(rng: random.Random, n: int, kinds: int = 400) -> str:
    return " ".join(f"w{rng.randrange(kinds):03d}" for _ in range(n))


def texts(seed: int = 5) -> list[tuple]:
    """Rows of ``doc_id, text, lang, source, n_chars``."""
    rng = random.Random(seed)
    base = [words(rng, rng.choice([12, 40, 90])) for _ in range(30)]
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(base)]
    rows += [(100 + i, t, "en", None, None) for i, t in enumerate(base[:4])]  # exact copies, null source
    rows += [(200 + i, t.replace(t.split()[5], "other", 1), None, "s1", 1) for i, t in enumerate(base[:4])]
    rows += [(300, None, "en", "s0", None), (301, "", "fr", "s0", 0), (302, " \t\n", "fr", "s2", 3), (303, "one", "en", "s2", 3)]
    rows += [(304, "deux mots\n\n\n", "fr", "s3", 9), (305, "é" * 700, "fr", "s3", 700), (306, words(rng, 6000), "en", "s0", 1)]
    rows += [(None, base[2], "en", "s0", 1), (None, None, None, None, None), (7, base[7], "en", "s3", len(base[7]))]
    rows += [(307, f"{base[8]}\n{base[9]}\n{base[10]}", "en", "s1", 1), (308, f"{base[8]}\n{base[9]}\n{base[10]}\nend", "en", "s1", 1)]
    return rows


def frame(spark, rows: list[tuple]):
    """The rows with extra columns whose names clash with those that operators use inside."""
    return spark.createDataFrame([(*r, *FILL) for r in rows], DOCS)


def odd_docs(spark):
    return frame(spark, texts())


def no_docs(spark):
    return frame(spark, [])


def some_labels(spark):
    rows = [(i, int(i % 5 != 0), int(i % 7 == 0)) for i in range(30)]
    return spark.createDataFrame([*rows, (3, 0, 0), (4, None, 1), (5, 1, None), (None, 1, 0)], "doc_id bigint, quality int, toxic int")


def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
