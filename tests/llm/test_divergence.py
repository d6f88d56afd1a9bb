"""The source audit against plain sums over all terms of all pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from odd_rows import frame, no_docs, texts
from tokenloom.llm import divergence

SCALE = 10**9


def plain_audit(rows, min_docs=3, top=200):
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        raw = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", raw)
        counts[lang, source].update(found)
        seen[lang].update(set(found))
    out = set()
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in seen[lang].items() if n >= min_docs]
        groups = {s: {t: c[t] for t in kept} for (g, s), c in counts.items() if g == lang}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}
        p = lambda c: {t: 1 + SCALE * (n + 1) // (sum(c.values()) + len(kept)) for t, n in c.items()}
        shares, q = {s: p(c) for s, c in groups.items()}, p(whole)
        f = lambda a, b: (a - b) * (a - b) // b
        for s, own in shares.items():
            pairs = [(sum(f(own[t], o[t]) for t in kept), x) for x, o in shares.items() if x != s]
            terms = [(f(own[t], q[t]), t) for t in kept if groups[s][t] and own[t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda r: (-r[0], r[1].encode()))[:limit]
                out |= {(lang, s, part, item, v, i) for i, (v, item) in enumerate(ranked, 1)}
    return out


def some_rows():
    rng = random.Random(8)
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in texts()]
    rows += [(900 + i, " ".join(rng.choice(["Été", "a-b", "x1y", "ẞ", "İ", "w001", "Zz"]) for _ in range(9)), "en", f"s{i % 7}", 1) for i in range(40)]
    rows += [(1000 + i, "only here", "de", f"s{i}", 1) for i in range(2)]  # nothing in three documents
    rows += [(1010 + i, "one source", "it", "s0", 1) for i in range(4)]
    return rows


@pytest.mark.parametrize("tile, block, held", [(1024, 1 << 18, 1 << 17), (2, 40, 30)])
def test_audit_equals_plain_sums(spark, monkeypatch, tile, block, held):
    for name, value in (("TILE", tile), ("BLOCK", block), ("HELD", held)):
        monkeypatch.setattr(divergence, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50" if tile == 2 else "10000")
    rows = some_rows()
    found = divergence.audit(frame(spark, rows), top=20).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    got = [(r["lang"], r.source, r.part, r.item, r.value, r["rank"]) for r in found]
    wanted = plain_audit([r[1:4] for r in rows], top=20)
    assert len(got) == len(wanted)
    assert set(got) == wanted


def test_no_documents(spark):
    assert divergence.audit(no_docs(spark)).count() == 0


def test_shares_are_exact():
    for n, size, terms in [(0, 0, 1), (10**12, 10**13, 7), (3 * 10**16, 3 * 10**16, 10**5), (9, 9, 1)]:
        assert divergence.shares(np.array([n]), size, terms)[0] == 1 + SCALE * (n + 1) // (size + terms)


def test_runs():
    for column in ([0, 0, 3, 3, 1, 0], [2, 2], [0], [1, 0, 1, 0, 0], [0, 0, 5]):
        at = np.flatnonzero(column)
        starts, counts = divergence.runs(at, np.array(column)[at])
        rebuilt = np.zeros(len(column) + 1, dtype=np.int64)
        for s, c in zip(starts, counts, strict=True):
            rebuilt[s:] = c
        assert rebuilt[:-1].tolist() == column
