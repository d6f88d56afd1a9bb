"""All stages of the corpus pipeline on a small corpus against plain Python, and on odd and empty tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import md5

import pytest

import corpus_pipeline
from odd_rows import frame, no_docs, no_labels, odd_docs, some_labels, words
from plain_quality import probabilities
from test_decontamination import all_pairs
from test_near_dedup import plain_kept
from test_other import best_capacity, reshared
from test_quality_lm import plain_counts
from tokenloom.llm import quality


def corpus():
    """Clean, poor and toxic documents with copies, near copies and test items; labels; test items."""
    rng = random.Random(8)
    items = [(i, words(rng, 12)) for i in range(4)]
    docs, labels = [], []
    for i in range(90):
        kind = i % 3  # clean, poor, toxic
        own = [f"{'ckt'[kind]}{rng.randrange(40):02d}" if rng.random() < 0.5 else f"w{rng.randrange(400):03d}" for _ in range(60)]
        text = " ".join(own)
        if i % 15 == 0:
            text += " " + items[i // 15 % 4][1]
        docs.append((i, text, "en", f"s{i % 4}", len(text)))
        if i < 66:
            labels.append((i, int(kind != 1), int(kind == 2)))
    for i in range(0, 90, 6):
        near = docs[i][1].split()
        near[30] = "other"
        docs += [(200 + i, docs[i][1], "fr", "s1", 1), (300 + i, " ".join(near), "fr", "s2", 1)]
    docs += [(400, None, "en", "s0", 0), (401, "", "en", None, 0), (402, "too short", "en", "s1", 9), docs[3]]
    return docs, labels, items


def save(spark, folder, docs, labels, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def plain_quality_kept(docs, labels):
    """Rows that stay, and the probabilities of all rows."""
    quality_of, toxic_of = {i: q for i, q, _ in labels}, {i: t for i, _, t in labels}
    texts = [d[1] for d in docs]
    good = probabilities(texts, [(d[0], d[1], quality_of[d[0]]) for d in docs if d[0] in quality_of])
    toxic = probabilities(texts, [(d[0], d[1], toxic_of[d[0]]) for d in docs if d[0] in toxic_of])
    kept = []
    for d, g, t in zip(docs, good, toxic):
        n_words, _, _, _, n_repeat = plain_counts(d[1])
        failed = n_words < 10 or 100 * n_repeat > 20 * n_words
        if not failed and g >= 0.5 and t < 0.5:
            kept.append(d)
    return kept, good, toxic


def plain_mix(docs, marks):
    """Documents as often as the mix takes them."""
    sources, sizes = defaultdict(list), Counter()
    for doc_id, text, _, source, _ in docs:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        u = (int(md5(f"mix:{doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        key = -math.log(u) / {1: 2.0, 0: 0.5, None: 1.0}[marks.get(doc_id)]
        sources[source].append((key, doc_id, size, text))
        sizes[source] += size
    targets, out = reshared(sizes), Counter()
    for source, rows in sources.items():
        epochs = int(targets[source] // sizes[source]) if sizes[source] else 0
        before = 0
        for _, doc_id, size, text in sorted(rows, key=lambda r: r[:2]):
            copies = epochs + (before + size / 2 <= targets[source] - epochs * sizes[source])
            before += size
            if copies:
                out[doc_id, text] += copies
    return out


def test_run_equals_plain_stages(spark, tmp_path):
    docs, labels, items = corpus()
    sf_dir = save(
        spark, tmp_path, frame(spark, docs),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    kept, good, toxic = plain_quality_kept(docs, labels)
    # the operator's grams share buckets now and then, so its probabilities may differ a little
    found = {(r.doc_id, r.row_hash): r for r in quality.judged(frame(spark, docs), spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    at = {d[0]: (g, t) for d, g, t in zip(docs, good, toxic)}
    for (doc_id, _), r in found.items():
        assert r.p_quality == pytest.approx(at[doc_id][0], abs=0.02) and r.p_toxic == pytest.approx(at[doc_id][1], abs=0.02)
    assert {i for (i, _), r in found.items() if r.kept} == {d[0] for d in kept}
    assert 20 < len(kept) < 80

    first = plain_kept(kept)
    single, seen = [], set()
    for d in kept:
        if d[0] in first and d[0] not in seen:
            seen.add(d[0])
            single.append(d)
    leaks = {i for i, _ in all_pairs(single, items)}
    clean = [d for d in single if d[0] not in leaks]
    assert leaks and len(single) < len(kept)
    mixed = plain_mix(clean, {i: q for i, q, _ in labels})

    rows = corpus_pipeline.run(spark, sf_dir).collect()
    wanted = Counter({(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())): n for (i, t), n in mixed.items()})
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == wanted
    load, slots, groups = Counter(), defaultdict(list), Counter()
    for r in rows:
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        groups[r.text_crc32] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = sorted(groups, key=lambda g: min(r.doc_id for r in rows if r.text_crc32 == g))
    assert max(load.values()) == best_capacity([groups[g] for g in order], 16)


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    items = spark.createDataFrame([(0, "none of these words"), (1, None), (2, "")], "item_id bigint, text string")
    sf_dir = save(spark, tmp_path, odd_docs(spark), some_labels(spark), items)
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, docs, sf_dir)
        assert now.columns == docs.columns
        docs = corpus_pipeline.staged(now, "stage")
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in docs.collect())


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert corpus_pipeline.run(spark, save(spark, tmp_path, no_docs(spark), no_labels(spark), none)).count() == 0
