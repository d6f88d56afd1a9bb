"""Decontamination, sharding, licences, lines, mixing and archives against plain versions."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.fs
import pytest

from odd_rows import frame, no_docs, odd_docs, some_labels, texts, words
from tokenloom.llm import decontamination, licences, line_dedup, mixing, sharding, warc
from tokenloom.session import scratch_path


def plain_alignment(item, text):
    best, row = 0, [0] * (len(text) + 1)
    for a in item:
        now = [0]
        for j, b in enumerate(text, 1):
            now.append(max(0, row[j - 1] + (2 if a == b else -1), row[j] - 1, now[j - 1] - 1))
        best, row = max(best, *now), now
    return best


def test_alignment_rows():
    rng = random.Random(2)
    for _ in range(30):
        item = [rng.randrange(1, 6) for _ in range(rng.randrange(1, 12))]
        text = [rng.randrange(1, 6) for _ in range(rng.randrange(1, 30))]
        found = decontamination.local_scores(np.array(item, np.uint64), np.array([text, text], np.uint64))
        assert found.tolist() == [plain_alignment(item, text)] * 2


def test_contaminated_pairs_equal_all_alignments(spark):
    rng = random.Random(9)
    items = [(i, words(rng, 25)) for i in range(8)] + [(8, None), (9, ""), (10, "two words"), (3, words(rng, 20))]
    rows = texts()
    for i, (_, item) in enumerate(items[:8]):
        w = item.split()
        edited = [x if k % 7 else "edit" for k, x in enumerate(w)]
        rows.append((500 + i, f"{words(rng, 30)} {' '.join(edited)} {words(rng, 30)}", "", "", 1))
        rows.append((520 + i, f"{words(rng, 300)} {' '.join(w[:10])}", "", "", 1))
        rows.append((540 + i, " ".join([item.upper()] * 40), "", "", 1))
    table = spark.createDataFrame([*items, items[0]], "item_id bigint, text string")
    found = Counter((r.doc_id, r.item_id, round(r.score, 9)) for r in decontamination.contaminated_pairs(frame(spark, rows), table).collect())
    wanted = Counter()
    for row in rows:
        text = (row[1] or "").lower().split()
        for i, item in items:
            item = (item or "").lower().split()
            if len(item) >= 3 and len(text) < 2000:
                score = plain_alignment(item, text) / (2 * len(item))
                if score >= 0.5:
                    wanted[row[0], i, round(score, 9)] += 1
    assert found == wanted and len(wanted) >= 16
    kept = decontamination.keep_clean(frame(spark, rows), table)
    bad = {k[0] for k in wanted}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows if r[0] not in bad)


def test_nothing_to_align(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.contaminated_pairs(odd_docs(spark), none).count() == 0
    assert decontamination.contaminated_pairs(no_docs(spark), none).count() == 0
    assert decontamination.keep_clean(odd_docs(spark), none).count() == len(texts())


def best_capacity(sizes, shards):
    def needed(capacity):
        used, room = 1, capacity
        for s in sizes:
            if s > capacity:
                return shards + 1
            if s > room:
                used, room = used + 1, capacity
            room -= s
        return used

    low, high = 0, sum(sizes)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if needed(middle) <= shards else (middle, high)
    return high


@pytest.mark.parametrize("held", [100_000, 0])
def test_shards(spark, monkeypatch, held):
    monkeypatch.setattr(sharding, "HELD_BORDERS", held)
    monkeypatch.setattr(sharding, "PARALLEL_CHECKS", 400)
    rows = [r for r in texts() if r[0] is not None]
    found = sharding.contract(sharding.shard_by_bytes(frame(spark, rows), 5)).collect()
    assert len(found) == len(rows)
    text = {r[0]: r[1] for r in rows}
    load, slots, shard_of, groups = Counter(), defaultdict(list), {}, {}
    for r in found:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert shard_of.setdefault(text[r.doc_id], r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for d, t, *_ in sorted(rows, key=lambda r: r[0]):
        groups[t] = groups.get(t, 0) + len((t or "").encode()) + 1
    assert max(load.values()) == best_capacity(list(groups.values()), 5)


def test_shards_of_one_giant_group_and_of_nothing(spark):
    rows = [(i, "same text of many rows", "", "", 1) for i in range(50)] + [(100 + i, words(random.Random(i), 9), "", "", 1) for i in range(60)]
    found = sharding.shard_by_bytes(frame(spark, rows), 8).collect()
    load = Counter()
    for r in found:
        load[r.shard] += r.size
    assert max(load.values()) == 50 * 23 and len(load) == 8
    assert sharding.shard_by_bytes(no_docs(spark)).count() == 0
    assert sharding.shard_by_bytes(odd_docs(spark)).count() == len(texts())


def test_licences(spark):
    bsd = licences.LICENCES[13][1]
    rows = [
        (1, "prose\nLicensed under the Apache License, Version 2.0.\nmore", "", "", 1),
        (2, "RELEASED  under the MIT license!", "", "", 1),
        (3, f"intro\n\n{bsd[:60]}\n{bsd[60:]}\n\nend", "", "", 1),
        (4, "Licensed under nothing at all, and this line goes on and on without an end.", "", "", 1),
        (2, "RELEASED  under the MIT license!", "", "", 1),
        *texts(),
    ]
    found = Counter((r.doc_id, r.unit, r.licence) for r in licences.scan_licences(frame(spark, rows)).collect())
    assert found[1, 1, "Apache-2.0"] == 1 and found[2, 0, "MIT"] >= 2
    assert any(k[0] == 3 and k[2] == "BSD-3-Clause" for k in found)
    assert {k[0] for k in found} == {1, 2, 3}
    assert licences.scan_licences(no_docs(spark)).count() == 0


def plain_lines(rows):
    places = []
    for doc, text in rows:
        at = [i for i, x in enumerate((text or "").split("\n")) if x.strip(" ")] if text is not None else []
        places += [(doc, three, tuple(text.split("\n")[i] for i in three)) for three in zip(at, at[1:], at[2:])]
    seen, gone = set(), defaultdict(set)
    for doc, three, key in sorted(places, key=lambda p: (p[0] is not None, p[0] or 0, p[1])):
        if key in seen:
            gone[doc].update(three)
        seen.add(key)
    return gone


def test_lines(spark):
    rows = [
        (1, "a\nb\nc\nd"), (2, "x\na\nb\n\n  \nc\ny"), (3, "a\nb\nc\nd"), (4, "q\nq\nq\nq\nq"), (5, "a\nb"), (6, None), (7, ""), (8, "b\nc\nd\ne\n"),
        (None, "b\nc\nd"),
    ]
    found = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, [(*r, "", "", 1) for r in rows])).collect()}
    gone = plain_lines(rows)
    for doc, text in rows:
        lines = [] if text is None else text.split("\n")
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone[doc])
        assert (found[doc].n_lines, found[doc].n_removed, found[doc].kept_text) == (len(lines), len(gone[doc]), kept)
    assert line_dedup.dedup_lines(no_docs(spark)).count() == 0
    assert line_dedup.dedup_lines(odd_docs(spark)).count() == len(texts())


def reshared(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by cutting at the limit and resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full, left = {}, set(), share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        budget = left - sum(most * sizes[s] for s in full)
        target = {s: budget * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return {**target, **{s: most * sizes[s] for s in full}}
        full |= above


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, rng.choice([0, 3, 20, 60])), "en", rng.choice(["a", "b", "c", "d", "e", None, "é"]), 1) for i in range(600)]
    rows += [(9000, None, "", "a", 1), rows[5], rows[5]]
    docs = frame(spark, rows)
    found = mixing.mix_sources(mixing.sized_rows(docs, mixing.label_quality(some_labels(spark)))).collect()
    assert len(found) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in found:
        assert 0 <= r.copies <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
    wanted = reshared(sizes)
    for s in sizes:
        assert abs(target[s] - wanted[s]) < 1e-6 * wanted[s] and abs(taken[s] - target[s]) <= 31
    again = mixing.mix_sources(mixing.sized_rows(docs.repartition(3), mixing.label_quality(some_labels(spark))))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, found))
    mixed = mixing.mixed_rows(docs, mixing.label_quality(some_labels(spark)))
    assert mixed.columns == docs.columns
    copies = Counter()
    for r in found:
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +copies


def test_good_documents_come_first(spark):
    rows = [(i, "w " * 10, "", "s", 1) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "doc_id bigint, quality int, toxic int")
    sized = mixing.sized_rows(frame(spark, rows), mixing.label_quality(labels))
    found = mixing.mix_sources(sized, share=0.5).filter("copies > 0").collect()
    assert sum(r.doc_id % 2 for r in found) > 0.65 * len(found)
    assert mixing.mix_sources(mixing.sized_rows(no_docs(spark))).count() == 0
    assert mixing.mixed_rows(odd_docs(spark)).columns == odd_docs(spark).columns


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, digest string, salt int")


def test_archives_round_trip(spark):
    rng = random.Random(1)
    rows = [(i, f"http://x.example/ä {i}?q=1", words(rng, rng.randrange(1, 300))) for i in range(60)]
    rows += [(100 + i, None, rows[3][2]) for i in range(20)] + [(200, "u\r\nX: 1", None), (201, "", ""), (202, "v", "é\r\n\r\n" * 5), (203, "w", "x" * 300_000)]
    rows += [(None, "n", rows[3][2]), (None, "n", "alone"), (5, rows[5][1], rows[5][2])]
    folder = scratch_path(spark, "archives")
    manifest = warc.write_archives(pages(spark, rows), folder, archive_bytes=20_000)
    assert sum(r.records for r in manifest.collect()) == len(rows) and manifest.count() > 2
    found = warc.read_archives(manifest, folder).collect()
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    wanted = Counter()
    for i, url, html in rows:
        raw, least = (html or "").encode(), first.get(html or "")
        again = least is not None and i != least
        kind = ("revisit", least, None) if again else ("response", None, raw)
        wanted[i, url, kind[0], kind[1], len(raw), warc.base32_sha1(raw), kind[2]] += 1
    assert Counter(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in found) == wanted
    store, root = pyarrow.fs.FileSystem.from_uri(folder)
    for info in store.get_file_info(pyarrow.fs.FileSelector(root)):
        with store.open_input_stream(info.path, compression=None) as stream:
            assert stream.read(4) == warc.DICTIONARY_FRAME.to_bytes(4, "little")


def test_small_payloads_are_all_responses_and_no_pages(spark):
    folder = scratch_path(spark, "archives")
    manifest = warc.write_archives(pages(spark, [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "xxxx"), (4, "d", "xxxx")]), folder, min_bytes=3)
    found = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_archives(manifest, folder).collect()}
    assert found == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}
    empty = scratch_path(spark, "archives")
    assert warc.read_archives(warc.write_archives(pages(spark, []), empty), empty).count() == 0
