"""Token files against whole texts encoded one by one."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from odd_rows import frame, no_docs, odd_docs, texts
from tokenloom.llm import token_files
from tokenloom.llm.batches import text_chunks
from tokenloom.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
TRICKY = [
    "  two  spaces\n\n\tand tabs \n x", " a", "a ", "\n", " \n ", "it's we'll  don't", "x y 　z\x1cq \x85w", "<|endoftext|> a<|endoftext|>b c",
    "né à la\nmaison", "日本語 の テキスト\nです", "a\r\nb \r\n c", "1 2 33\n4", "... !!\n?? a.b", "\x00 a\x00b", "🙂 🙂\n🙂", "",
]


def plain_ids(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 0]


def plain_rows(rows):
    rows = sorted(((d, plain_ids(t)) for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for d, ids in rows:
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def random_text(rng):
    return "".join(rng.choice("ab  \n\t'.,!1é×日s\u00a0") for _ in range(rng.randrange(60)))


def encoded(encoder, some):
    out = []
    for chunk in text_chunks(pa.array(some), 3000):
        ids, edges = encoder.encode(chunk)
        assert len(edges) == chunk.rows + 1 and edges[-1] == len(ids)
        out += [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return out


def test_segments_give_the_ids_of_whole_texts(monkeypatch):
    rng = random.Random(3)
    some = TRICKY + [random_text(rng) for _ in range(800)] + [t[1] or "" for t in texts()]
    encoder = token_files.Encoder(WHOLE.to_str())
    assert encoder.cuts
    wanted = [plain_ids(t)[:-1] for t in some]
    for known, window, long, group, joined in [(1 << 18, 1 << 20, 1 << 22, 1 << 17, 1000), (50, 37, 40, 5, 3)]:
        for name, value in [("KNOWN", known), ("WINDOW", window), ("LONG_BYTES", long), ("GROUP", group), ("JOINED", joined)]:
            monkeypatch.setattr(token_files, name, value)
        for _ in range(2):
            assert encoded(encoder, some) == wanted


def test_other_tokenizers_get_whole_texts():
    other = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encoder = token_files.Encoder(other.to_str())
    assert not encoder.cuts
    assert encoded(encoder, TRICKY) == [other.encode(t, add_special_tokens=False).ids for t in TRICKY]


@pytest.mark.parametrize("piece", [4096, 7])
def test_files_hold_every_document(spark, monkeypatch, piece):
    monkeypatch.setattr(token_files, "PIECE", piece)
    rows = texts() + [(5000 + i, t, "", "", 1) for i, t in enumerate(TRICKY)] + [(5001, TRICKY[0], "", "", 1)] * 3
    folder = scratch_path(spark, "tokens-test")
    token_files.write_tokens(frame(spark, rows), folder, PATH, files=4)
    found = [tuple(r) for r in token_files.read_digests(spark, folder).collect()]
    assert [f[2:] for f in found if f[0] == 306] == [r[2:] for r in plain_rows([(r[0], r[1]) for r in rows]) if r[0] == 306]
    wanted = plain_rows([(r[0], r[1]) for r in rows])
    key = lambda r: (r[0] is not None, r[0] or 0, r[2:])
    assert [(r[0], *r[2:]) for r in sorted(found, key=key)] == [(r[0], *r[2:]) for r in sorted(wanted, key=key)]
    ordered = sorted(found, key=lambda r: r[1])
    assert [r[1] for r in ordered] == np.cumsum([0, *(r[2] for r in ordered)])[:-1].tolist()
    assert [r[0] is not None and r[0] for r in ordered] == [r[0] is not None and r[0] for r in wanted]
    whole = {d: ids for d, ids in ((r[0], plain_ids(r[1])) for r in texts()) if d in (3, 306)}
    pieces = token_files.read_documents(spark, folder, [3, 306]).orderBy("doc_id", "piece").collect()
    assert {d: [i for p in pieces if p.doc_id == d for i in p.ids] for d in whole} == whole
    stream = [i for r in sorted(token_files.read_documents(spark, folder).collect(), key=lambda r: (r.start, r.piece)) for i in r.ids]
    for start, stop in [(0, 50), (1234, 5678), (len(stream) - 10, len(stream) + 10)]:
        span = token_files.read_span(spark, folder, start, stop).orderBy("at").collect()
        assert [i for r in span for i in r.ids] == stream[start:stop]
        assert not span or span[0].at == start


def test_lookups_prune_by_metadata(spark):
    folder = scratch_path(spark, "tokens-test")
    token_files.write_tokens(odd_docs(spark), folder, PATH, files=3)
    plan = token_files.read_documents(spark, folder, [3, 4])._jdf.queryExecution().executedPlan().toString()
    assert "In(doc_id, [3,4])" in plan
    only = token_files.token_files(spark, folder).filter("doc_id = 305").select(F.sum("n_tokens")).first()[0]
    assert only == len(plain_ids("é" * 700))


def test_no_documents(spark):
    folder = scratch_path(spark, "tokens-test")
    token_files.write_tokens(no_docs(spark), folder, PATH)
    assert token_files.read_digests(spark, folder).count() == 0
    assert token_files.read_span(spark, folder, 0, 10).count() == 0


def test_checksums_join():
    data = [b"abc", b"", b"x" * 1000, b"\0\0"]
    assert token_files.joined_crc32([(zlib.crc32(d), len(d)) for d in data]) == zlib.crc32(b"".join(data))
