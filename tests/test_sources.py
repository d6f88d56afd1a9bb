"""Lines by number, stride and byte place, resumable streams and files with planned names."""

import json
import random
import tracemalloc
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.plans import corpus, streams
from tokenloom.sources import jsonl, named_files
from tokenloom.streaming import jobs


def some_lines(seed, n):
    rng = random.Random(seed)
    return [json.dumps({"id": i, "text": rng.choice(["é", "a b", "\r", "日本", ""]) * rng.randrange(40)}, ensure_ascii=False) for i in range(n)]


def write(path: Path, lines, last="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + (last if lines else ""), encoding="utf-8", newline="")


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lines_are_numbered_over_splits_and_files(spark, tmp_path, small_splits):
    shards = {"a/0.jsonl": some_lines(1, 60), "a/1.jsonl": some_lines(2, 45), "b/0.jsonl": some_lines(3, 3), "b/1.jsonl": []}
    for name, lines in shards.items():
        write(tmp_path / name, lines, "" if name == "a/1.jsonl" else "\n")
    found = jsonl.numbered_lines(spark, str(tmp_path), pattern="*.jsonl")
    assert found.select("file").distinct().count() == 3
    rows = sorted((r.shard[-1], r.line_no, r.value) for r in found.collect())
    wanted = [("a", i, v) for i, v in enumerate(shards["a/0.jsonl"] + shards["a/1.jsonl"])]
    assert rows == wanted + [("b", i, v) for i, v in enumerate(shards["b/0.jsonl"])]
    raw = (tmp_path / "a/0.jsonl").read_bytes()
    for r in found.filter(F.col("file").endswith("a/0.jsonl")).collect():
        assert raw[: r.position].endswith(r.value.encode() + b"\n")


def test_readers_take_lines_by_stride(spark, tmp_path):
    write(tmp_path / "x.jsonl", some_lines(4, 20))
    lines = jsonl.numbered_lines(spark, str(tmp_path))
    ids = lambda df: [r.id for r in jsonl.parsed(df, "id bigint").orderBy("id").collect()]
    assert ids(jsonl.strided(lines, 4, 3)) == [3, 7, 11, 15, 19]
    assert sorted(sum((ids(jsonl.strided(lines, 3, k)) for k in range(3)), [])) == list(range(20))
    for bad in (-1, 4):
        with pytest.raises(ValueError):
            jsonl.strided(lines, 4, bad)
    with pytest.raises(ValueError):
        jsonl.strided(lines, 0)


def test_validation_files_by_source(spark, tmp_path):
    write(tmp_path / "wiki/0.val.jsonl", some_lines(5, 7))
    write(tmp_path / "wiki/1.val.jsonl", some_lines(6, 7))
    write(tmp_path / "code/0.val.jsonl", some_lines(7, 2))
    write(tmp_path / "code/0.jsonl", some_lines(8, 50))
    rows = jsonl.validation_lines(spark, str(tmp_path), 9).collect()
    assert sorted((r.source, r.step) for r in rows) == [("code", i) for i in range(2)] + [("wiki", i) for i in range(9)]
    assert jsonl.validation_lines(spark, str(tmp_path), None).count() == 16


@pytest.mark.parametrize("piece", [64, 1 << 20])
@pytest.mark.parametrize("range_bytes", [1, 37, 500, 1 << 20])
def test_byte_ranges_give_every_line_once(tmp_path, monkeypatch, range_bytes, piece):
    monkeypatch.setattr(jsonl, "PIECE", piece)
    files = {"a.json": some_lines(9, 30), "b.json": [""] * 5 + some_lines(10, 12)}
    for name, lines in files.items():
        write(tmp_path / name, lines)
    reader = jsonl.LineStreamReader({"path": str(tmp_path), "rangebytes": str(range_bytes), "epochs": "2"})
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    got = [(e, Path(f).name, v) for p in parts for b in reader.read(p) for v, f, _, e in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert got == [(e, name, v) for e in range(2) for name in files for v in files[name]]


def test_a_stream_goes_on_behind_its_last_line(spark, tmp_path):
    first, more = some_lines(11, 40), some_lines(12, 10)
    write(tmp_path / "in/a.json", first)
    half = sum(len(v.encode()) + 1 for v in first[:23]) + 5  # inside line 23
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run(**options):
        jobs.append_to(jsonl.stream_lines(spark, str(tmp_path / "in"), rangeBytes=200, **options), out, state)
        return [r.value for r in spark.read.parquet(out).orderBy("file", "position").collect()]

    assert run(untilBytes=half) == first[:23]
    assert run() == first
    with open(tmp_path / "in/a.json", "a", encoding="utf-8", newline="") as f:
        f.write("\n".join(more) + "\nno end yet")
    assert run() == first + more
    write(tmp_path / "in/b.json", ["last"])
    assert run()[-1] == "last"


def test_files_are_written_as_planned(spark, tmp_path):
    rows = [(f"d{i % 3}/part-{i % 7}.txt", f"é{i}", i) for i in range(300)]
    folder = tmp_path / "out"
    named_files.write_named(spark.createDataFrame(rows, "file string, value string, at int"), str(folder), ["at"])
    wanted = {}
    for file, value, _ in rows:
        wanted.setdefault(file, []).append(value)
    found = {str(p.relative_to(folder)): p.read_text(encoding="utf-8").split("\n")[:-1] for p in folder.rglob("*") if p.is_file()}
    assert found == wanted
    assert not (folder / named_files.HIDDEN).exists()


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    rows = spark.range(100).selectExpr("concat('f', id % 5) AS file", "if(id = 99, raise_error('stop'), cast(id as string)) AS value", "id AS at")
    with pytest.raises(Exception, match="stop"):
        named_files.write_named(rows, str(tmp_path / "out"), ["at"])
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_a_file_in_two_places_is_an_error(spark, tmp_path):
    writer = named_files.NamedFilesWriter({"path": str(tmp_path / "out")})
    messages = [named_files.WrittenFiles([("a", "x", 1)]), named_files.WrittenFiles([("a", "y", 1)])]
    with pytest.raises(ValueError):
        writer.commit(messages)


@pytest.mark.parametrize("module, query, lines_in", [(streams, "stream_jsonl_resumable", "run/in"), (corpus, "scan_auto_format", "run")])
def test_lines_are_written_by_a_task_for_each_split(spark, tmp_path, monkeypatch, small_splits, module, query, lines_in):
    table = spark.range(240).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(12)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(module, "scratch_path", lambda spark, name: str(tmp_path / "run"))
    rows = getattr(module, query)(spark, str(tmp_path)).collect()
    assert sorted(r.text for r in rows) == sorted(f"text {i}" for i in range(240))
    assert len(list((tmp_path / lines_in).glob("part-*.json"))) == 12


def test_only_what_is_wanted_of_a_line_goes_through_python(spark, tmp_path, monkeypatch, small_splits):
    plain = jsonl._numbered_in_split

    def checked(batches):
        for batch in plain(batches):
            if batch.schema.field("value").type != "int64":
                raise TypeError(f"{batch.schema.field('value').type} instead of an id")
            yield batch

    table = spark.range(90).selectExpr("id AS doc_id", "repeat('é', cast(id as int)) AS text", "concat('s', id % 2) AS source", "'en' AS lang")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(jsonl, "_numbered_in_split", checked)
    for query in (corpus.scan_validation_shards, corpus.sink_round_robin_chunks, corpus.scan_jsonl_strided, corpus.sink_first_n_docs):
        assert query(spark, str(tmp_path)).filter("doc_id IS NOT NULL").count() in (60, 90)
    assert sum(r.n_records for r in corpus.sink_text_shards(spark, str(tmp_path)).collect()) == 90
    rows = corpus.scan_validation_shards(spark, str(tmp_path)).collect()
    assert sorted((r.source, r.step, r.doc_id) for r in rows) == [(f"s{k}", i, 2 * i + k) for k in range(2) for i in range(30)]


def test_a_batch_is_written_in_bounded_pieces(tmp_path):
    values = [None, "é" * (3 << 20), "", *(f"{i}-" + "x" * 65_000 for i in range(400))]
    names = ["a/0", "a/0", *["a/1"] * 300, *["b"] * 101]
    batch = pa.RecordBatch.from_arrays([pa.array(names), pa.array(values)], names=["file", "value"])
    writer = named_files.NamedFilesWriter({"path": str(tmp_path)})
    tracemalloc.start()
    try:
        done = writer.write(iter([batch.slice(0, 7), batch.slice(7)]))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [(f[0], f[2]) for f in done.files] == [("a/0", 2), ("a/1", 300), ("b", 101)]
    for name, place, _ in done.files:
        wanted = [v or "" for n, v in zip(names, values, strict=True) if n == name]
        assert Path(place).read_bytes().decode().split("\n") == [*wanted, ""]
    assert most < 24 << 20  # the longest record has 6 MB, all of them 32
