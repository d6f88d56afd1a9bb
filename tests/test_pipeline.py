"""Mixtures, readers, writers, streaming and settings."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tokenloom import session
from tokenloom.functions import text as tx
from tokenloom.functions.hashing import md5_uniform
from tokenloom.operators import batching as bt
from tokenloom.operators import corpus as cp
from tokenloom.operators import evaluation as ev
from tokenloom.operators import mixture as mx
from tokenloom.operators import runs as rn
from tokenloom.sources import readers, writers
from tokenloom.streaming import jobs


def test_mixture_repeats_small_sources_in_order(spark, monkeypatch):
    monkeypatch.setattr(mx, "EPOCHS_PER_SALT", 2)
    docs = spark.createDataFrame([(i, "big" if i < 40 else "tiny") for i in range(43)], "doc long, src string")
    draws = spark.range(600).withColumnRenamed("id", "draw")
    rows = mx.mixture_draws(docs, "doc", "src", draws, "draw", {"big": 1.0, "tiny": 3.0}, 1).orderBy("draw").collect()
    assert len(rows) == 600
    seen = Counter()
    members = {"big": list(range(40)), "tiny": [40, 41, 42]}
    for r in rows:
        n = seen[r["source"]]
        pool = members[r["source"]]
        assert (r["doc"], r["epoch"]) == (pool[n % len(pool)], n // len(pool))
        seen[r["source"]] += 1
    assert 0.68 < seen["tiny"] / 600 < 0.82


def test_weights_need_not_add_up_to_one(spark):
    draws = spark.range(200)
    one = draws.select(mx.choose_source({"a": 1.0, "b": 1.0}, 3, F.col("id")).alias("s")).collect()
    hundred = draws.select(mx.choose_source({"a": 100.0, "b": 100.0}, 3, F.col("id")).alias("s")).collect()
    assert one == hundred
    with pytest.raises(ValueError):
        mx.choose_source({}, 1, F.col("id"))


def test_shard_assignment_errors(spark):
    chunks = spark.createDataFrame([(f"c{i}",) for i in range(4)], "path string")
    with pytest.raises(ValueError, match="no chunks"):
        mx.assign_shards(chunks.filter("false"), "path", 4)
    with pytest.raises(ValueError, match="multiple"):
        mx.assign_shards(chunks, "path", 6)
    rows = mx.assign_shards(chunks, "path", 8).orderBy("rank").collect()
    assert [(r["path"], r["offset"]) for r in rows] == [(f"c{i // 2}", i % 2) for i in range(8)]


def test_missing_sources_raise(spark):
    have = spark.createDataFrame([("a",)], "source string")
    want = spark.createDataFrame([("a",), ("b",)], "source string")
    with pytest.raises(ValueError, match="b"):
        cp.assert_sources_exist(want, have)
    cp.assert_sources_exist(have, want)


def test_text_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, "en" if i < 25 else "fr", f"t{i}") for i in range(30)], "id long, lang string, text string")
    writers.write_text_shards(df.coalesce(1), str(tmp_path / "out"), chunk_size=10)
    sizes = {"en": [], "fr": []}
    for f in (tmp_path / "out").rglob("*.txt"):
        sizes[f.parent.name.split("=")[1]].append(len(f.read_text().splitlines()))
    assert sorted(sizes["en"]) == [5, 10, 10] and sizes["fr"] == [5]


def test_auto_reader(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "text string")
    df.write.parquet(str(tmp_path / "p"))
    df.write.json(str(tmp_path / "j"))
    df.write.csv(str(tmp_path / "c"))
    assert readers.read_auto(spark, str(tmp_path / "p")).first()["text"] == "a"
    assert readers.read_auto(spark, str(tmp_path / "j")).first()["text"] == "a"
    with pytest.raises(NotImplementedError):
        readers.read_auto(spark, str(tmp_path / "c"))
    with pytest.raises(ValueError, match="mixed"):
        readers.read_auto(spark, str(tmp_path))


def test_text_glob_without_match(spark, tmp_path):
    (tmp_path / "a.md").write_text("x")
    with pytest.raises(ValueError, match="no training files"):
        readers.read_text_glob(spark, str(tmp_path), "*.txt")


def test_csv_pairs_keep_line_breaks_quotes_and_nulls(spark, tmp_path):
    rows = [('say "hi"\nthere', "b"), (None, "c"), ("d", None)]
    df = spark.createDataFrame(rows, "en string, fr string")
    df.write.option("header", True).option("escape", '"').csv(str(tmp_path / "pairs"))
    assert {tuple(r) for r in readers.read_csv_pairs(spark, str(tmp_path / "pairs")).collect()} == set(rows)


def test_slice_is_written_once(spark, tmp_path):
    cache = str(tmp_path)
    first = readers.slice_cached(spark.range(10), "id", cache, "d", 2, 5)
    assert sorted(r["id"] for r in first.collect()) == [2, 3, 4]
    other = spark.range(100, 110)
    assert readers.slice_cached(other, "id", cache, "d", 2, 5).count() == 3
    assert readers.slice_cached(other, "id", cache, "d", 2, 5).agg(F.min("id")).first()[0] == 2
    assert readers.slice_cached(other, "id", cache, "d", 2, 5, force_reload=True).agg(F.min("id")).first()[0] == 102


def test_collate_needs_a_function(spark):
    with pytest.raises(ValueError):
        bt.collate(spark.range(1), "id", None, "id long")


def test_snapshots(spark):
    rows = [(f"checkpoint_{i:010d}", i < 3) for i in range(5)] + [("eval_0000000009", True), ("notes", True)]
    df = spark.createDataFrame(rows, "path string, has_state boolean")
    folders = df.filter("path != 'notes'")
    assert rn.latest_with_state(folders).first()["path"] == "eval_0000000009"
    kept = {r["path"] for r in rn.retained(df, {"checkpoint": 2, "eval": 0}).collect()}
    assert kept == {"checkpoint_0000000003", "checkpoint_0000000004", "eval_0000000009", "notes"}


def test_gate(spark):
    df = spark.createDataFrame([(s, a) for s in range(4) for a in range(4)], "s int, a int")
    assert df.filter(bt.every_n_steps(F.col("s"), 2, F.col("a"))).count() == 8
    assert df.filter(bt.every_n_steps(F.col("s"), 2, F.col("a"), at=1)).count() == 2
    assert df.filter(bt.every_n_steps(F.col("s"), 2, F.col("a"), acc_freq=2)).count() == 4


def test_uniform_is_uniform(spark):
    u = [r[0] for r in spark.range(4000).select(md5_uniform(1, F.col("id"))).collect()]
    assert min(u) >= 0 and max(u) < 1 and abs(sum(u) / 4000 - 0.5) < 0.02


def test_block_shuffle_stream_keeps_blocks(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(50).select(F.lit(0).alias("shard"), F.col("id").alias("idx"), (F.col("id") * 7).alias("v")).repartition(
        3
    ).write.parquet(src)
    stream = jobs.stream_table(spark, src, "*.parquet", 1)
    mixed = jobs.block_shuffle_stream(stream, "idx", "v", 4, 2, 5, "shard")
    jobs.append_to(mixed, str(tmp_path / "out"), str(tmp_path / "cp"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 48
    assert all(r["payload"] == 7 * r["idx"] and r["idx"] // 8 == r["batch"] // 2 for r in rows)
    assert Counter(r["batch"] for r in rows) == {b: 4 for b in range(12)}


@pytest.mark.parametrize("end_first", [False, True])
def test_block_shuffle_stream_ends_like_its_batch_twin(spark, tmp_path, end_first):
    src = str(tmp_path / "in")
    rows = spark.range(106).select((F.col("id") % 2).cast("int").alias("shard"), F.floor(F.col("id") / 2).alias("idx"), (F.col("id") * 7).alias("v"))
    ends = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("idx")).withColumn("v", F.lit(None).cast("bigint"))
    parts = [rows.repartition(3), ends.coalesce(1)]
    for part in reversed(parts) if end_first else parts:
        part.write.mode("append").parquet(src)
    mixed = jobs.block_shuffle_stream(jobs.stream_table(spark, src, "*.parquet", 1), "idx", "v", 4, 2, 5, "shard")
    jobs.append_to(mixed, str(tmp_path / "out"), str(tmp_path / "cp"))
    found = spark.read.parquet(str(tmp_path / "out")).select("shard", "idx", "payload", "batch", "pos_in_batch").collect()
    twin = bt.block_shuffle(rows, "idx", 4, 2, 5, ["shard"]).select("shard", "idx", "v", "batch", "pos_in_batch").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, twin))
    assert len(found) == 104  # two shards of 53, the last block of each a batch of 4 and one over


def test_mixture_stream_hands_out_the_documents_of_the_batch_twin(spark, tmp_path):
    weights = {"big": 1.0, "tiny": 3.0}
    docs = spark.createDataFrame([(i, "big" if i % 10 else "tiny") for i in range(60)], "doc int, src string")
    draws = spark.range(200).select(F.col("id").alias("draw"))
    mx.source_slots(docs, "doc", "src", weights).write.parquet(str(tmp_path / "slots"))
    slots = spark.read.parquet(str(tmp_path / "slots"))
    step = jobs.mixture_step("draw", weights, 1, slots, "doc", str(tmp_path / "out"), str(tmp_path / "state"))
    for number in (0, 1, 1, 2):  # the second batch is run again after a failure
        step(draws.filter(F.floor(F.col("draw") / 70) == number), number)
    found = spark.read.parquet(str(tmp_path / "out")).select("draw", "source", "epoch", "doc").collect()
    twin = mx.mixture_draws(docs, "doc", "src", draws, "draw", weights, 1).select("draw", "source", "epoch", "doc").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, twin))
    assert max(r["epoch"] for r in found) > 5


class _Session:
    """Just the settings of a session."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master

    def getConf(self):
        return self.conf


def test_checkpoint_folder_comes_from_the_session():
    cluster = _Session("yarn", "hdfs://shared/checkpoints")
    assert session.shared_dir(cluster) == "hdfs://shared/checkpoints"
    assert session.scratch_path(cluster, "x").startswith("hdfs://shared/checkpoints/x-")
    with pytest.raises(ValueError):
        session.shared_dir(_Session("yarn", None))


def test_faults_that_sql_shared(spark):
    df = spark.createDataFrame([(1, "one\u0001two. Three!\nfour?  five")], "id long, text string")
    assert df.select(tx.sentences(F.col("text"))).first()[0] == ["one\u0001two.", "Three!", "four?", "five"]
    names = [r[0] for r in spark.range(120).select(writers.chunk_name("c.", ".jsonl", "id")).collect()]
    assert len(set(names)) == 120 and names[3] == "c.03.jsonl" and names[101] == "c.101.jsonl"
    rows = spark.createDataFrame([("p", "", []), ("p", "ab", [1.0, 3.0])], "path string, text string, ll array<double>")
    found = ev.validation_metrics(rows, "path", "ll", "text").first()
    assert (found["nll_per_token"], found["nll_per_char"], found["nll"]) == (2.0, 2.0, 2.0)
    none = spark.createDataFrame([(1, 0.0, 0, 0)], "e int, loss double, hit int, n int")
    assert ev.epoch_ratios(none, "e", "loss", "hit", "n").first()["accuracy"] is None
