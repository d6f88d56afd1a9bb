"""Corpus queries: scans, sinks, filters, shuffles, samples, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.functions.hashing import gaussian
from tokenloom.functions.tokens import byte_token_count
from tokenloom.operators import corpus as cp
from tokenloom.operators import ordering as od
from tokenloom.operators import sampling as sp
from tokenloom.plans.catalog import register, sql_uniform, table
from tokenloom.session import scan_partitions, scratch_path
from tokenloom.sources import jsonl, named_files, readers, writers

LANGS = ["en", "fr", "de", "es"]
SEED = 42
RANK = f"row_number() OVER (ORDER BY {sql_uniform(SEED, 'doc_id')}, doc_id) - 1"
BLANK = f"NOT regexp_matches(text, '[^{tx.WHITE}]')"
CASE_LANG = "CASE lang " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(LANGS)) + " END"


def sql_strip(value: str) -> str:
    return f"regexp_replace({value}, '^[{tx.WHITE}]+|[{tx.WHITE}]+\\z', '', 'g')"


SENTENCES = f"""
SELECT doc_id, generate_subscripts(parts, 1) - 1 AS sent_no, {sql_strip('unnest(parts)')} AS sentence
FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])[ \\t\\n\\r]+', '\\1' || chr(1), 'g'), chr(1)) AS parts
      FROM documents)"""
WORDS = f"len(regexp_extract_all(sentence, '{tx.WORD_PATTERN}'))"
PAIRS_SQL = """
SELECT a.conv_id, a.turn, a.text AS en, b.text AS fr
FROM conversations a LEFT JOIN conversations b
  ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant'
WHERE a.role = 'user'"""


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(*columns) if columns else docs


def heavy_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents for CPU-heavy work, dealt out as the session's ``spark.tokenloom.scanPartitions`` says."""
    return od.spread(documents(spark, sf_dir, *columns), scan_partitions(spark))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn and the assistant turn after it; (conversation, turn) is unique, so no key is hot."""
    talk = table(spark, sf_dir, "conversations")
    asked = talk.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("en"))
    answered = talk.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("fr")
    )
    return asked.join(answered, ["conv_id", "turn"], "left")


# ---- scans -----------------------------------------------------------------


@register(
    "scan_parquet_by_language",
    "SELECT doc_id, lang, text FROM documents WHERE lang IN ('en', 'fr', 'de', 'es')",
)
def scan_parquet_by_language(spark, sf_dir):
    """One folder per language on disk, read back with the language taken from the path."""
    base = scratch_path(spark, "by-language")
    documents(spark, sf_dir, "doc_id", "lang", "text").write.partitionBy("lang").parquet(base)
    return readers.read_languages(spark, base, LANGS, folder="lang={}").select("doc_id", "lang", "text")


@register("scan_docs_text_key", "SELECT text FROM documents")
def scan_docs_text_key(spark, sf_dir):
    return readers.read_documents(spark, f"{sf_dir}/documents.parquet", text_key="text")


@register(
    "scan_jsonl_strided",
    """SELECT doc_id, CAST(doc_id % 4 AS INT) AS shard, line_no, CAST(line_no % 3 AS INT) AS "offset"
       FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) - 1 AS line_no
             FROM documents)""",
)
def scan_jsonl_strided(spark, sf_dir):
    """Lines of JSON-lines shards, numbered from the files themselves."""
    path = scratch_path(spark, "jsonl-shards")
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("shard", (F.col("doc_id") % 4).cast("int"))
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs.repartitionByRange(files, "doc_id").sortWithinPartitions("shard", "doc_id").write.partitionBy("shard").json(path)
    shard = F.regexp_extract(F.col("file"), "shard=([0-9]+)/", 1).cast("int")
    doc_id = jsonl.json_field("doc_id", "bigint")
    lines = jsonl.strided(jsonl.numbered_lines(spark, path, shard, "*.json", doc_id), 3)
    return lines.select(F.col("value").alias("doc_id"), "shard", "line_no", "offset")


@register(
    "repeat_epochs",
    "SELECT doc_id, CAST(unnest(range(3)) AS INT) AS current_iter FROM documents",
)
def repeat_epochs(spark, sf_dir):
    return od.repeat_epochs(documents(spark, sf_dir, "doc_id"), 3)


@register("scan_auto_format", "SELECT text, CAST(NULL AS VARCHAR) AS content FROM documents")
def scan_auto_format(spark, sf_dir):
    path = scratch_path(spark, "auto-format")
    writers.write_jsonl(documents(spark, sf_dir, "text"), path, tasks=None)
    return readers.read_auto(spark, path)


@register("scan_csv_pairs", f"SELECT en, fr FROM ({PAIRS_SQL})")
def scan_csv_pairs(spark, sf_dir):
    path = scratch_path(spark, "csv-pairs")
    turn_pairs(spark, sf_dir).select("en", "fr").write.option("header", True).option("escape", '"').csv(path)
    return readers.read_csv_pairs(spark, path)


@register(
    "scan_text_glob",
    "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line",
)
def scan_text_glob(spark, sf_dir):
    path = scratch_path(spark, "text-glob")
    writers.write_text_shards(documents(spark, sf_dir, "text"), path, group=None)
    lines = readers.read_text_glob(spark, path, "*.txt")
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "scan_languages_capped",
    f"""SELECT doc_id, lang, rank FROM (
          SELECT doc_id, lang, row_number() OVER (ORDER BY {CASE_LANG}, doc_id) - 1 AS rank FROM documents)
        WHERE rank < 700""",
)
def scan_languages_capped(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "lang")
    return cp.capped_by_listed_order(docs, "lang", LANGS, "doc_id", 700)


@register(
    "scan_metric_log",
    """SELECT event_id AS global_step, user_id AS run, event_type AS kind, value AS loss,
              CAST(json_extract(props, '$.k') AS BIGINT) AS k, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS created_at
       FROM events""",
)
def scan_metric_log(spark, sf_dir):
    path = scratch_path(spark, "metric-log")
    metric_rows(spark, sf_dir).write.json(path)
    log = readers.read_metric_log(spark, path)
    return log.select(
        "global_step",
        "run",
        "kind",
        F.col("`loss/out`").alias("loss"),
        F.col("`speed/k`").alias("k"),
        "created_at",
    )


def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as flat metric rows (``a/b`` keys)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("global_step"),
        F.col("user_id").alias("run"),
        F.col("event_type").alias("kind"),
        F.col("value").alias("loss/out"),
        F.from_json("props", "k bigint")["k"].alias("speed/k"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
    )


@register(
    "slice_rows_cached",
    """SELECT doc_id, row_idx FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents)
       WHERE row_idx >= 50 AND row_idx < 850""",
)
def slice_rows_cached(spark, sf_dir):
    cache = scratch_path(spark, "slices")
    return readers.slice_cached(documents(spark, sf_dir, "doc_id"), "doc_id", cache, "documents", 50, 850)


def _sql_gauss(seed: str, key: str) -> str:
    u1 = f"greatest({sql_uniform(seed + '/r', key)}, {1.0 / 4294967296.0!r})"
    return f"(sqrt(-2.0 * ln({u1})) * cos(2.0 * pi() * {sql_uniform(seed + '/a', key)}))"


@register(
    "synthetic_regression_rows",
    f"""SELECT o_orderkey, round(x0, 6) AS x0, round(x1, 6) AS x1,
               round(2.0 * x0 - 3.4 * x1 + 4.2 + 0.01 * e, 6) AS y
        FROM (SELECT o_orderkey, {_sql_gauss('x0', 'o_orderkey')} AS x0, {_sql_gauss('x1', 'o_orderkey')} AS x1,
                     {_sql_gauss('noise', 'o_orderkey')} AS e FROM orders)""",
)
def synthetic_regression_rows(spark, sf_dir):
    """One row of features and target per order: X ~ N(0, 1), y = Xw + b + noise."""
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        key, gaussian("x0", key).alias("x0"), gaussian("x1", key).alias("x1"), gaussian("noise", key).alias("e")
    )
    y = F.lit(2.0) * F.col("x0") - F.lit(3.4) * F.col("x1") + F.lit(4.2) + F.lit(0.01) * F.col("e")
    return rows.select(key, F.round("x0", 6).alias("x0"), F.round("x1", 6).alias("x1"), F.round(y, 6).alias("y"))


@register("scan_allow_patterns", "SELECT doc_id, lang, text FROM documents WHERE lang IN ('en', 'de')")
def scan_allow_patterns(spark, sf_dir):
    base = scratch_path(spark, "allow-patterns")
    documents(spark, sf_dir, "doc_id", "lang", "text").write.partitionBy("lang").parquet(base)
    return readers.read_allowed(spark, base, "lang=en/*.parquet,lang=de/*").select("doc_id", "lang", "text")


@register(
    "scan_validation_shards",
    """SELECT doc_id, source, step, 0 AS current_iter FROM (
         SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS step FROM documents)
       WHERE step < 30""",
)
def scan_validation_shards(spark, sf_dir):
    """Validation files of each source, read next to training files that do not match."""
    path = scratch_path(spark, "validation")
    docs = documents(spark, sf_dir, "doc_id", "text", "source")
    plan = writers.shard_plan(docs, "doc_id", "source", 50).withColumn("value", F.to_json(F.struct("doc_id", "text")))
    for suffix in ("val.jsonl", "jsonl"):
        file = F.format_string(f"%s/chunk.%05d.{suffix}", "source", "shard_no")
        named_files.write_named(plan.withColumn("file", file), path, ["row_no"])
    lines = jsonl.validation_lines(spark, path, 30, value=jsonl.json_field("doc_id", "bigint"))
    return lines.select(F.col("value").alias("doc_id"), "source", "step", "current_iter")


# ---- sinks -----------------------------------------------------------------


@register(
    "sink_text_shards",
    """SELECT lang, shard_no, count(*) AS n_records, min(doc_id) AS first_id, max(doc_id) AS last_id
       FROM (SELECT doc_id, lang, CAST(floor((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) / 35.0) AS BIGINT)
                    AS shard_no FROM documents) GROUP BY lang, shard_no""",
)
def sink_text_shards(spark, sf_dir):
    """Shards are written under planned names, a record on a line behind its id, and counted in the files."""
    path = scratch_path(spark, "text-shards")
    plan = writers.shard_plan(documents(spark, sf_dir, "doc_id", "lang", "text"), "doc_id", "lang", 35)
    record = F.concat_ws("\t", "doc_id", F.regexp_replace("text", "[\r\n]+", " "))
    file = F.format_string("%s/shard-%05d.txt", "lang", "shard_no")
    named_files.write_named(plan.select(file.alias("file"), record.alias("value"), "row_no"), path, ["row_no"])
    doc_id = F.substring_index("value", "\t", 1).cast("bigint")
    lines = jsonl.numbered_lines(spark, path, F.col("file"), "*.txt", doc_id).withColumnRenamed("value", "doc_id")
    place = [F.regexp_extract("file", "([^/]+)/shard-", 1).alias("lang"), F.regexp_extract("file", "/shard-([0-9]+)\\.txt$", 1).cast("bigint").alias("shard_no")]
    found = lines.groupBy(*place).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.min_by("doc_id", "line_no").alias("first_id"),
        F.max_by("doc_id", "line_no").alias("last_id"),
    )
    return found.select("lang", "shard_no", "n_records", "first_id", "last_id")


def _sampled_sentences(spark, sf_dir) -> DataFrame:
    kept = cp.explode_sentences(heavy_documents(spark, sf_dir, "doc_id", "text")).filter(
        tx.is_long_enough(F.col("sentence"))
    )
    return sp.bernoulli_sample(kept, SEED, F.col("doc_id"), F.col("sent_no"), percentage=20)


@register(
    "sink_sampled_sentences",
    f"""SELECT sentence, count(*) AS n FROM ({SENTENCES})
        WHERE {WORDS} >= 5 AND NOT contains(sentence, chr(10))
          AND {sql_uniform(SEED, "(doc_id || ':' || sent_no)")} < 0.2 GROUP BY sentence""",
)
def sink_sampled_sentences(spark, sf_dir):
    path = scratch_path(spark, "sentences")
    writers.write_text_shards(
        _sampled_sentences(spark, sf_dir), path, text="sentence", group=None, chunk_size=100_000
    )
    lines = readers.read_text_glob(spark, path, "*.txt")
    return lines.groupBy(F.col("value").alias("sentence")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "sink_line_count_meta",
    f"""SELECT lang, 'line_count: ' || count(*) AS value FROM documents WHERE NOT ({BLANK}) GROUP BY lang""",
)
def sink_line_count_meta(spark, sf_dir):
    path = scratch_path(spark, "line-counts")
    kept = cp.keep_nonblank(documents(spark, sf_dir, "lang", "text"))
    writers.write_line_counts(cp.count_by(kept, "lang"), path)
    return spark.read.text(path).select("lang", "value")


@register("sink_jsonl_chunks", "SELECT doc_id, text FROM documents")
def sink_jsonl_chunks(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    writers.write_jsonl(documents(spark, sf_dir, "doc_id", "text"), path, tasks=64)
    return readers.read_jsonl(spark, path, "doc_id bigint, text string")


@register(
    "sink_round_robin_chunks",
    f"""SELECT doc_id, rank, CAST(rank % 120 AS INT) AS chunk, 'chunk.' || printf('%02d', rank % 120) || '.jsonl' AS file
        FROM (SELECT doc_id, {RANK} AS rank FROM documents)""",
)
def sink_round_robin_chunks(spark, sf_dir):
    """Chunk files are written under their names; ranks follow from file and line number."""
    path = scratch_path(spark, "chunks")
    dealt = writers.round_robin_chunks(documents(spark, sf_dir, "doc_id", "text"), "doc_id", SEED, 120)
    dealt = dealt.withColumn("value", F.to_json(F.struct("doc_id", "text"))).withColumn("file", writers.chunk_name("chunk.", ".jsonl"))
    named_files.write_named(dealt, path, ["rank"])
    doc_id = jsonl.json_field("doc_id", "bigint")
    lines = jsonl.numbered_lines(spark, path, F.col("file"), "chunk.*.jsonl", doc_id).withColumnRenamed("value", "doc_id")
    chunk = F.regexp_extract("file", "chunk\\.([0-9]+)\\.jsonl$", 1).cast("int")
    file = F.substring_index("file", "/", -1)
    return lines.select("doc_id", (F.col("line_no") * 120 + chunk).alias("rank"), chunk.alias("chunk"), file.alias("file"))


@register(
    "sink_dataset_snapshot",
    f"""SELECT doc_id, text, CASE WHEN {sql_uniform(SEED, 'doc_id')} > 0.2 THEN 'train' ELSE 'test' END AS split
        FROM documents""",
)
def sink_dataset_snapshot(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    split = sp.split_bernoulli(documents(spark, sf_dir, "doc_id", "text"), SEED, "doc_id")
    writers.write_snapshot(split, path)
    return spark.read.parquet(path).select("doc_id", "text", F.col("split").cast("string"))


@register(
    "sink_metric_append",
    """SELECT kind, 2 * count(*) AS n, true AS stamped
       FROM (SELECT event_type AS kind FROM events) GROUP BY kind""",
)
def sink_metric_append(spark, sf_dir):
    """Two appends to one log; every row carries the time it was written."""
    path = scratch_path(spark, "metrics")
    rows = metric_rows(spark, sf_dir).drop("created_at")
    writers.append_metrics(rows, path)
    writers.append_metrics(rows, path)
    log = readers.read_metric_log(spark, path)
    stamped = F.bool_and(F.col("created_at").rlike("^\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d\\.\\d{6}$"))
    return log.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), stamped.alias("stamped"))


@register(
    "sink_first_n_docs",
    """SELECT doc_id, row_idx, CAST(floor(row_idx / 100.0) AS BIGINT) AS shard_no
       FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents) WHERE row_idx <= 500""",
)
def sink_first_n_docs(spark, sf_dir):
    """The reader stops after writing index N, so N + 1 documents are kept."""
    path = scratch_path(spark, "first-docs")
    kept = od.slice_rows(documents(spark, sf_dir, "doc_id", "text"), "doc_id", 0, 501)
    file = F.format_string("docs-%05d.jsonl", F.floor(F.col("row_idx") / 100).cast("bigint")).alias("file")
    named_files.write_named(kept.select(file, F.to_json(F.struct("doc_id", "text")).alias("value"), "row_idx"), path, ["row_idx"])
    doc_id = jsonl.json_field("doc_id", "bigint")
    lines = jsonl.numbered_lines(spark, path, F.col("file"), "docs-*.jsonl", doc_id).withColumnRenamed("value", "doc_id")
    shard = F.regexp_extract("file", "/docs-([0-9]+)\\.jsonl$", 1).cast("bigint")
    return lines.select("doc_id", (shard * 100 + F.col("line_no")).alias("row_idx"), shard.alias("shard_no"))


# ---- projections and filters ------------------------------------------------


@register("filter_blank_text", f"SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND NOT ({BLANK})")
def filter_blank_text(spark, sf_dir):
    return cp.keep_nonblank(documents(spark, sf_dir, "doc_id", "text"))


@register("project_text_or_content", "SELECT doc_id, text AS body FROM documents")
def project_text_or_content(spark, sf_dir):
    even = F.col("doc_id") % 2 == 0
    keyed = documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", F.when(even, F.col("text")).alias("text"), F.when(~even, F.col("text")).alias("content")
    )
    return keyed.select("doc_id", tx.text_or_content(F.col("text"), F.col("content")).alias("body"))


@register(
    "strip_special_markers",
    "SELECT page_id, regexp_replace(html, '<s>|</s>', '', 'g') AS text FROM pages",
)
def strip_special_markers(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.strip_markers(F.col("html")).alias("text"))


@register("filter_null_pairs", f"SELECT * FROM ({PAIRS_SQL}) WHERE en IS NOT NULL AND fr IS NOT NULL")
def filter_null_pairs(spark, sf_dir):
    return turn_pairs(spark, sf_dir).filter(F.col("en").isNotNull() & F.col("fr").isNotNull())


@register(
    "filter_pair_token_length",
    f"""SELECT conv_id, turn, n_tokens FROM (
          SELECT conv_id, turn, CAST(strlen(en || fr) + 2 AS INT) AS n_tokens FROM ({PAIRS_SQL})) WHERE n_tokens < 500""",
)
def filter_pair_token_length(spark, sf_dir):
    n = byte_token_count(F.concat(F.col("en"), F.col("fr"))).alias("n_tokens")
    return turn_pairs(spark, sf_dir).select("conv_id", "turn", n).filter(F.col("n_tokens") < 500)


@register(
    "filter_short_sentences",
    f"""SELECT doc_id, CAST(sent_no AS INT) AS sent_no, sentence, CAST({WORDS} AS INT) AS n_words FROM ({SENTENCES})
        WHERE {WORDS} >= 5 AND NOT contains(sentence, chr(10))""",
)
def filter_short_sentences(spark, sf_dir):
    rows = cp.explode_sentences(heavy_documents(spark, sf_dir, "doc_id", "text"))
    return rows.filter(tx.is_long_enough(F.col("sentence"))).withColumn("n_words", tx.word_count(F.col("sentence")))


@register("split_sentences", f"SELECT doc_id, CAST(sent_no AS INT) AS sent_no, sentence FROM ({SENTENCES})")
def split_sentences(spark, sf_dir):
    return cp.explode_sentences(heavy_documents(spark, sf_dir, "doc_id", "text"))


@register("filter_max_sentence_bytes", "SELECT doc_id, CAST(strlen(text) AS INT) AS n_bytes FROM documents WHERE strlen(text) <= 2000")
def filter_max_sentence_bytes(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    return docs.filter(F.octet_length("text") <= 2000).select("doc_id", F.octet_length("text").alias("n_bytes"))


@register(
    "assert_sources_exist",
    """SELECT source FROM (SELECT DISTINCT source FROM documents UNION SELECT 'src-missing')
       WHERE source NOT IN (SELECT source FROM documents)""",
)
def assert_sources_exist(spark, sf_dir):
    """Sources of the corpus plus one that has no data: the check must name exactly that one."""
    docs = documents(spark, sf_dir, "source")
    configured = docs.distinct().unionByName(spark.createDataFrame([("src-missing",)], "source string"))
    return cp.missing_sources(configured, docs)


STOPS = ["the", "and ", ". "]
STOPS_SQL = "text"
for _stop in STOPS:
    STOPS_SQL = f"replace({STOPS_SQL}, '{_stop}', '')"


@register(
    "strip_stop_strings",
    f"""SELECT conv_id, turn, {STOPS_SQL} AS completion,
               ({' OR '.join(f"contains(right(text, 16), '{s}')" for s in STOPS)}) AS stopped FROM conversations""",
)
def strip_stop_strings(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        tx.strip_all(text, STOPS).alias("completion"),
        tx.ends_generation(F.right(text, F.lit(16)), STOPS).alias("stopped"),
    )


# ---- counts, unions ----------------------------------------------------------


@register(
    "count_lines_by_language",
    f"SELECT lang, count(*) AS line_count FROM documents WHERE NOT ({BLANK}) GROUP BY lang",
)
def count_lines_by_language(spark, sf_dir):
    return cp.count_by(cp.keep_nonblank(documents(spark, sf_dir, "lang", "text")), "lang")


@register("union_language_branches", "SELECT doc_id, lang, lang AS branch FROM documents WHERE lang IN ('en', 'fr', 'de')")
def union_language_branches(spark, sf_dir):
    return cp.union_branches(documents(spark, sf_dir, "doc_id", "lang"), "lang", ["en", "fr", "de"])


# ---- shuffles, heads, splits ---------------------------------------------------


@register("global_shuffle_seeded", f"SELECT doc_id, {RANK} AS rank FROM documents")
def global_shuffle_seeded(spark, sf_dir):
    return od.global_shuffle(documents(spark, sf_dir, "doc_id"), SEED, "doc_id")


def _chunked(spark, sf_dir) -> DataFrame:
    dealt = writers.round_robin_chunks(documents(spark, sf_dir, "doc_id"), "doc_id", SEED, 8)
    return cp.validation_head(
        dealt.withColumn("row_in_chunk", F.floor(F.col("rank") / 8).cast("bigint")), "chunk", "row_in_chunk", 20
    )


CHUNKED = f"""SELECT doc_id, CAST(rank % 8 AS INT) AS chunk, rank // 8 AS row_in_chunk
              FROM (SELECT doc_id, {RANK} AS rank FROM documents)"""


@register("validation_head_per_chunk", f"SELECT doc_id, chunk, row_in_chunk FROM ({CHUNKED}) WHERE row_in_chunk < 20")
def validation_head_per_chunk(spark, sf_dir):
    return _chunked(spark, sf_dir).filter("is_validation").select("doc_id", "chunk", "row_in_chunk")


@register(
    "corpus_minus_validation",
    f"SELECT d.doc_id, d.text FROM documents d JOIN ({CHUNKED}) c USING (doc_id) WHERE c.row_in_chunk >= 20",
)
def corpus_minus_validation(spark, sf_dir):
    held_out = _chunked(spark, sf_dir).filter("is_validation")
    return cp.minus_validation(documents(spark, sf_dir, "doc_id", "text"), held_out, "doc_id")


@register(
    "take_then_filter",
    """SELECT doc_id, row_idx FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents)
       WHERE row_idx < 600 AND lang <> 'en'""",
)
def take_then_filter(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "lang")
    return cp.take_then_filter(docs, "doc_id", 600, F.col("lang") != "en").drop("lang")


@register("bernoulli_sample", f"SELECT doc_id, text FROM documents WHERE {sql_uniform(SEED, 'doc_id')} < 0.2")
def bernoulli_sample(spark, sf_dir):
    return sp.bernoulli_sample(documents(spark, sf_dir, "doc_id", "text"), SEED, F.col("doc_id"), percentage=20)


@register(
    "train_test_split_exact",
    f"""SELECT doc_id, CASE WHEN rank < ceil(0.2 * (SELECT count(*) FROM documents)) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT doc_id, {RANK} AS rank FROM documents)""",
)
def train_test_split_exact(spark, sf_dir):
    return sp.split_exact(documents(spark, sf_dir, "doc_id"), SEED, "doc_id").drop("rank")


@register(
    "train_test_split_bernoulli",
    f"SELECT doc_id, CASE WHEN {sql_uniform(SEED, 'doc_id')} > 0.2 THEN 'train' ELSE 'test' END AS split FROM documents",
)
def train_test_split_bernoulli(spark, sf_dir):
    return sp.split_bernoulli(documents(spark, sf_dir, "doc_id"), SEED, "doc_id")


@register(
    "range_split",
    """SELECT doc_id, row_idx, CASE WHEN row_idx < 600 THEN 'train' ELSE 'validation' END AS split
       FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents)
       WHERE row_idx < 600 OR (row_idx >= 601 AND row_idx < 900)""",
)
def range_split(spark, sf_dir):
    """Training rows [0, 600) and validation rows [601, 900); the row between belongs to neither."""
    ranked = od.slice_rows(documents(spark, sf_dir, "doc_id"), "doc_id", 0, 900)
    row = F.col("row_idx")
    split = F.when(row < 600, "train").when((row >= 601) & (row < 900), "validation")
    return ranked.withColumn("split", split).filter(F.col("split").isNotNull())


@register(
    "strided_subset",
    """SELECT vec_id, idx FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS idx FROM embeddings)
       WHERE idx % greatest(1, (SELECT count(*) FROM embeddings) // 128) = 0""",
)
def strided_subset(spark, sf_dir):
    """Every ``max(1, n // 128)``-th row."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id")
    step = F.greatest(F.lit(1), F.floor(od.row_total(vectors) / 128))
    return od.rank_by_id(vectors, "vec_id", "idx").filter(F.col("idx") % step == 0)
