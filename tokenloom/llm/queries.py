"""One registered query for each operator, over whole tables, with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import (
    decontamination,
    divergence,
    licences,
    line_dedup,
    lm,
    mixing,
    quality,
    sharding,
    simhash,
    substring_dedup,
    token_files,
    vector_codes,
    warc,
)
from tokenloom.llm.catalog import register
from tokenloom.plans.catalog import table
from tokenloom.session import scratch_path


@register("op1_substrings")
def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents")).drop("spans")


@register("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.drop("row_hash")


@register("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.contract(sharding.shard_by_bytes(table(spark, sf_dir, "documents")))


@register("op6_licences", licences.LICENCE_SQL)
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@register("op7_scoring")
def op7_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


@register("op8_lines", line_dedup.LINES_SQL)
def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    kept = F.md5(F.coalesce("kept_text", F.lit("")).cast("binary")).alias("kept_md5")
    return found.select("doc_id", "n_lines", "n_removed", kept)


@register("op9_mixing", mixing.MIX_SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = mixing.label_quality(table(spark, sf_dir, "labels"))
    mixed = mixing.mix_sources(mixing.sized_rows(table(spark, sf_dir, "documents"), quality))
    taken = (F.col("copies") * F.col("size")).cast("bigint").alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


WARC_SQL = """
WITH paid AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
marked AS (SELECT page_id, body, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first_id FROM paid)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS INTEGER)
        >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM marked
"""


@register("op10_warc", WARC_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = warc.read_archives(manifest, folder, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op11_token_files")
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_digests(spark, folder)


@register("op12_divergence", divergence.DIVERGENCE_SQL)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@register("op13_vector_codes", vector_codes.CODES_SQL)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    codes, books = vector_codes.compress(vectors)
    return codes.drop("label").withColumn("codebooks_sha256", F.lit(vector_codes.books_digest(books)))
