"""Training-data queries: byte tokens, mixtures, packing, batching, fill-in-the-middle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.functions import tokens as tk
from tokenloom.functions.arrays import array_sum, checksum, exclusive_cumsum, let, window_checksum, window_sum
from tokenloom.operators import batching as bt
from tokenloom.operators import corpus as cp
from tokenloom.operators import mixture as mx
from tokenloom.operators import ordering as od
from tokenloom.operators import packing as pk
from tokenloom.plans.catalog import register, sql_bytes, sql_checksum, sql_tokens, sql_uniform, table
from tokenloom.plans.corpus import BLANK, PAIRS_SQL, SEED, documents, heavy_documents, turn_pairs

SEQ_LEN, N_VIEWS, SHARDS = 128, 2, 4
WINDOW = SEQ_LEN + N_VIEWS - 1
BATCH, PREFETCH = 8, 16
# Ids beyond the byte tokenizer's 0..257 and the fill-in-the-middle markers.
PAD, EN_OPEN, EN_CLOSE, FR_OPEN, FR_CLOSE = 261, 262, 263, 264, 265

CLEAN_SQL = f"SELECT doc_id, regexp_replace(text, '<s>|</s>', '', 'g') AS text FROM documents WHERE NOT ({BLANK})"
STREAM_SQL = f"""
d AS (SELECT doc_id, CAST(doc_id % {SHARDS} AS INT) AS shard, {sql_tokens('text')} AS t FROM ({CLEAN_SQL})),
s AS (SELECT shard, t, sum(len(t)) OVER (PARTITION BY shard ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - len(t) AS start FROM d),
x AS (SELECT shard, CAST(start AS BIGINT) + generate_subscripts(t, 1) - 1 AS p, unnest(t) AS tok FROM s),
w AS (SELECT shard, p // {SEQ_LEN} AS window_id, p % {SEQ_LEN} AS i, tok FROM x
      UNION ALL
      SELECT shard, p // {SEQ_LEN} - 1, p % {SEQ_LEN} + {SEQ_LEN}, tok FROM x WHERE p % {SEQ_LEN} < {N_VIEWS - 1} AND p >= {SEQ_LEN}),
full_windows AS (SELECT shard, window_id, CAST(count(*) AS INT) AS n_tokens, CAST(sum(tok) AS BIGINT) AS token_sum,
      CAST(sum(tok * (i + 1)) AS BIGINT) AS check_sum FROM w GROUP BY shard, window_id HAVING count(*) = {WINDOW})"""


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-blank documents without the special markers."""
    kept = cp.keep_nonblank(heavy_documents(spark, sf_dir, "doc_id", "text"))
    return kept.select(
        "doc_id",
        (F.col("doc_id") % SHARDS).cast("int").alias("shard"),
        tx.strip_markers(F.col("text")).alias("text"),
    )


def packed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return pk.pack_text(
        clean_documents(spark, sf_dir),
        "text",
        None,
        tk.byte_token_count(text),
        "doc_id",
        SEQ_LEN,
        N_VIEWS,
        ["shard"],
        ids=documents(spark, sf_dir, "doc_id"),
    )


@register(
    "byte_tokenize",
    f"""SELECT doc_id, CAST(len(t) AS INT) AS n_tokens, {sql_checksum('t')} AS check_sum
        FROM (SELECT doc_id, {sql_tokens('text')} AS t FROM documents)""",
)
def byte_tokenize(spark, sf_dir):
    rows = heavy_documents(spark, sf_dir, "doc_id", "text").select("doc_id", tk.byte_tokens(F.col("text")).alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), checksum(F.col("t")).alias("check_sum"))


@register("byte_detokenize", "SELECT doc_id, text FROM documents")
def byte_detokenize(spark, sf_dir):
    rows = heavy_documents(spark, sf_dir, "doc_id", "text").select("doc_id", tk.byte_tokens(F.col("text")).alias("t"))
    return rows.select("doc_id", tk.byte_text(F.col("t")).alias("text"))


@register(
    "add_bos_eos",
    f"""SELECT conv_id, turn, CAST(len(t) AS INT) AS n_tokens, {sql_checksum('t')} AS check_sum
        FROM (SELECT conv_id, turn, list_concat(list_concat([1], {sql_bytes('text')}), [2]) AS t FROM conversations)""",
)
def add_bos_eos(spark, sf_dir):
    ids = tk.add_bos_eos(tk.text_bytes(F.col("text")), 1, 2)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", ids.alias("t"))
    return rows.select("conv_id", "turn", F.size("t").alias("n_tokens"), checksum(F.col("t")).alias("check_sum"))


@register(
    "token_offsets",
    """SELECT doc_id, CAST(sum(n) AS INT) AS n_tokens, CAST(sum((p - 1) * n) AS BIGINT) AS offset_sum FROM (
         SELECT doc_id, generate_subscripts(c, 1) AS p, strlen(unnest(c)) AS n
         FROM (SELECT doc_id, regexp_extract_all(text, '(?s).') AS c FROM documents)) GROUP BY doc_id""",
)
def token_offsets(spark, sf_dir):
    """Character offset of every byte token."""
    at = tk.byte_offsets(F.col("text"))
    rows = heavy_documents(spark, sf_dir, "doc_id", "text").select("doc_id", at.alias("o"))
    return rows.select("doc_id", F.size("o").alias("n_tokens"), array_sum(F.col("o")).alias("offset_sum"))


@register(
    "split_long_text",
    """SELECT doc_id, CAST(i AS INT) AS slice_no, substr(text, CAST(i * 1000 + 1 AS BIGINT), 1000) AS part
       FROM (SELECT doc_id, text, unnest(range(CAST(greatest((length(text) - 1) // 1000, 0) + 1 AS BIGINT))) AS i FROM documents)""",
)
def split_long_text(spark, sf_dir):
    parts = tk.split_long_text(F.col("text"), 1000)
    return heavy_documents(spark, sf_dir, "doc_id", "text").select("doc_id", F.posexplode(parts).alias("slice_no", "part"))


# ---- mixture and shards ----------------------------------------------------------

WEIGHTS = {"en": 1.0, "fr": 2.0, "de": 2.0, "es": 5.0}


def _sql_choice() -> str:
    upto, cases = 0.0, []
    for name, weight in WEIGHTS.items():
        upto += weight
        cases.append(f"WHEN u < {upto} THEN '{name}'")
    return f"SELECT doc_id AS draw_id, CASE {' '.join(cases)} END AS source FROM (SELECT doc_id, {sql_uniform(SEED, 'doc_id')} * {upto} AS u FROM documents)"


@register(
    "mixture_weighted_draws",
    f"""WITH draws AS (SELECT draw_id, source, row_number() OVER (PARTITION BY source ORDER BY draw_id) - 1 AS o FROM ({_sql_choice()})),
        docs AS (SELECT doc_id, lang AS source, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS slot,
                        count(*) OVER (PARTITION BY lang) AS n FROM documents)
        SELECT draw_id, source, o // n AS epoch, doc_id FROM draws JOIN docs USING (source) WHERE o % n = slot""",
)
def mixture_weighted_draws(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "lang")
    draws = docs.select(F.col("doc_id").alias("draw_id"))
    return mx.mixture_draws(docs, "doc_id", "lang", draws, "draw_id", WEIGHTS, SEED)


@register(
    "assign_shards_to_ranks",
    """WITH c AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS no, count(*) OVER () AS n
                  FROM (SELECT DISTINCT source FROM documents))
       SELECT CAST(2 * n AS INT) AS world, CAST(no * 2 + o AS INT) AS rank, source, 2 AS block_size, CAST(o AS INT) AS "offset"
       FROM c, (SELECT unnest(range(2)) AS o)
       UNION ALL
       SELECT 8, CAST(no AS INT), source, 1, 0 FROM c WHERE no < 8""",
)
def assign_shards_to_ranks(spark, sf_dir):
    """Both cases: two ranks per chunk, and fewer ranks than chunks."""
    chunks = documents(spark, sf_dir, "source").distinct()
    world = 2 * chunks.count()
    many = mx.assign_shards(chunks, "source", world).withColumn("world", F.lit(world))
    few = mx.assign_shards(chunks, "source", 8).withColumn("world", F.lit(8))
    return many.unionByName(few)


# ---- packing ---------------------------------------------------------------------


@register("pack_tokens", f"WITH {STREAM_SQL} SELECT * FROM full_windows")
def pack_tokens(spark, sf_dir):
    w = F.col("window")
    return packed_windows(spark, sf_dir).select(
        "shard",
        "window_id",
        F.size(w).alias("n_tokens"),
        window_sum(w).alias("token_sum"),
        window_checksum(w).alias("check_sum"),
    )


@register(
    "shifted_views",
    f"""WITH {STREAM_SQL},
        v AS (SELECT w.shard, w.window_id, CAST(v.view AS INT) AS "view", w.tok, w.i - v.view AS i
              FROM w JOIN full_windows USING (shard, window_id), (SELECT unnest(range({N_VIEWS})) AS view) v
              WHERE w.i >= v.view AND w.i < v.view + {SEQ_LEN})
        SELECT shard, window_id, "view", CAST(count(*) AS INT) AS n_tokens, CAST(sum(tok) AS BIGINT) AS token_sum,
               CAST(sum(tok * (i + 1)) AS BIGINT) AS check_sum FROM v GROUP BY shard, window_id, "view" """,
)
def shifted_views(spark, sf_dir):
    views = packed_windows(spark, sf_dir).select(
        "shard", "window_id", F.posexplode(tk.shifted_views(F.col("window"), SEQ_LEN, N_VIEWS)).alias("view", "t")
    )
    t = F.col("t")
    return views.select(
        "shard",
        "window_id",
        "view",
        F.size(t).alias("n_tokens"),
        window_sum(t).alias("token_sum"),
        window_checksum(t).alias("check_sum"),
    )


@register(
    "sliding_examples",
    f"""WITH d AS (SELECT doc_id, {sql_tokens('text')} AS t FROM ({CLEAN_SQL})),
        s AS (SELECT t, sum(len(t)) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - len(t) AS start FROM d),
        x AS (SELECT CAST(start AS BIGINT) + generate_subscripts(t, 1) - 1 AS p, unnest(t) AS tok FROM s),
        y AS (SELECT p, tok, unnest(range(greatest(0, (p - 256) // 128), p // 128 + 1)) AS k FROM x),
        z AS (SELECT k, p - k * 128 AS i, tok FROM y WHERE p - k * 128 BETWEEN 0 AND 256)
        SELECT k * 128 AS start,
               CAST(sum(CASE WHEN i < 256 THEN tok * (i + 1) ELSE 0 END) AS BIGINT) AS input_sum,
               CAST(sum(CASE WHEN i > 0 THEN tok * i ELSE 0 END) AS BIGINT) AS target_sum
        FROM z GROUP BY k HAVING count(*) = 257""",
)
def sliding_examples(spark, sf_dir):
    text = F.col("text")
    rows = pk.sliding_examples(
        clean_documents(spark, sf_dir),
        "text",
        None,
        tk.byte_token_count(text),
        "doc_id",
        256,
        128,
        ids=documents(spark, sf_dir, "doc_id"),
    )
    return rows.select(
        "start", window_checksum(F.col("input")).alias("input_sum"), window_checksum(F.col("target")).alias("target_sum")
    )


@register(
    "block_shuffle_batches",
    f"""WITH {STREAM_SQL},
        b AS (SELECT shard, window_id, check_sum, window_id // {BATCH * PREFETCH} AS block FROM full_windows),
        r AS (SELECT *, row_number() OVER (PARTITION BY shard, block
                     ORDER BY {sql_uniform(SEED, "(shard || ':' || window_id)")}, window_id) - 1 AS rn FROM b),
        o AS (SELECT shard, window_id, check_sum, block * {PREFETCH} + rn // {BATCH} AS batch, CAST(rn % {BATCH} AS INT) AS pos_in_batch FROM r)
        SELECT shard, window_id, check_sum, batch, pos_in_batch
        FROM (SELECT *, count(*) OVER (PARTITION BY shard, batch) AS n FROM o) WHERE n = {BATCH}""",
)
def block_shuffle_batches(spark, sf_dir):
    windows = packed_windows(spark, sf_dir).select("shard", "window_id", window_checksum(F.col("window")).alias("check_sum"))
    mixed = bt.block_shuffle(windows, "window_id", BATCH, PREFETCH, SEED, ["shard"])
    return mixed.select("shard", "window_id", "check_sum", "batch", "pos_in_batch")


@register(
    "split_by_end_token",
    f"""WITH {STREAM_SQL},
        e AS (SELECT shard, window_id, w.i, (w.tok = 257) AS is_end FROM w JOIN full_windows USING (shard, window_id))
        SELECT shard, window_id,
               CAST(count(*) FILTER (is_end AND i < {WINDOW - 1}) + 1 AS INT) AS n_chunks,
               CAST(sum(i) FILTER (is_end OR i = {WINDOW - 1}) AS BIGINT) AS last_places
        FROM e GROUP BY shard, window_id""",
)
def split_by_end_token(spark, sf_dir):
    """Documents inside each window; ``last_places`` adds up where the pieces end."""
    cut = packed_windows(spark, sf_dir).select(
        "shard", "window_id", tk.split_by_end_token(F.col("window"), tk.BYTE_EOS).alias("chunks")
    )
    sizes = F.transform("chunks", lambda c: F.size(c))
    ends = let(sizes, lambda s: F.zip_with(exclusive_cumsum(s), s, lambda a, n: a + n - 1))
    return cut.select("shard", "window_id", F.size("chunks").alias("n_chunks"), array_sum(ends).alias("last_places"))


def _sql_fim(rate: float) -> str:
    cut = "CAST(floor({u} * (n + 1)) AS BIGINT)"
    a = cut.format(u=sql_uniform(f"{SEED}/cut-a", "doc_id"))
    b = cut.format(u=sql_uniform(f"{SEED}/cut-b", "doc_id"))
    return f"""
        WITH d AS (SELECT doc_id, {sql_bytes('text')} AS body FROM documents),
        c AS (SELECT doc_id, body, len(body) AS n, {sql_uniform(f'{SEED}/apply', 'doc_id')} < {rate} AS chosen FROM d),
        k AS (SELECT *, least({a}, {b}) AS lo, greatest({a}, {b}) AS hi FROM c),
        t AS (SELECT doc_id, CASE WHEN chosen AND n >= 1
                THEN list_concat([256, 258], body[1:lo], [259], body[hi + 1:], [260], body[lo + 1:hi], [257])
                ELSE list_concat([256], body, [257]) END AS t FROM k)
        SELECT doc_id, CAST(len(t) AS INT) AS n_tokens, {sql_checksum('t')} AS check_sum FROM t"""


@register("fill_in_middle", _sql_fim(0.5))
def fill_in_middle(spark, sf_dir):
    """Document mode: before packing, half of the documents rewritten."""
    ids = tk.fill_in_middle(tk.byte_tokens(F.col("text")), [F.col("doc_id")], SEED, 0.5)
    rows = heavy_documents(spark, sf_dir, "doc_id", "text").select("doc_id", ids.alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), checksum(F.col("t")).alias("check_sum"))


def _sql_fim_pieces(rate: float) -> str:
    """Every piece of a window by itself: three tokens come off its suffix, and it stays as it is where they cannot."""
    key = "shard || ':' || window_id || ':' || piece_no"
    cut = "CAST(floor({u} * (n + 1)) AS BIGINT)"
    a = cut.format(u=sql_uniform(f"{SEED}/cut-a", key))
    b = cut.format(u=sql_uniform(f"{SEED}/cut-b", key))
    return f"""
        WITH {STREAM_SQL},
        whole AS (SELECT shard, window_id, list(tok ORDER BY i) AS t FROM w JOIN full_windows USING (shard, window_id) GROUP BY ALL),
        ends AS (SELECT *, list_distinct(list_concat(list_filter(range(1, len(t) + 1), lambda i: t[i] = 257), [len(t)])) AS e FROM whole),
        stops AS (SELECT *, list_concat([0], list_sort(e)) AS stop FROM ends),
        spans AS (SELECT shard, window_id, t, stop, unnest(range(0, len(stop) - 1)) AS piece_no FROM stops),
        pieces AS (SELECT shard, window_id, piece_no, t[stop[piece_no + 1] + 1 : stop[piece_no + 2]] AS p FROM spans),
        bodies AS (SELECT *, CASE WHEN p[1] = 256 THEN [256] ELSE [] END AS head, CASE WHEN p[-1] = 257 THEN [257] ELSE [] END AS tail,
               p[CASE WHEN p[1] = 256 THEN 2 ELSE 1 END : CASE WHEN p[-1] = 257 THEN len(p) - 1 ELSE len(p) END] AS body FROM pieces),
        c AS (SELECT *, len(body) AS n, {sql_uniform(f'{SEED}/apply', key)} < {rate} AND len(p) >= 3 AS chosen FROM bodies),
        k AS (SELECT *, least({a}, {b}) AS lo, greatest({a}, {b}) AS hi FROM c),
        r AS (SELECT shard, window_id, piece_no, CASE WHEN chosen AND n - hi > 3
            THEN list_concat(head, [258], body[1:lo], [259], body[hi + 1:n - 3], [260], body[lo + 1:hi], tail) ELSE p END AS p FROM k),
        o AS (SELECT shard, window_id, flatten(list(p ORDER BY piece_no)) AS t FROM r GROUP BY ALL)
        SELECT shard, window_id, CAST(len(t) AS INT) AS n_tokens, {sql_checksum('t')} AS check_sum FROM o"""


@register("fill_in_middle_chunks", _sql_fim_pieces(0.5))
def fill_in_middle_chunks(spark, sf_dir):
    """Content mode: after packing, per document piece of a window, keeping the window's length."""
    pieces = packed_windows(spark, sf_dir).select(
        "shard",
        "window_id",
        F.posexplode(tk.split_by_end_token(F.col("window"), tk.BYTE_EOS)).alias("piece_no", "piece"),
    )
    keys = [F.col("shard"), F.col("window_id"), F.col("piece_no")]
    rewritten = pieces.withColumn("piece", tk.fill_in_middle(F.col("piece"), keys, SEED, 0.5, truncate=True))
    windows = rewritten.groupBy("shard", "window_id").agg(
        F.flatten(F.array_sort(F.collect_list(F.struct("piece_no", "piece")))["piece"]).alias("window")
    )
    return windows.select(
        "shard", "window_id", F.size("window").alias("n_tokens"), checksum(F.col("window")).alias("check_sum")
    )


# ---- prompts and segments -----------------------------------------------------------


def _prompt_batches(spark, sf_dir) -> DataFrame:
    docs = bt.batch_rows(documents(spark, sf_dir, "doc_id", "text"), "doc_id", 16)
    rows = docs.select("batch", "pos_in_batch", tk.byte_tokens(F.col("text")).alias("tokens"))
    return bt.pack_prompts(rows, "batch", "pos_in_batch", "tokens")


PROMPTS_SQL = f"""
p AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch, strlen(text) + 2 AS n, {sql_tokens('text')} AS t FROM documents),
q AS (SELECT batch, doc_id, t, n, row_number() OVER (PARTITION BY batch ORDER BY doc_id) - 1 AS segment,
             sum(n) OVER (PARTITION BY batch ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - n AS start FROM p)"""


@register(
    "pack_prompts",
    f"""WITH {PROMPTS_SQL}, u AS (SELECT batch, start + generate_subscripts(t, 1) AS place, unnest(t) AS tok FROM q),
        n AS (SELECT batch, CAST(count(*) AS INT) AS n_prompts FROM q GROUP BY batch)
        SELECT batch, n_prompts, CAST(count(*) AS INT) AS n_tokens, CAST(sum(tok * place) AS BIGINT) AS check_sum
        FROM u JOIN n USING (batch) GROUP BY batch, n_prompts""",
)
def pack_prompts(spark, sf_dir):
    return _prompt_batches(spark, sf_dir).select(
        "batch",
        F.size("lengths").alias("n_prompts"),
        F.size("tokens").alias("n_tokens"),
        checksum(F.col("tokens")).alias("check_sum"),
    )


def _lengths(spark, sf_dir) -> DataFrame:
    """Prompt lengths per batch, without building tokens."""
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("n", tk.byte_token_count(F.col("text"))).drop("text")
    rows = bt.batch_rows(docs, "doc_id", 16)
    parts = F.array_sort(F.collect_list(F.struct("pos_in_batch", "n")))
    return rows.groupBy("batch").agg(parts["n"].alias("lengths"))


@register(
    "segment_starts",
    f"""WITH {PROMPTS_SQL} SELECT batch, CAST(segment AS INT) AS segment, CAST(n AS INT) AS length, CAST(start AS BIGINT) AS start FROM q""",
)
def segment_starts(spark, sf_dir):
    zipped = F.arrays_zip(F.col("lengths").alias("length"), exclusive_cumsum(F.col("lengths")).alias("start"))
    rows = _lengths(spark, sf_dir).select("batch", F.posexplode(zipped).alias("segment", "z"))
    return rows.select("batch", "segment", "z.length", "z.start")


@register(
    "segment_local_ids",
    f"""WITH {PROMPTS_SQL} SELECT batch, CAST(segment AS INT) AS segment, CAST(n AS BIGINT) AS n_tokens,
               CAST(n * (n - 1) / 2 AS BIGINT) AS position_sum FROM q""",
)
def segment_local_ids(spark, sf_dir):
    rows = _lengths(spark, sf_dir).select("batch", F.explode(pk.segment_sums(F.col("lengths"))).alias("x"))
    return rows.select("batch", "x.segment", "x.n_tokens", "x.position_sum")


@register(
    "segment_visible_pairs",
    f"""WITH {PROMPTS_SQL} SELECT batch, CAST(segment AS INT) AS segment, CAST(start AS INT) AS first_kv,
               CAST(start + n - 1 AS INT) AS last_q, CAST(n * (n + 1) / 2 AS BIGINT) AS n_pairs FROM q""",
)
def segment_visible_pairs(spark, sf_dir):
    """Visible (query, key) pairs as one key range per query, counted per segment."""
    rows = _lengths(spark, sf_dir).select("batch", F.explode(pk.segment_sums(F.col("lengths"))).alias("x"))
    return rows.select("batch", "x.segment", "x.first_kv", "x.last_q", "x.n_pairs")


@register(
    "batch_by_token_budget",
    """WITH RECURSIVE l AS (SELECT doc_id, rn // 256 AS call, rn % 256 AS i, strlen(text) + 2 AS n_tokens
           FROM (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM documents)),
       f AS (SELECT call, i, doc_id, n_tokens, 0 AS batch, n_tokens AS used FROM l WHERE i = 0
             UNION ALL
             SELECT l.call, l.i, l.doc_id, l.n_tokens,
                    CASE WHEN f.used + l.n_tokens > 8000 THEN f.batch + 1 ELSE f.batch END,
                    CASE WHEN f.used + l.n_tokens > 8000 THEN l.n_tokens ELSE f.used + l.n_tokens END
             FROM f JOIN l ON l.call = f.call AND l.i = f.i + 1)
       SELECT call, doc_id, n_tokens, CAST(batch AS BIGINT) AS batch FROM f""",
)
def batch_by_token_budget(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", tk.byte_token_count(F.col("text")).alias("n_tokens")
    )
    calls = od.rank_by_id(docs, "doc_id", "rn").withColumn("call", F.floor(F.col("rn") / 256))
    return bt.batch_by_token_budget(calls, "doc_id", "n_tokens", 8000, "call")


@register(
    "batch_request_by_token_budget",
    """WITH RECURSIVE l AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, strlen(text) + 2 AS n_tokens FROM documents),
       f AS (SELECT i, doc_id, n_tokens, 0 AS batch, n_tokens AS used FROM l WHERE i = 0
             UNION ALL
             SELECT l.i, l.doc_id, l.n_tokens, CASE WHEN f.used + l.n_tokens > 8000 THEN f.batch + 1 ELSE f.batch END,
                    CASE WHEN f.used + l.n_tokens > 8000 THEN l.n_tokens ELSE f.used + l.n_tokens END
             FROM f JOIN l ON l.i = f.i + 1)
       SELECT CAST(0 AS BIGINT) AS call, doc_id, n_tokens, CAST(batch AS BIGINT) AS batch FROM f""",
)
def batch_request_by_token_budget(spark, sf_dir):
    """The whole table as one request."""
    docs = documents(spark, sf_dir, "doc_id", "text").select(
        F.lit(0).alias("call"), "doc_id", tk.byte_token_count(F.col("text")).alias("n_tokens")
    )
    return bt.batch_requests_of_any_size(docs, "doc_id", "n_tokens", 8000, "call")


@register(
    "truncate_keep_tail",
    f"""SELECT doc_id, CAST(len(t) AS INT) AS n_tokens, {sql_checksum('t')} AS check_sum FROM (
          SELECT doc_id, t[greatest(len(t) - 511, 1):] AS t FROM (SELECT doc_id, {sql_tokens('text')} AS t FROM documents))""",
)
def truncate_keep_tail(spark, sf_dir):
    tail = tk.keep_tail(tk.byte_tokens(F.col("text")), F.lit(512))
    rows = heavy_documents(spark, sf_dir, "doc_id", "text").select("doc_id", tail.alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), checksum(F.col("t")).alias("check_sum"))


# ---- samplers, batches, padded examples ------------------------------------------------


@register(
    "distributed_sampler",
    f"""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {sql_uniform(SEED + 3, 'doc_id')}, doc_id) - 1 AS rn,
                          count(*) OVER () AS n FROM documents),
        p AS (SELECT doc_id, rn AS place FROM r UNION ALL SELECT doc_id, rn + n FROM r WHERE rn + n < ceil(n / 7.0) * 7)
        SELECT doc_id, place, CAST(place % 7 AS INT) AS rank, place // 7 AS step FROM p""",
)
def distributed_sampler(spark, sf_dir):
    return bt.distributed_sampler(documents(spark, sf_dir, "doc_id"), "doc_id", 7, SEED, epoch=3)


@register(
    "batch_rows",
    f"""SELECT doc_id, rn // 32 AS batch, CAST(rn % 32 AS INT) AS pos_in_batch
        FROM (SELECT doc_id, row_number() OVER (ORDER BY {sql_uniform(SEED, 'doc_id')}, doc_id) - 1 AS rn, count(*) OVER () AS n FROM documents)
        WHERE (rn // 32 + 1) * 32 <= n""",
)
def batch_rows(spark, sf_dir):
    return bt.batch_rows(documents(spark, sf_dir, "doc_id"), "doc_id", 32, shuffle_seed=SEED, drop_last=True)


def _pairs(spark, sf_dir) -> DataFrame:
    full = turn_pairs(spark, sf_dir).filter(F.col("en").isNotNull() & F.col("fr").isNotNull())
    return full.withColumn("pair_id", F.col("conv_id") * 1000 + F.col("turn"))


def _templated(spark, sf_dir) -> DataFrame:
    ids = tk.pair_template(
        tk.text_bytes(F.col("en")),
        tk.text_bytes(F.col("fr")),
        tk.BYTE_BOS,
        EN_OPEN,
        EN_CLOSE,
        FR_OPEN,
        FR_CLOSE,
        tk.BYTE_EOS,
    )
    return _pairs(spark, sf_dir).select("pair_id", ids.alias("ids"))


def _padded(spark, sf_dir) -> DataFrame:
    return bt.with_batch_width(bt.batch_rows(_templated(spark, sf_dir), "pair_id", 8), "batch", "ids")


TEMPLATE_SQL = f"""
m AS (SELECT conv_id * 1000 + turn AS pair_id, list_concat([256, {EN_OPEN}], {sql_bytes('en')}, [{EN_CLOSE}, {FR_OPEN}], {sql_bytes('fr')}, [{FR_CLOSE}, 257]) AS ids
      FROM ({PAIRS_SQL}) WHERE en IS NOT NULL AND fr IS NOT NULL),
b AS (SELECT pair_id, ids, (row_number() OVER (ORDER BY pair_id) - 1) // 8 AS batch FROM m),
z AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS width FROM b)"""


@register(
    "pair_template",
    f"WITH {TEMPLATE_SQL} SELECT pair_id, CAST(len(ids) AS INT) AS n_tokens, {sql_checksum('ids')} AS check_sum FROM m",
)
def pair_template(spark, sf_dir):
    ids = F.col("ids")
    return _templated(spark, sf_dir).select("pair_id", F.size(ids).alias("n_tokens"), checksum(ids).alias("check_sum"))


@register(
    "pad_and_mask",
    f"""WITH {TEMPLATE_SQL} SELECT pair_id, batch, CAST(width AS INT) AS width, CAST(len(ids) AS BIGINT) AS mask_sum,
          {sql_checksum(f'list_concat(ids, list_transform(range(width - len(ids)), lambda k: {PAD}))')} AS check_sum FROM z""",
)
def pad_and_mask(spark, sf_dir):
    padded = tk.pad_right(F.col("ids"), F.col("width"), PAD)
    rows = _padded(spark, sf_dir).select("pair_id", "batch", "width", padded.alias("p"))
    mask = tk.attention_mask(F.col("p"), PAD)
    return rows.select("pair_id", "batch", "width", array_sum(mask).alias("mask_sum"), checksum(F.col("p")).alias("check_sum"))


@register(
    "next_token_labels",
    f"""WITH {TEMPLATE_SQL} SELECT pair_id, batch, CAST(width AS INT) AS n_labels,
          {sql_checksum(f'list_concat(ids[2:], [{PAD}], list_transform(range(width - len(ids)), lambda k: -100))')} AS check_sum FROM z""",
)
def next_token_labels(spark, sf_dir):
    labels = tk.next_token_labels(F.col("ids"), F.col("width"), PAD)
    rows = _padded(spark, sf_dir).select("pair_id", "batch", labels.alias("y"))
    return rows.select("pair_id", "batch", F.size("y").alias("n_labels"), checksum(F.col("y")).alias("check_sum"))
