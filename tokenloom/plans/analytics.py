"""Evaluation and run analytics queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.functions import arrays as ar
from tokenloom.functions import tokens as tk
from tokenloom.functions import vectors as vc
from tokenloom.functions.hashing import md5_uniform
from tokenloom.operators import batching as bt
from tokenloom.operators import evaluation as ev
from tokenloom.operators import profiling as pf
from tokenloom.operators import runs as rn
from tokenloom.operators import sampling as sp
from tokenloom.operators import vocab as vb
from tokenloom.plans.catalog import register, sql_bytes, sql_uniform, table
from tokenloom.plans.corpus import SEED, documents, heavy_documents, metric_rows

V = "list_transform(embedding, lambda x: x::DOUBLE)"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as logits; every fifth label is the ignored one."""
    gold = F.when(F.col("vec_id") % 5 == 0, tk.IGNORE_LABEL).otherwise(F.col("label")).cast("int")
    return vectors(spark, sf_dir).select("vec_id", F.col("embedding").alias("logits"), gold.alias("gold"))


def vector_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select("label", F.explode("embedding").alias("x")).select(
        "label", F.col("x").cast("double")
    )


VALUES_SQL = "SELECT label, unnest(embedding)::DOUBLE AS x FROM embeddings"
GOLD_SQL = f"SELECT vec_id, {V} AS v, CASE WHEN vec_id % 5 = 0 THEN -100 ELSE label END AS gold FROM embeddings"


# ---- scores of texts ---------------------------------------------------------------


def byte_scores(spark: SparkSession, sf_dir: str) -> tuple[dict[int, float], int]:
    """Log frequency of each byte value, and the most frequent byte (at most 256 rows)."""
    counts = vb.byte_counts(heavy_documents(spark, sf_dir, "text"), F.col("text")).select(F.col("byte").alias("b"), F.col("cnt").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    rows = counts.select("b", "n", F.log(F.col("n") / total).alias("ll")).collect()
    top = min(rows, key=lambda r: (-r["n"], r["b"]))["b"]
    return {r["b"]: r["ll"] for r in rows}, top


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_, top = byte_scores(spark, sf_dir)
    docs = heavy_documents(spark, sf_dir, "doc_id", "lang", "source", "text").withColumn("b", tk.text_bytes(F.col("text")))
    return docs.select(
        "doc_id",
        F.concat_ws("/", "lang", "source").alias("path"),
        "text",
        ev.lookup_scores(F.col("b"), table_).alias("ll"),
        F.transform("b", lambda x: x == top).alias("greedy"),
    )


SCORES_SQL = f"""
raw AS (SELECT doc_id, lang || '/' || source AS path, text, {sql_bytes('text')} AS b FROM documents),
tok AS (SELECT doc_id, path, text, len(b) AS n, generate_subscripts(b, 1) AS p, unnest(b) AS byte FROM raw),
freq AS (SELECT byte, count(*) AS c FROM tok GROUP BY byte),
logf AS (SELECT byte, ln(c / (SELECT sum(c) FROM freq)) AS ll, byte = (SELECT byte FROM freq ORDER BY c DESC, byte LIMIT 1) AS greedy FROM freq),
scored AS (SELECT doc_id, path, text, n, p, ll, greedy FROM tok JOIN logf USING (byte))"""


@register(
    "validation_nll_metrics",
    f"""WITH {SCORES_SQL},
        d AS (SELECT doc_id, path, sum(ll) AS s, any_value(n) AS n, any_value(length(text)) AS c FROM scored GROUP BY doc_id, path),
        m AS (SELECT path, avg(s) AS nll, avg(s / n) AS nll_per_token, avg(s / c) AS nll_per_char, avg(n) AS avg_seqlen FROM d GROUP BY path),
        k AS (SELECT *, string_split(path, '/')[2] AS base, row_number() OVER (PARTITION BY string_split(path, '/')[2] ORDER BY path) - 1 AS again FROM m)
        SELECT path, CASE WHEN again = 0 THEN base ELSE base || '_' || again END AS name, round(nll, 3) AS nll,
               round(nll_per_token, 6) AS nll_per_token, round(nll_per_char, 6) AS nll_per_char, round(avg_seqlen, 6) AS avg_seqlen FROM k""",
)
def validation_nll_metrics(spark, sf_dir):
    out = ev.validation_metrics(scored_documents(spark, sf_dir), "path", "ll", "text")
    return rounded(out.withColumn("nll", F.round("nll", 3)))


@register(
    "continuation_loglik",
    f"""WITH {SCORES_SQL}
        SELECT doc_id, round(sum(ll) FILTER (p > n // 2), 3) AS continuation, round(sum(ll), 3) AS whole,
               bool_and(greedy) FILTER (p > n // 2) AS is_greedy FROM scored GROUP BY doc_id""",
)
def continuation_loglik(spark, sf_dir):
    """The first half of each text is the prompt."""
    half = F.floor(F.size("ll") / 2).cast("int")
    return scored_documents(spark, sf_dir).select(
        "doc_id",
        F.round(vc.continuation_score(F.col("ll"), half), 3).alias("continuation"),
        F.round(ar.array_sum(F.col("ll"), "double"), 3).alias("whole"),
        vc.continuation_greedy(F.col("greedy"), half).alias("is_greedy"),
    )


@register(
    "uniform_args_check",
    "SELECT source, count(DISTINCT lang) = 1 AS is_uniform FROM documents GROUP BY source",
)
def uniform_args_check(spark, sf_dir):
    return ev.uniform_args(documents(spark, sf_dir, "source", "lang"), "source", F.struct("lang"))


# ---- predictions -----------------------------------------------------------------------


@register(
    "masked_accuracy",
    f"""SELECT count(*) FILTER (gold <> -100 AND list_position(v, list_max(v)) - 1 = gold) AS n_correct,
               count(*) FILTER (gold <> -100) AS n_word FROM ({GOLD_SQL})""",
)
def masked_accuracy(spark, sf_dir):
    return ev.masked_accuracy(labelled(spark, sf_dir), "logits", "gold")


@register(
    "masked_cross_entropy",
    f"""SELECT round(avg(list_max(v) + ln(list_sum(list_transform(v, lambda x: exp(x - list_max(v))))) - v[gold + 1]), 6) AS loss, count(*) AS n
        FROM ({GOLD_SQL}) WHERE gold <> -100""",
)
def masked_cross_entropy(spark, sf_dir):
    return rounded(ev.masked_cross_entropy(labelled(spark, sf_dir), "logits", "gold"))


@register(
    "mean_loss_first_n_batches",
    """SELECT round(avg(loss), 6) AS mean_loss, count(*) AS n_batches FROM (
         SELECT avg(value) AS loss FROM (SELECT value, (row_number() OVER (ORDER BY event_id) - 1) // 64 AS batch FROM events)
         WHERE batch < 100 GROUP BY batch)""",
)
def mean_loss_first_n_batches(spark, sf_dir):
    rows = bt.batch_rows(table(spark, sf_dir, "events").select("event_id", "value"), "event_id", 64)
    return rounded(ev.mean_loss(rows, "batch", "value", 100))


@register(
    "epoch_loss_per_word",
    """SELECT strftime(ts, '%Y-%m-%d') AS epoch, round(sum(value) / sum(k), 6) AS loss_per_word,
              round(sum(CASE WHEN value < 20 THEN k ELSE 0 END) / sum(k), 6) AS accuracy
       FROM (SELECT ts, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY epoch""",
)
def epoch_loss_per_word(spark, sf_dir):
    """Days as epochs; k words per log line, all of them right when the loss is small."""
    k = F.from_json("props", "k bigint")["k"]
    rows = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("epoch"),
        F.col("value").alias("loss"),
        k.alias("words"),
        F.when(F.col("value") < 20, k).otherwise(0).alias("correct"),
    )
    return rounded(ev.epoch_ratios(rows, "epoch", "loss", "correct", "words"))


SOFT_SQL = f"""
z AS (SELECT vec_id, list_transform({V}, lambda x: x / 0.7) AS s FROM embeddings),
e AS (SELECT vec_id, list_transform(s, lambda x: exp(x - list_max(s))) AS e FROM z),
soft AS (SELECT vec_id, list_transform(e, lambda x: x / list_sum(e)) AS p FROM e),
items AS (SELECT vec_id, generate_subscripts(p, 1) - 1 AS item, unnest(p) AS p FROM soft)"""


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select("vec_id", ar.softmax(F.col("embedding"), 0.7).alias("p"))


def _exploded(rows: DataFrame, items) -> DataFrame:
    return rows.select("vec_id", F.explode(items).alias("x")).select("vec_id", "x.item", "x.p_norm")


@register(
    "softmax_temperature",
    f"""WITH {SOFT_SQL} SELECT vec_id, CAST(list_position(p, list_max(p)) - 1 AS INT) AS best, round(list_max(p), 6) AS p_best,
               round(list_sum(p), 6) AS total FROM soft""",
)
def softmax_temperature(spark, sf_dir):
    rows = vectors(spark, sf_dir).select(
        "vec_id", "embedding", ar.softmax(F.col("embedding"), 0.7).alias("p")
    )
    return rounded(
        rows.select(
            "vec_id",
            ar.argmax(F.col("embedding")).cast("int").alias("best"),
            F.array_max("p").alias("p_best"),
            ar.array_sum(F.col("p"), "double").alias("total"),
        )
    )


@register(
    "softmax_entropy",
    f"""WITH {SOFT_SQL} SELECT vec_id, round(-sum(CASE WHEN p = 0 THEN 0 ELSE p * ln(p) END), 6) AS entropy FROM items GROUP BY vec_id""",
)
def softmax_entropy(spark, sf_dir):
    entropy = ar.entropy(ar.softmax(F.col("embedding"), 0.7))
    return vectors(spark, sf_dir).select("vec_id", F.round(entropy, 6).alias("entropy"))


@register(
    "nucleus_select",
    f"""WITH {SOFT_SQL}, c AS (SELECT vec_id, item, p, sum(p) OVER (PARTITION BY vec_id ORDER BY p DESC, item ROWS UNBOUNDED PRECEDING) - p AS before FROM items),
        k AS (SELECT vec_id, item, p FROM c WHERE before <= 0.4)
        SELECT vec_id, CAST(item AS INT) AS item, round(p / sum(p) OVER (PARTITION BY vec_id), 6) AS p_norm FROM k""",
)
def nucleus_select(spark, sf_dir):
    return rounded(_exploded(probabilities(spark, sf_dir), sp.nucleus_select(F.col("p"), 0.4)))


@register(
    "topk_with_ties",
    f"""WITH {SOFT_SQL}, k AS (SELECT vec_id, item, p FROM (SELECT *, rank() OVER (PARTITION BY vec_id ORDER BY p DESC) AS r FROM items) WHERE r <= 5)
        SELECT vec_id, CAST(item AS INT) AS item, round(p / sum(p) OVER (PARTITION BY vec_id), 6) AS p_norm FROM k""",
)
def topk_with_ties(spark, sf_dir):
    return rounded(_exploded(probabilities(spark, sf_dir), sp.topk_with_ties(F.col("p"), 5)))


@register(
    "categorical_draw",
    f"""WITH {SOFT_SQL}, t AS (SELECT vec_id, item, p FROM (SELECT *, rank() OVER (PARTITION BY vec_id ORDER BY p DESC) AS r FROM items) WHERE r <= 5),
        c AS (SELECT vec_id, item, sum(p) OVER (PARTITION BY vec_id ORDER BY p DESC, item ROWS UNBOUNDED PRECEDING) AS upto,
                     sum(p) OVER (PARTITION BY vec_id) AS total FROM t)
        SELECT vec_id, CAST(arg_min(item, upto) AS INT) AS item FROM c WHERE upto > {sql_uniform(SEED, 'vec_id')} * total GROUP BY vec_id""",
)
def categorical_draw(spark, sf_dir):
    drawn = sp.categorical_draw(sp.at_least_kth(F.col("p"), 5), md5_uniform(SEED, F.col("vec_id")))
    return probabilities(spark, sf_dir).select("vec_id", drawn.alias("item"))


# ---- profiles ---------------------------------------------------------------------------


def named_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.explode(
            F.array(
                F.struct(F.lit("l_extendedprice").alias("name"), F.col("l_extendedprice").alias("x")),
                F.struct(F.lit("l_discount").alias("name"), F.col("l_discount").alias("x")),
            )
        ).alias("v")
    )
    chars = documents(spark, sf_dir, "n_chars").select(F.lit("n_chars").alias("name"), F.col("n_chars").cast("double").alias("x"))
    return lines.select("v.name", "v.x").unionByName(chars)


@register(
    "profile_numeric_column",
    f"""WITH v AS (SELECT 'l_extendedprice' AS name, l_extendedprice AS x FROM lineitem
              UNION ALL SELECT 'l_discount', l_discount FROM lineitem UNION ALL SELECT 'n_chars', n_chars::DOUBLE FROM documents),
        b AS (SELECT name, count(*)::DOUBLE AS n, avg(x) AS m, stddev_samp(x) AS s, avg(abs(x)) AS a, max(x) AS hi, min(x) AS lo,
                     quantile_cont(x, [{', '.join(f'{q:.7f}' for q in pf.QUANTILES)}]) AS q FROM v GROUP BY name),
        h AS (SELECT name, avg(((x - m) / s) ** 3) AS sk, avg(((x - m) / s) ** 4) AS ku FROM v JOIN b USING (name) GROUP BY name)
        SELECT name, stat, round(value, 5) AS value FROM (
          SELECT name, 'count' AS stat, n AS value FROM b UNION ALL SELECT name, 'mean', m FROM b UNION ALL SELECT name, 'std', s FROM b
          UNION ALL SELECT name, 'skew', sk FROM h UNION ALL SELECT name, 'kurtosis', ku FROM h
          UNION ALL SELECT name, 'abs_mean', a FROM b UNION ALL SELECT name, 'max', hi FROM b UNION ALL SELECT name, 'min', lo FROM b
          UNION ALL SELECT name, 'q' || k, value FROM (
            SELECT name, unnest([{', '.join(f"'{q:.7f}'" for q in pf.QUANTILES)}]) AS k, unnest(q) AS value FROM b))""",
)
def profile_numeric_column(spark, sf_dir):
    out = pf.profile(named_values(spark, sf_dir), "name", "x")
    share = F.format_string("q%.7f", F.expr("try_cast(substring(stat, 2) AS DOUBLE)"))
    return out.select(
        "name",
        F.when(F.col("stat").rlike("^q[0-9]"), share).otherwise(F.col("stat")).alias("stat"),
        F.round("value", 5).alias("value"),
    )


@register(
    "layer_init_stats",
    f"""SELECT label, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max,
               round(avg(CASE WHEN abs(x) < 1e-6 THEN 1 ELSE 0 END), 6) AS near_zero FROM ({VALUES_SQL}) GROUP BY label""",
)
def layer_init_stats(spark, sf_dir):
    return rounded(pf.init_stats(vector_values(spark, sf_dir), "label", "x"))


@register(
    "value_range_checks",
    f"""SELECT label, count(x) = 0 AS is_empty, bool_or(isnan(x) OR isinf(x)) AS not_finite, max(x) - min(x) > 0.9 AS wide_range,
               stddev_samp(x) > 0.125 AS large_std, max(abs(x)) = 0 AS all_zero FROM ({VALUES_SQL}) GROUP BY label""",
)
def value_range_checks(spark, sf_dir):
    return pf.range_checks(vector_values(spark, sf_dir), "label", "x", 0.9, 0.125)


@register(
    "zero_row_check",
    "SELECT vec_id, len(list_filter(embedding, lambda x: abs(x) > 1e-8)) = 0 AS is_zero FROM embeddings",
)
def zero_row_check(spark, sf_dir):
    return vectors(spark, sf_dir).select("vec_id", vc.all_near_zero(F.col("embedding")).alias("is_zero"))


@register(
    "group_variance_nan",
    f"SELECT label, round(var_samp(x), 8) AS variance, bool_or(isnan(x)) AS has_nan FROM ({VALUES_SQL}) GROUP BY label",
)
def group_variance_nan(spark, sf_dir):
    return rounded(pf.variance_and_nan(vector_values(spark, sf_dir), "label", "x"), 8)


@register(
    "rank_mean_max",
    """SELECT metric, round(avg(m), 6) AS mean, max(x) AS max FROM (
         SELECT event_type AS metric, user_id % 8 AS rank, avg(value) AS m, max(value) AS x FROM events GROUP BY ALL) GROUP BY metric""",
)
def rank_mean_max(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric"), (F.col("user_id") % 8).alias("rank"), "value"
    )
    return rounded(pf.rank_mean_max(rows, "metric", "rank", "value"))


# ---- runs and snapshots ----------------------------------------------------------------------


@register(
    "running_best_and_save_flag",
    """SELECT event_id, user_id, value, best AS best_before, (event_type = 'error' OR event_id % 50 = 0 OR coalesce(value < best, true)) AS saved
       FROM (SELECT *, min(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM events)""",
)
def running_best_and_save_flag(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    out = rn.running_best(rows, "user_id", "event_id", "value", 50, F.col("event_type") == "error")
    return out.drop("event_type")


FLOPS = rn.flops_per_token(params=1_000_000, n_layers=6, dim=512, seq_len=1024)


@register(
    "throughput_between_logs",
    f"""WITH l AS (SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS words, ts,
                     lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS t0, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS s0 FROM events),
        r AS (SELECT *, (epoch_us(ts) - epoch_us(t0)) / 1e6 AS seconds, event_id - s0 AS steps FROM l)
        SELECT event_id, user_id, words, seconds, steps,
               CASE WHEN seconds > 0 THEN round(steps / seconds, 6) END AS steps_per_second,
               CASE WHEN seconds > 0 THEN round(words / seconds, 6) END AS wps,
               CASE WHEN seconds > 0 THEN round(words / seconds * {float(FLOPS)!r} / 1e9, 5) END AS gflops FROM r""",
)
def throughput_between_logs(spark, sf_dir):
    k = F.from_json("props", "k bigint")["k"].alias("words")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", k, "ts")
    out = rn.throughput(rows, "user_id", "event_id", "ts", "words", FLOPS)
    return out.select(
        "event_id",
        "user_id",
        "words",
        "seconds",
        "steps",
        F.round("steps_per_second", 6).alias("steps_per_second"),
        F.round("wps", 6).alias("wps"),
        F.round(F.col("flops") / 1e9, 5).alias("gflops"),
    )


@register(
    "every_n_steps",
    """SELECT event_id, k FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
       WHERE event_id % 10 = 0 AND k % 4 = 0""",
)
def every_n_steps(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))
    return rows.filter(bt.every_n_steps(F.col("event_id"), 10, F.col("k"), acc_freq=4))


@register(
    "filter_eval_metric_keys",
    """SELECT event_id AS global_step, 'evals/loss.out' AS name, value FROM events
       UNION ALL SELECT event_id, 'evals/speed.k', CAST(json_extract(props, '$.k') AS DOUBLE) FROM events""",
)
def filter_eval_metric_keys(spark, sf_dir):
    return rn.metric_entries(metric_rows(spark, sf_dir), "global_step")


@register(
    "flatten_nested",
    """SELECT event_id AS global_step, value AS "loss/out", user_id AS "speed/run", CAST(json_extract(props, '$.k') AS BIGINT) AS "speed/props/k" FROM events""",
)
def flatten_nested(spark, sf_dir):
    nested = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("global_step"),
        F.struct(F.col("value").alias("out")).alias("loss"),
        F.struct(F.col("user_id").alias("run"), F.from_json("props", "k bigint").alias("props")).alias("speed"),
    )
    return vc.flatten_struct(nested, "/")


MANIFEST_SQL = """
m AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'eval_' ELSE 'checkpoint_' END || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS path,
             o_orderstatus <> 'P' AS has_state, CAST(o_orderkey AS BIGINT) AS step,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 'eval' ELSE 'checkpoint' END AS kind FROM orders),
kept AS (SELECT path, kind, step FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY step DESC) AS r FROM m)
         WHERE r <= CASE kind WHEN 'eval' THEN 5 ELSE 10 END)"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot folders named after the orders."""
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "eval").otherwise("checkpoint")
    return table(spark, sf_dir, "orders").select(
        F.format_string("%s_%010d", kind, F.col("o_orderkey")).alias("path"),
        (F.col("o_orderstatus") != "P").alias("has_state"),
    )


@register(
    "latest_snapshot_with_state",
    f"WITH {MANIFEST_SQL} SELECT path, step FROM m WHERE has_state ORDER BY step DESC LIMIT 1",
)
def latest_snapshot_with_state(spark, sf_dir):
    return rn.latest_with_state(manifest(spark, sf_dir))


LIMITS = {"checkpoint": 10, "eval": 5}


@register("retain_last_n_per_kind", f"WITH {MANIFEST_SQL} SELECT path, kind, step FROM kept")
def retain_last_n_per_kind(spark, sf_dir):
    return rn.retained(manifest(spark, sf_dir), LIMITS).drop("has_state")


@register("snapshots_to_remove", f"WITH {MANIFEST_SQL} SELECT path FROM m WHERE path NOT IN (SELECT path FROM kept)")
def snapshots_to_remove(spark, sf_dir):
    folders = manifest(spark, sf_dir)
    return rn.to_remove(folders, rn.retained(folders, LIMITS))
