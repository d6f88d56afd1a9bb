"""Vocabulary queries: pre-tokens, alphabets, byte-pair and unigram training, encoding, slots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import bytechars as bc
from tokenloom.functions import text as tx
from tokenloom.functions import tokens as tk
from tokenloom.functions.arrays import checksum
from tokenloom.operators import batching as bt
from tokenloom.operators import bpe
from tokenloom.operators import unigram
from tokenloom.operators import vocab as vb
from tokenloom.operators.rank_files import rank_tokens, read_ranks
from tokenloom.operators.registry import build_tokenizer
from tokenloom.operators.ordering import spread
from tokenloom.plans.catalog import register, sql_checksum, table
from tokenloom.plans.corpus import documents, heavy_documents
from tokenloom.session import scan_partitions, scratch_path
from tokenloom.sources import readers, writers

N_MERGES = 64
UNIGRAM_PIECES = 32_000
LONGEST_LINE = 64_000  # bytes; longer lines of the training files are left out
WHITE = tx.WHITE

# The pre-token pattern for an engine without look-ahead.  A mark is put before the
# last white-space character of a run that a word or sign follows; a run then ends
# at the mark, which is what the look-ahead says.  The mark itself is in no class.
_W = "\\t-\\r\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_MARKED_PATTERN = "|".join(
    [
        "[^\\r\\n\\p{L}\\p{N}\\x01]?[\\p{Lu}\\p{Lt}\\p{Lm}\\p{Lo}\\p{M}]*[\\p{Ll}\\p{Lm}\\p{Lo}\\p{M}]+(?i:''s|''t|''re|''ve|''m|''ll|''d)?",
        "[^\\r\\n\\p{L}\\p{N}\\x01]?[\\p{Lu}\\p{Lt}\\p{Lm}\\p{Lo}\\p{M}]+[\\p{Ll}\\p{Lm}\\p{Lo}\\p{M}]*(?i:''s|''t|''re|''ve|''m|''ll|''d)?",
        "\\p{N}{1,3}",
        f" ?[^{_W}\\p{{L}}\\p{{N}}\\x01]+[\\r\\n/]*",
        f"[{_W}]*[\\r\\n]+",
        f"[{_W}]+",
    ]
)
_LAST_SPACE = _W.replace("\\t-\\r", "\\t\\x0b\\x0c")


def sql_pretokens(text: str) -> str:
    marked = f"regexp_replace({text}, '([{_LAST_SPACE}])([^{_W}])', chr(1) || '\\1\\2', 'g')"
    return f"regexp_extract_all({marked}, '{_MARKED_PATTERN}')"


def sql_words(source: str = "documents") -> str:
    return f"SELECT word, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, '[^{WHITE}]+')) AS word FROM {source}) GROUP BY word"


def space_words(df: DataFrame) -> DataFrame:
    """Distinct words between white space."""
    return vb.word_counts(df, F.regexp_extract_all("text", F.lit(f"[^{WHITE}]+"), F.lit(0)))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy_documents(spark, sf_dir, "text")


def sql_quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_symbols(symbols: str) -> str:
    """A list of symbols as one string, each symbol between two marks that no text here holds."""
    return f"array_to_string(list_transform({symbols}, lambda c: chr(1) || c || chr(1)), '')"


def sql_parts(sym: str) -> str:
    return f"string_split(trim({sym}, chr(1)), chr(1) || chr(1))"


def sql_training(start: str, steps: int) -> str:
    """Tables ``t`` (the words after every step) and ``m`` (the merges), one merge at a time from ``start(word, cnt, sym)``."""
    return f"""t AS (SELECT 0 AS step, word, cnt, sym, '' AS l, '' AS r FROM ({start})
      UNION ALL
      SELECT step + 1, word, cnt, replace(sym, chr(1) || b.l || chr(1) || chr(1) || b.r || chr(1), chr(1) || b.l || b.r || chr(1)), b.l, b.r
      FROM t, (SELECT p[1] AS l, p[2] AS r, sum(cnt) AS n FROM (
          SELECT cnt, unnest(list_zip(s[:-2], s[2:])) AS p FROM (SELECT cnt, {sql_parts('sym')} AS s FROM t) WHERE len(s) > 1)
        GROUP BY ALL ORDER BY n DESC, l, r LIMIT 1) b
      WHERE step < {steps}),
    m AS (SELECT DISTINCT CAST(step - 1 AS INT) AS rank, l, r FROM t WHERE step > 0)"""


_BYTE_CHARS = "[" + ", ".join(sql_quoted(c) for c in bc.byte_chars()) + "]"


def sql_shown(text: str) -> str:
    """List of the printable characters of a text's bytes."""
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: {_BYTE_CHARS}[('0x' || h)::INT + 1])"


# Merges over the documents' bytes, the pieces in id order and the parts of every word.
_BYTE_TRAINING = f"""w AS (SELECT word, count(*) AS cnt FROM (SELECT unnest({sql_pretokens('text')}) AS word FROM documents) GROUP BY word),
    {sql_training(f"SELECT word, cnt, {sql_symbols(sql_shown('word'))} AS sym FROM w", N_MERGES)},
    pieces AS (SELECT piece, CAST(row_number() OVER (ORDER BY ord) - 1 AS INT) AS id FROM (
      SELECT piece, min(ord) AS ord FROM (
        SELECT unnest({_BYTE_CHARS}) AS piece, generate_subscripts({_BYTE_CHARS}, 1) AS ord UNION ALL SELECT l || r, 257 + rank FROM m)
      GROUP BY piece)),
    ids AS (SELECT map(list(piece), list(id)) AS id_of FROM pieces),
    coded AS (SELECT word, list_transform({sql_parts('sym')}, lambda p: id_of[p]) AS c FROM t, ids WHERE step = (SELECT max(step) FROM t))"""
_ENCODED_SQL = f"""WITH RECURSIVE {_BYTE_TRAINING},
    placed AS (SELECT doc_id, generate_subscripts(p, 1) AS pos, unnest(p) AS word FROM (SELECT doc_id, {sql_pretokens('text')} AS p FROM documents)),
    whole AS (SELECT doc_id, flatten(list(c ORDER BY pos)) AS c FROM placed JOIN coded USING (word) GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(len(c), 0) AS INT) AS n_tokens, coalesce({sql_checksum('c')}, 0) AS check_sum
    FROM documents LEFT JOIN whole USING (doc_id)"""

def byte_merges(spark: SparkSession, sf_dir: str) -> list:
    """Byte-level merges trained on the documents."""
    words = vb.word_counts(texts(spark, sf_dir), tx.pretokens(F.col("text")))
    state = words.select(bpe.initial_symbols(bc.to_byte_chars(F.col("word"))).alias("symbols"), "cnt")
    return bpe.train_merges(state, N_MERGES)


# ---- pre-tokens and normalisation -----------------------------------------------


@register(
    "pretokenize",
    f"""SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS INT) AS pos, unnest(p) AS token
        FROM (SELECT doc_id, {sql_pretokens('text')} AS p FROM documents)""",
)
def pretokenize(spark, sf_dir):
    return heavy_documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", F.posexplode(tx.pretokens(F.col("text"))).alias("pos", "token")
    )


@register(
    "word_frequencies",
    f"SELECT word, count(*) AS cnt FROM (SELECT unnest({sql_pretokens('text')}) AS word FROM documents) GROUP BY word",
)
def word_frequencies(spark, sf_dir):
    return vb.word_counts(texts(spark, sf_dir), tx.pretokens(F.col("text")))


def _sql_byte_char(b: str) -> str:
    plain = " OR ".join(f"{b} BETWEEN {low} AND {high}" for low, high in bc.PLAIN_RANGES)
    moved = [b for b in range(256) if not any(low <= b <= high for low, high in bc.PLAIN_RANGES)]
    return f"CASE WHEN {plain} THEN chr(CAST({b} AS INT)) ELSE chr(CAST(255 + list_position({moved}, {b}) AS INT)) END"


@register(
    "byte_unicode_map",
    f"""WITH b AS (SELECT ('0x' || unnest(regexp_extract_all(hex(encode(text)), '..')))::INT AS byte FROM documents)
        SELECT byte, {_sql_byte_char('byte')} AS shown, count(*) AS n FROM b GROUP BY byte""",
)
def byte_unicode_map(spark, sf_dir):
    """Printable character of every byte the corpus uses, and how often it occurs."""
    counts = vb.byte_counts(texts(spark, sf_dir), F.col("text"))
    shown = F.get(F.array(*[F.lit(c) for c in bc.byte_chars()]), F.col("byte"))
    return counts.select("byte", shown.alias("shown"), F.col("cnt").alias("n"))


@register(
    "normalize_for_vocab",
    f"""SELECT doc_id, '▁' || replace(regexp_replace(regexp_replace(text, '[{WHITE}]+', ' ', 'g'), '^ | \\z', '', 'g'), ' ', '▁') AS text
        FROM documents""",
)
def normalize_for_vocab(spark, sf_dir):
    return heavy_documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", tx.normalize_for_vocab(F.col("text")).alias("text")
    )


SPECIALS = ["<p>", "</p>", "<li>", "</li>", "<article>"]
_SPECIAL_SQL = "|".join(SPECIALS)


@register(
    "split_special_tokens",
    f"""WITH parts AS (SELECT page_id, generate_subscripts(p, 1) AS part_no, unnest(p) AS part FROM (
            SELECT page_id, string_split(regexp_replace(html, '({_SPECIAL_SQL})', chr(2) || '\\1' || chr(2), 'g'), chr(2)) AS p FROM pages)),
        t AS (SELECT page_id, part_no, CASE WHEN part IN ({', '.join(f"'{s}'" for s in SPECIALS)}) THEN [part]
                     ELSE {sql_pretokens('part')} END AS tokens FROM parts),
        u AS (SELECT page_id, part_no, generate_subscripts(tokens, 1) AS k, unnest(tokens) AS token FROM t)
        SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY part_no, k) - 1 AS INT) AS pos, token FROM u""",
)
def split_special_tokens(spark, sf_dir):
    tokens = tx.split_specials(F.col("html"), SPECIALS)
    return spread(table(spark, sf_dir, "pages"), scan_partitions(spark)).select("page_id", F.posexplode(tokens).alias("pos", "token"))


# ---- alphabets and frequency vocabularies --------------------------------------------

_CHARS = "SELECT ch, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS ch FROM documents) GROUP BY ch"


@register(
    "char_coverage_alphabet",
    f"""SELECT ch, cnt FROM (SELECT ch, cnt, sum(cnt) OVER (ORDER BY cnt DESC, ch ROWS UNBOUNDED PRECEDING) - cnt AS before,
               sum(cnt) OVER () AS total FROM ({_CHARS})) WHERE before < 0.995 * total""",
)
def char_coverage_alphabet(spark, sf_dir):
    return vb.coverage_alphabet(vb.char_counts(texts(spark, sf_dir), F.col("text")), 0.995)


@register(
    "word_char_vocab",
    f"""SELECT 'char' AS kind, ch AS piece, id, cnt FROM (SELECT ch, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, ch) - 1 AS INT) AS id FROM ({_CHARS})) WHERE id < 40
        UNION ALL
        SELECT 'word', word, id, cnt FROM (SELECT word, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 AS INT) AS id FROM ({sql_words()})) WHERE id < 500""",
)
def word_char_vocab(spark, sf_dir):
    """The two plain model types: most frequent characters and most frequent words."""
    docs = texts(spark, sf_dir)
    chars = vb.top_pieces(vb.char_counts(docs, F.col("text")), "ch", 40).withColumn("kind", F.lit("char"))
    words = vb.top_pieces(space_words(docs), "word", 500).withColumn("kind", F.lit("word"))
    return chars.unionByName(words)


_PAIRS = f"""
c AS (SELECT word, cnt, regexp_extract_all(word, '(?s).') AS s FROM ({sql_words()})),
e AS (SELECT word, cnt, unnest(list_zip(s[:-2], s[2:])) AS p FROM c WHERE len(s) > 1),
pairs AS (SELECT p[1] AS "left", p[2] AS "right", CAST(sum(cnt) AS BIGINT) AS cnt, count(DISTINCT word) AS n_words FROM e GROUP BY ALL)"""


def _char_state(spark, sf_dir) -> DataFrame:
    return space_words(texts(spark, sf_dir)).select("word", bpe.initial_symbols(F.col("word")).alias("symbols"), "cnt")


@register("bpe_pair_counts", f'WITH {_PAIRS} SELECT "left", "right", cnt, n_words FROM pairs')
def bpe_pair_counts(spark, sf_dir):
    return bpe.pair_words(_char_state(spark, sf_dir))


@register(
    "argmax_per_group",
    f'WITH {_PAIRS} SELECT "left", "right", cnt FROM pairs ORDER BY cnt DESC, "left", "right" LIMIT 1',
)
def argmax_per_group(spark, sf_dir):
    """Most frequent pair of the corpus, ties to the smaller pair."""
    return bpe.best_pair(bpe.pair_counts(_char_state(spark, sf_dir)))


# Scripts by the names that the other engine knows.
_SCRIPT_RUNS = "|".join(f"\\p{{{name}}}+" for name in tx.SCRIPTS)
_PIECE_SQL = f"▁?(?:\\p{{N}}|{_SCRIPT_RUNS}|[^▁\\p{{N}}{''.join(f'\\p{{{name}}}' for name in tx.SCRIPTS)}]+)|▁"
_LINE_TRAINING = f"""lines AS (SELECT unnest(string_split(text, chr(10))) AS text FROM documents),
    flat AS (SELECT '▁' || replace(regexp_replace(regexp_replace(text, '[{WHITE}]+', ' ', 'g'), '^ | \\z', '', 'g'), ' ', '▁') AS text
             FROM lines WHERE strlen(text) <= {LONGEST_LINE}),
    ch AS (SELECT c, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS c FROM flat) GROUP BY c),
    known AS (SELECT list(c) AS cs FROM (
      SELECT c, sum(n) OVER (ORDER BY n DESC, c ROWS UNBOUNDED PRECEDING) - n AS before, sum(n) OVER () AS total FROM ch) WHERE before < 0.9995 * total),
    w AS (SELECT word, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, '{_PIECE_SQL}')) AS word FROM flat) GROUP BY word),
    {sql_training("SELECT word, cnt, " + sql_symbols(
        "flatten(list_transform(regexp_extract_all(word, '(?s).'), lambda c: CASE WHEN list_contains(cs, c) THEN [c] "
        "ELSE list_transform(regexp_extract_all(hex(encode(c)), '..'), lambda h: '<0x' || h || '>') END))") + " AS sym FROM w, known", N_MERGES)}"""


@register("bpe_train_merges", f'WITH RECURSIVE {_LINE_TRAINING} SELECT rank, l AS "left", r AS "right" FROM m')
def bpe_train_merges(spark, sf_dir):
    """Merges over normalised, ▁-marked words; characters outside the covered alphabet fall back to bytes."""
    lines = texts(spark, sf_dir).select(F.explode(F.split("text", "\n")).alias("text"))
    docs = lines.filter(F.octet_length("text") <= LONGEST_LINE)
    alphabet = vb.coverage_alphabet(vb.char_counts(docs, tx.normalize_for_vocab(F.col("text"))), 0.9995)
    chars = [r[0] for r in alphabet.select("ch").collect()]  # bounded by the number of code points
    words = vb.word_counts(docs, tx.vocab_words(F.col("text")))
    state = words.select(bpe.initial_symbols(F.col("word"), chars).alias("symbols"), "cnt")
    return bpe.merges_frame(spark, bpe.train_merges(state, N_MERGES))


@register("unigram_vocab_em")
def unigram_vocab_em(spark, sf_dir):
    words = vb.word_counts(texts(spark, sf_dir), tx.vocab_words(F.col("text")))
    trained = unigram.train_unigram(words, UNIGRAM_PIECES)
    return trained.select("piece", F.round("score", 4).alias("score"))


# ---- encoding ---------------------------------------------------------------------


def _summary(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.size("ids").alias("n_tokens"), checksum(F.col("ids")).alias("check_sum"))


@register("bpe_encode", _ENCODED_SQL)
def bpe_encode(spark, sf_dir):
    ids = bpe.encode_text(spark, F.col("text"), byte_merges(spark, sf_dir))
    return _summary(heavy_documents(spark, sf_dir, "doc_id", "text").select("doc_id", ids.alias("ids")))


@register("tokenize_by_distinct_word", _ENCODED_SQL)
def tokenize_by_distinct_word(spark, sf_dir):
    docs = heavy_documents(spark, sf_dir, "doc_id", "text")
    return _summary(bpe.encode_by_join(docs, "doc_id", tx.pretokens(F.col("text")), byte_merges(spark, sf_dir)))


@register("bpe_detokenize", "SELECT doc_id, text FROM documents")
def bpe_detokenize(spark, sf_dir):
    """Encode, then decode: the text comes back."""
    merges = byte_merges(spark, sf_dir)
    ids = bpe.encode_text(spark, F.col("text"), merges)
    rows = heavy_documents(spark, sf_dir, "doc_id", "text").select("doc_id", ids.alias("ids"))
    return rows.select("doc_id", bpe.decode_ids(spark, F.col("ids"), merges).alias("text"))


def rank_file() -> str:
    """Path of a public vocabulary as a rank file; the operators take any other."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@register("rank_file_encode")
def rank_file_encode(spark, sf_dir):
    encode = build_tokenizer("ranks", spark, path=rank_file())
    rows = heavy_documents(spark, sf_dir, "doc_id", "text").select("doc_id", encode(F.col("text")).alias("ids"))
    return _summary(rows)


@register("rank_file_offsets")
def rank_file_offsets(spark, sf_dir):
    """Every token of every document with its start and the text it covers."""
    tokens = rank_tokens(spark, F.col("text"), read_ranks(rank_file()))
    return heavy_documents(spark, sf_dir, "doc_id", "text").select("doc_id", tokens.alias("t")).select("doc_id", "t.*")


@register(
    "encode_show_work",
    f"""WITH RECURSIVE {_BYTE_TRAINING},
        parts AS (SELECT page_id, generate_subscripts(p, 1) AS part_no, unnest(p) AS part FROM (
            SELECT page_id, string_split(regexp_replace(html, '({_SPECIAL_SQL})', chr(2) || '\\1' || chr(2), 'g'), chr(2)) AS p FROM pages)),
        cut AS (SELECT page_id, part_no, CASE WHEN part IN ({', '.join(f"'{s}'" for s in SPECIALS)}) THEN [part]
                     ELSE {sql_pretokens('part')} END AS tokens FROM parts),
        u AS (SELECT page_id, part_no, generate_subscripts(tokens, 1) AS k, unnest(tokens) AS token FROM cut),
        placed AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY part_no, k) - 1 AS INT) AS n, token FROM u),
        rules AS (SELECT list(chr(1) || l || chr(1) || chr(1) || r || chr(1) || chr(2) || chr(1) || l || r || chr(1) ORDER BY rank) AS rs FROM m),
        once AS (SELECT token, array_to_string({sql_shown('token')}, '') AS shown, {sql_parts(
            "list_reduce(list_concat([" + sql_symbols(sql_shown('token')) + "], rs), "
            "lambda s, x: replace(s, split_part(x, chr(2), 1), split_part(x, chr(2), 2)))")} AS merged
          FROM (SELECT DISTINCT token FROM placed WHERE token NOT IN ({', '.join(f"'{s}'" for s in SPECIALS)})), rules)
        SELECT page_id, n, token, coalesce(shown, token) AS shown, coalesce(array_to_string(merged, ' '), token) AS merged,
          CASE WHEN merged IS NULL THEN CAST((SELECT count(*) FROM pieces) - 1 + list_position({sorted(SPECIALS)}, token) AS VARCHAR)
               ELSE array_to_string(list_transform(merged, lambda p: CAST(id_of[p] AS VARCHAR)), ' ') END AS ids,
          merged IS NULL AS is_special
        FROM placed LEFT JOIN once USING (token), ids""",
)
def encode_show_work(spark, sf_dir):
    work = bpe.show_work_udtf(byte_merges(spark, sf_dir), SPECIALS)
    spark.udtf.register("show_work", work)
    pages = spread(table(spark, sf_dir, "pages"), scan_partitions(spark)).select("page_id", tx.split_specials(F.col("html"), SPECIALS).alias("tokens"))
    return pages.lateralJoin(work(F.col("tokens").outer())).select(
        "page_id",
        "n",
        "token",
        "shown",
        F.array_join("merged", " ").alias("merged"),
        F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"),
        "is_special",
    )


@register(
    "tokenizer_registry",
    f"""SELECT conv_id, turn, 'bytes' AS name, CAST(strlen(text) + 2 AS INT) AS n_tokens FROM conversations
        UNION ALL SELECT conv_id, turn, 'mock', CAST(strlen(text) AS INT) FROM conversations""",
)
def tokenizer_registry(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations")
    as_bytes, mock = build_tokenizer("bytes", spark), build_tokenizer("mock", spark)
    sizes = F.array(
        F.struct(F.lit("bytes").alias("name"), F.size(as_bytes(F.col("text"))).alias("n_tokens")),
        F.struct(F.lit("mock").alias("name"), F.size(mock(tk.text_bytes(F.col("text")))).alias("n_tokens")),
    )
    return talk.select("conv_id", "turn", F.explode(sizes).alias("s")).select("conv_id", "turn", "s.*")


@register(
    "recover_merges",
    f"""WITH RECURSIVE {_BYTE_TRAINING}
        SELECT id AS rank, arg_min(l, rank) AS "left", arg_min(r, rank) AS "right" FROM m JOIN pieces ON piece = l || r WHERE id > 255 GROUP BY id""",
)
def recover_merges(spark, sf_dir):
    """The pair behind every ranked token; equals the trained merges."""
    merges = byte_merges(spark, sf_dir)
    pieces = bpe.byte_vocab(merges)
    vocab = spark.createDataFrame([(p, i) for i, p in enumerate(pieces)], "piece string, rank int")
    return bpe.recover_merges(vocab, {p: i for i, p in enumerate(pieces)})


@register(
    "collate_plugin",
    """SELECT batch, count(*) AS n_rows, CAST(max(n) AS BIGINT) AS width FROM (
         SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 32 AS batch, strlen(text) + 2 AS n FROM documents) GROUP BY batch""",
)
def collate_plugin(spark, sf_dir):
    import pandas as pd

    def widest(pdf):
        return pd.DataFrame({"batch": [pdf["batch"].iloc[0]], "n_rows": [len(pdf)], "width": [pdf["n"].max()]})

    docs = documents(spark, sf_dir, "doc_id", "text").select("doc_id", tk.byte_token_count(F.col("text")).alias("n"))
    rows = bt.batch_rows(docs, "doc_id", 32)
    return bt.collate(rows, "batch", widest, "batch bigint, n_rows bigint, width bigint")


# ---- vocabulary tables ---------------------------------------------------------------

_TOP = f"""SELECT word AS piece, id FROM (SELECT word, CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 AS INT) AS id FROM ({sql_words()})) WHERE id < 2000"""


def word_vocab(spark, sf_dir) -> DataFrame:
    return vb.top_pieces(space_words(texts(spark, sf_dir)), "word", 2000).select("piece", "id")


@register(
    "piece_id_lookup",
    f"""WITH v AS ({_TOP}) SELECT word AS piece, cnt, CAST(coalesce(id, -1) AS INT) AS id FROM ({sql_words()}) LEFT JOIN v ON v.piece = word""",
)
def piece_id_lookup(spark, sf_dir):
    pieces = space_words(texts(spark, sf_dir)).withColumnRenamed("word", "piece")
    return vb.piece_ids(pieces, word_vocab(spark, sf_dir), -1)


@register(
    "vocab_overlap",
    f"""WITH a AS (SELECT DISTINCT ' ' || word AS piece FROM ({sql_words("(SELECT text FROM documents WHERE lang = 'en')")})),
            b AS (SELECT DISTINCT ' ' || word AS piece FROM ({sql_words("(SELECT text FROM documents WHERE lang = 'fr')")}))
        SELECT coalesce(a.piece, b.piece) AS piece, CASE WHEN a.piece IS NULL THEN 'right' WHEN b.piece IS NULL THEN 'left' ELSE 'both' END AS place
        FROM a FULL JOIN b ON a.piece = b.piece""",
)
def vocab_overlap(spark, sf_dir):
    """Both languages in one scan."""
    docs = heavy_documents(spark, sf_dir, "lang", "text").filter(F.col("lang").isin("en", "fr"))
    words = F.split(tx.normalize_for_vocab(F.col("text"), dummy_prefix=False), tx.SPACE_MARK)
    piece = F.concat(F.lit(" "), F.col("word"))
    rows = docs.select("lang", F.explode(words).alias("word"))
    return vb.placed(rows.select(piece.alias("piece"), (F.col("lang") == "en").alias("in_left"), (F.col("lang") == "fr").alias("in_right")))


_NUMBERS = """n AS (SELECT i + 1 AS no, lpad(CAST(i AS VARCHAR), 2, '0') AS piece FROM range(100) t(i)
      UNION ALL SELECT i + 101, lpad(CAST(i AS VARCHAR), 3, '0') FROM range(1000) t(i))"""


@register(
    "extend_vocab_numbers",
    f"""WITH v AS ({_TOP}), {_NUMBERS}
        SELECT 'vocab' AS kind, CAST(id AS BIGINT) AS n, piece FROM v WHERE piece NOT IN (SELECT piece FROM n)
        UNION ALL SELECT 'vocab', (SELECT max(id) FROM v) + no, piece FROM n
        UNION ALL SELECT 'merge', no - 1, left(piece, -1) || ' ' || right(piece, 1) FROM n""",
)
def extend_vocab_numbers(spark, sf_dir):
    """The vocabulary with the number pieces, and the merges that build them."""
    vocab = vb.extend_with_numbers(word_vocab(spark, sf_dir)).select(F.lit("vocab").alias("kind"), F.col("id").alias("n"), "piece")
    merges = vb.number_merges(spark).select(F.lit("merge").alias("kind"), (F.col("no") - 1).alias("n"), F.concat_ws(" ", "left", "right").alias("piece"))
    return vocab.unionByName(merges)


@register(
    "fill_reserved_ids",
    f"""WITH r AS (SELECT count(*) AS n FROM ({sql_words()}))
        SELECT coalesce(s.name, '<|reserved_special_token_' || i || '|>') AS name, i + r.n AS id
        FROM range(256) t(i) CROSS JOIN r LEFT JOIN (VALUES {', '.join(f"('{k}', {v})" for k, v in vb.RANK_SPECIALS.items())}) s(name, sid) ON s.sid = i""",
)
def fill_reserved_ids(spark, sf_dir):
    """Special ids behind a ranked vocabulary: here the corpus's distinct words are the ranked tokens."""
    ranked = space_words(texts(spark, sf_dir))
    return vb.reserved_specials(spark, ranked.agg(F.count(F.lit(1))).scalar())


def slot_vocab(spark, sf_dir) -> DataFrame:
    """The reserved symbols, then the corpus's most frequent words."""
    symbols = vb.symbols_frame(spark, vb.user_symbols(), vb.CONTROL_SYMBOLS)
    words = word_vocab(spark, sf_dir)
    return symbols.select(F.col("symbol").alias("piece"), F.col("ord").alias("id")).unionByName(
        words.select("piece", (F.col("id") + 10_000).alias("id"))
    )


def _sql_symbols() -> str:
    known = vb.user_symbols() + vb.CONTROL_SYMBOLS
    quoted = []
    for i, s in enumerate(known):
        text = "'" + s.replace("'", "''") + "'"
        if s[0] in "\n\t":
            text = f"repeat(chr({ord(s[0])}), {len(s)})"
        quoted.append(f"({i}, {text}, '{'user' if i < len(known) - len(vb.CONTROL_SYMBOLS) else 'control'}')")
    return f"SELECT CAST(ord AS INT) AS ord, symbol, kind FROM (VALUES {', '.join(quoted)}) t(ord, symbol, kind)"


_SLOTS = f"SELECT symbol AS piece, ord AS id FROM ({_sql_symbols()}) UNION ALL SELECT piece, id + 10000 FROM ({_TOP})"


@register(
    "filter_unused_pieces",
    f"SELECT piece, CAST(id AS INT) AS id FROM ({_SLOTS}) WHERE regexp_matches(piece, '^<unused[0-9]+>')",
)
def filter_unused_pieces(spark, sf_dir):
    return vb.unused_pieces(slot_vocab(spark, sf_dir))


NEW_SPECIALS = ["<FIL_PRE>", "<FIL_MID>", "<FIL_SUF>", "<lang_en>", "</lang_en>"]


@register(
    "assign_special_slots",
    f"""SELECT CASE piece {' '.join(f"WHEN '<unused{vb.UNUSED_SLOTS - 1 - i}>' THEN '{s}'" for i, s in enumerate(NEW_SPECIALS))} ELSE piece END AS piece,
               CAST(id AS INT) AS id, piece IN ({', '.join(f"'<unused{vb.UNUSED_SLOTS - 1 - i}>'" for i in range(len(NEW_SPECIALS)))}) AS is_special
        FROM ({_SLOTS})""",
)
def assign_special_slots(spark, sf_dir):
    return vb.assign_special_slots(slot_vocab(spark, sf_dir), NEW_SPECIALS)


SYMBOL_RUNS = "</?[a-z0-9_]+>|[0-9]+|\\n+|\\t|\\[@BOS@\\]"


@register(
    "symbols_table",
    f"""WITH s AS ({_sql_symbols()}),
        u AS (SELECT run, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, '{SYMBOL_RUNS}')) AS run FROM pages) GROUP BY run)
        SELECT ord, symbol, kind, coalesce(n, 0) AS n FROM s LEFT JOIN u ON u.run = s.symbol""",
)
def symbols_table(spark, sf_dir):
    """The symbol inventory, loaded from its YAML file, with the number of times each symbol stands in the pages."""
    runs = spread(table(spark, sf_dir, "pages"), scan_partitions(spark)).select(
        F.explode(F.regexp_extract_all("html", F.lit(SYMBOL_RUNS), F.lit(0))).alias("symbol")
    )
    used = runs.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "symbols")
    vb.write_symbols_yaml(spark, path, vb.user_symbols(), vb.CONTROL_SYMBOLS)
    return vb.symbols_from_yaml(spark, path).join(used, "symbol", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@register(
    "vocab_merges_tables",
    f"""WITH RECURSIVE {_BYTE_TRAINING}
        SELECT 'vocab' AS kind, id AS n, piece, '' AS "right" FROM pieces UNION ALL SELECT 'merge', rank, l, r FROM m""",
)
def vocab_merges_tables(spark, sf_dir):
    """A trained tokenizer written as one JSON document and read back as two tables."""
    merges = byte_merges(spark, sf_dir)
    path = scratch_path(spark, "tokenizer-file")
    vocab = spark.createDataFrame([(p, i) for i, p in enumerate(bpe.byte_vocab(merges))], "piece string, id int")
    writers.write_tokenizer_file(vocab, bpe.merges_frame(spark, merges), path)
    pieces, ranked = readers.read_tokenizer(spark, path)
    as_rows = pieces.select(F.lit("vocab").alias("kind"), F.col("id").alias("n"), "piece", F.lit("").alias("right"))
    return as_rows.unionByName(
        ranked.select(F.lit("merge").alias("kind"), F.col("rank").alias("n"), F.col("left").alias("piece"), "right")
    )


@register(
    "sink_tokenizer_artifacts",
    f"""WITH RECURSIVE {_BYTE_TRAINING}, {_NUMBERS}
        SELECT 'vocab' AS kind, CAST(id AS BIGINT) AS n, piece FROM ({_SLOTS})
        UNION ALL SELECT 'merge', rank, l || ' ' || r FROM m
        UNION ALL SELECT 'merge', (SELECT count(*) FROM m) + no - 1, left(piece, -1) || ' ' || right(piece, 1) FROM n
        UNION ALL SELECT 'config', CAST({vb.UNUSED_SLOTS - 1 - len(NEW_SPECIALS)} AS BIGINT), '{' '.join(NEW_SPECIALS)}'""",
)
def sink_tokenizer_artifacts(spark, sf_dir):
    """Vocabulary, trained merges with those of the numbers, and configuration, written and read back."""
    vocab = slot_vocab(spark, sf_dir)
    path = scratch_path(spark, "tokenizer")
    free = vb.unused_pieces(vocab).count() - 1 - len(NEW_SPECIALS)
    config = spark.createDataFrame(
        [(vocab.count(), free, NEW_SPECIALS)], "vocab_size bigint, available_unused_slots bigint, special_tokens array<string>"
    )
    trained = byte_merges(spark, sf_dir)
    numbers = vb.number_merges(spark).select((F.col("no") - 1 + len(trained)).cast("int").alias("rank"), "left", "right")
    writers.write_tokenizer(vocab, bpe.merges_frame(spark, trained).unionByName(numbers), config, path)
    back = spark.read.schema("piece string, id bigint").json(f"{path}/vocab")
    merges = spark.read.schema("rank bigint, left string, right string").json(f"{path}/merges")
    conf = spark.read.schema(config.schema).json(f"{path}/config")
    tables = back.select(F.lit("vocab").alias("kind"), F.col("id").alias("n"), "piece").unionByName(
        merges.select(F.lit("merge").alias("kind"), F.col("rank").alias("n"), F.concat_ws(" ", "left", "right").alias("piece"))
    )
    return tables.unionByName(
        conf.select(
            F.lit("config").alias("kind"),
            F.col("available_unused_slots").alias("n"),
            F.array_join("special_tokens", " ").alias("piece"),
        )
    )
