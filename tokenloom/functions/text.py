"""Text predicates and splitters.

All patterns name their character classes in full, so that they mean the same in
every regular-expression engine (and in the SQL checks).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() takes as white space.
WHITE = (
    "\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
)
# The pre-tokenizer's pattern, part by part.
PRETOKEN_PARTS = (
    r"[^\r\n\p{L}\p{N}]?[\p{Lu}\p{Lt}\p{Lm}\p{Lo}\p{M}]*[\p{Ll}\p{Lm}\p{Lo}\p{M}]+(?i:'s|'t|'re|'ve|'m|'ll|'d)?",
    r"[^\r\n\p{L}\p{N}]?[\p{Lu}\p{Lt}\p{Lm}\p{Lo}\p{M}]+[\p{Ll}\p{Lm}\p{Lo}\p{M}]*(?i:'s|'t|'re|'ve|'m|'ll|'d)?",
    r"\p{N}{1,3}",
    r" ?[^\s\p{L}\p{N}]+[\r\n/]*",
    r"\s*[\r\n]+",
    r"\s+(?!\S)",
    r"\s+",
)
# The same with Unicode white space, which Java needs to be told about.
PRETOKEN_PATTERN = "(?U)" + "|".join(PRETOKEN_PARTS)
# The pattern of tokenizers from rank files (with Unicode white space, as above).
RANK_PATTERN = (
    "(?U)"
    r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
)
WORD_PATTERN = "[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_" + WHITE + "]"
SPACE_MARK = "▁"


def is_blank(text: Column) -> Column:
    """True when nothing but white space is left."""
    return ~text.rlike(f"[^{WHITE}]")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{WHITE}]+|[{WHITE}]+\\z", "")


def text_or_content(text: Column, content: Column) -> Column:
    """``text`` where present, else ``content``; neither is an error."""
    value = F.coalesce(text, content)
    return F.when(value.isNull(), F.raise_error(F.lit("row has neither text nor content"))).otherwise(value)


def strip_markers(text: Column) -> Column:
    """Remove literal ``<s>`` and ``</s>`` in one pass; texts without them skip the regex."""
    marked = F.contains(text, F.lit("<s>")) | F.contains(text, F.lit("</s>"))
    return F.when(marked, F.regexp_replace(text, "<s>|</s>", "")).otherwise(text)


def strip_all(text: Column, stops: Sequence[str]) -> Column:
    """Delete every stop string, in the listed order."""
    for stop in stops:
        text = F.replace(text, F.lit(stop))
    return text


def ends_generation(tail: Column, stops: Sequence[str]) -> Column:
    return F.exists(F.array(*[F.lit(s) for s in stops]), lambda s: F.contains(tail, s))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_PATTERN))


def is_long_enough(sentence: Column, words: int = 5) -> Column:
    """At least ``words`` word tokens and no line break."""
    return (word_count(sentence) >= words) & ~F.contains(sentence, F.lit("\n"))


def sentences(text: Column) -> Column:
    """Stripped sentences: a cut after . ! or ? that is followed by white space."""
    return F.transform(F.split(text, "(?<=[.!?])[ \\t\\n\\r]+"), strip)


def pretokens(text: Column) -> Column:
    """Letter, number (up to three digits), punctuation and white-space runs; lossless."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), F.lit(0))


def escape_literal(value: str) -> str:
    return "".join("\\" + c if c in "\\^$.|?*+()[]{}" else c for c in value)


def split_specials(text: Column, specials: Sequence[str]) -> Column:
    """Pre-tokens with special tokens kept whole; the text after the last one included."""
    longest_first = sorted(specials, key=lambda s: (-len(s), s))
    guard = "|".join(escape_literal(s) for s in longest_first)
    parts = F.regexp_extract_all(text, F.lit(f"(?s){guard}|(?:(?!{guard}).)+"), F.lit(0))
    wanted = F.array(*[F.lit(s) for s in specials])
    return F.flatten(
        F.transform(parts, lambda p: F.when(F.array_contains(wanted, p), F.array(p)).otherwise(pretokens(p)))
    )


def normalize_for_vocab(text: Column, as_suffix: bool = False, dummy_prefix: bool = True) -> Column:
    """Collapse white space, then mark word borders with ``▁``."""
    flat = strip(F.regexp_replace(text, f"[{WHITE}]+", " "))
    marked = F.replace(flat, F.lit(" "), F.lit(SPACE_MARK))
    if not dummy_prefix:
        return marked
    return F.concat(marked, F.lit(SPACE_MARK)) if as_suffix else F.concat(F.lit(SPACE_MARK), marked)


# Runs of one script; a digit stands alone.
SCRIPTS = "Latin Greek Cyrillic Han Hiragana Katakana Hangul Arabic Hebrew Devanagari Thai".split()
_RUNS = "|".join(f"\\p{{Is{s}}}+" for s in SCRIPTS)
VOCAB_PIECE_PATTERN = (
    f"{SPACE_MARK}?(?:\\p{{N}}|{_RUNS}|[^{SPACE_MARK}\\p{{N}}"
    + "".join(f"\\p{{Is{s}}}" for s in SCRIPTS)
    + f"]+)|{SPACE_MARK}"
)


def vocab_words(text: Column) -> Column:
    """Training words: split at white space, digits and script changes."""
    return F.regexp_extract_all(normalize_for_vocab(text), F.lit(VOCAB_PIECE_PATTERN), F.lit(0))


def characters(text: Column) -> Column:
    """Code points (an empty split would cut surrogate pairs)."""
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
