"""Tokenizers by name: each is a builder of ``Column -> Column`` encoders."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.tokens import byte_tokens
from tokenloom.operators.bpe import Merge, encode_text
from tokenloom.operators.rank_files import rank_ids, read_ranks, special_ids

Encoder = Callable[[Column], Column]
_BUILDERS: dict[str, Callable[..., Encoder]] = {}


def register_tokenizer(name: str, builder: Callable[..., Encoder]) -> None:
    """Add a tokenizer; a user's own model can wrap a pandas UDF."""
    _BUILDERS[name] = builder


def build_tokenizer(name: str, spark: SparkSession, **options) -> Encoder:
    if name not in _BUILDERS:
        raise NotImplementedError(f"no tokenizer named {name}; known: {sorted(_BUILDERS)}")
    return _BUILDERS[name](spark, **options)


def _bytes(spark: SparkSession, add_bos: bool = True, add_eos: bool = True) -> Encoder:
    return lambda text: byte_tokens(text, add_bos, add_eos)


def _mock(spark: SparkSession) -> Encoder:
    """Hands its input through: an array of ids stays as it is."""
    return lambda ids: ids


def _bpe(spark: SparkSession, merges: Sequence[Merge] = (), bos: int | None = None, eos: int | None = None) -> Encoder:
    def encode(text: Column) -> Column:
        ids = encode_text(spark, text, merges)
        if bos is not None:
            ids = F.concat(F.array(F.lit(bos)), ids)
        return ids if eos is None else F.concat(ids, F.array(F.lit(eos)))

    return encode


def _ranks(spark: SparkSession, path: str = "", add_bos: bool = True, add_eos: bool = True) -> Encoder:
    """The tokenizer of a rank file, with the text's begin and end tokens."""
    ranks = read_ranks(path)
    specials = special_ids(len(ranks))

    def encode(text: Column) -> Column:
        parts = [rank_ids(spark, text, ranks)]
        if add_bos:
            parts.insert(0, F.array(F.lit(specials["<|begin_of_text|>"])))
        if add_eos:
            parts.append(F.array(F.lit(specials["<|end_of_text|>"])))
        return F.concat(*parts)

    return encode


register_tokenizer("bytes", _bytes)
register_tokenizer("mock", _mock)
register_tokenizer("bpe", _bpe)
register_tokenizer("ranks", _ranks)
