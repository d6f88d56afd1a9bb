"""Token sequences as array columns: byte tokens, padding, templates, fill-in-the-middle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.arrays import let, slice_from
from tokenloom.functions.hashing import md5_uniform

# Ids of the byte tokenizer and the label that losses skip.
BYTE_BOS = 256
BYTE_EOS = 257
IGNORE_LABEL = -100
# Ids given to the three fill-in-the-middle markers over byte tokens.
FIM_PREFIX = 258
FIM_SUFFIX = 259
FIM_MIDDLE = 260


def text_bytes(text: Column) -> Column:
    """UTF-8 byte values.  Latin-1 gives one character per byte, so one split does it."""
    latin = F.decode(text.cast("binary"), "ISO-8859-1")
    chars = F.when(F.octet_length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(latin, ""))
    return F.transform(chars, lambda c: F.ascii(c))


def byte_tokens(text: Column, add_bos: bool = True, add_eos: bool = True) -> Column:
    ids = text_bytes(text)
    if add_bos:
        ids = F.concat(F.array(F.lit(BYTE_BOS)), ids)
    if add_eos:
        ids = F.concat(ids, F.array(F.lit(BYTE_EOS)))
    return ids


def byte_token_count(text: Column, specials: int = 2) -> Column:
    """Length of the byte tokens, without building them."""
    return F.octet_length(text) + F.lit(specials)


def bytes_of(tokens: Column) -> Column:
    """Binary value of the ids below 256; special ids are dropped."""
    kept = F.filter(tokens, lambda t: t < 256)
    return F.encode(F.array_join(F.transform(kept, lambda t: F.chr(t)), ""), "ISO-8859-1")


# Start of a well-formed UTF-8 character, then one wrong byte: used to escape bad bytes.
_GOOD_UTF8 = (
    "[\\x00-\\x7f]|[\\xc2-\\xdf][\\x80-\\xbf]|\\xe0[\\xa0-\\xbf][\\x80-\\xbf]"
    "|[\\xe1-\\xec\\xee\\xef][\\x80-\\xbf]{2}|\\xed[\\x80-\\x9f][\\x80-\\xbf]"
    "|\\xf0[\\x90-\\xbf][\\x80-\\xbf]{2}|[\\xf1-\\xf3][\\x80-\\xbf]{3}|\\xf4[\\x80-\\x8f][\\x80-\\xbf]{2}"
)


def byte_text(tokens: Column) -> Column:
    """Text of byte tokens; a byte that is not part of valid UTF-8 shows as ``\\xNN``."""

    def escaped(latin: Column) -> Column:
        pieces = F.regexp_extract_all(latin, F.lit(f"(?s){_GOOD_UTF8}|."), F.lit(0))
        shown = F.transform(
            pieces,
            lambda p: F.when(
                (F.length(p) == 1) & (F.ascii(p) >= 128),
                F.concat(F.lit("\\x"), F.lower(F.hex(F.ascii(p)))),
            ).otherwise(p),
        )
        return F.decode(F.encode(F.array_join(shown, ""), "ISO-8859-1"), "UTF-8")

    return let(
        bytes_of(tokens),
        lambda b: F.when(F.is_valid_utf8(b.cast("string")), b.cast("string")).otherwise(
            escaped(F.decode(b, "ISO-8859-1"))
        ),
    )


def add_bos_eos(ids: Column, bos: int, eos: int) -> Column:
    return F.concat(F.array(F.lit(bos)), ids, F.array(F.lit(eos)))


def pad_right(ids: Column, width: Column, pad: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad), (width - F.size(ids)).cast("int")))


def attention_mask(padded: Column, pad: int) -> Column:
    return F.transform(padded, lambda t: (t != pad).cast("int"))


def next_token_labels(ids: Column, width: Column, pad: int) -> Column:
    """Labels of a padded example: the next token, the pad id at the last real place,
    and the ignored label on padding (also where the input itself is the pad id)."""
    shifted = F.concat(F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0))), F.array(F.lit(pad)))
    inputs = pad_right(ids, width, pad)
    return F.zip_with(
        pad_right(shifted, width, pad),
        inputs,
        lambda label, token: F.when(token == pad, F.lit(IGNORE_LABEL)).otherwise(label),
    )


def pair_template(
    left: Column, right: Column, bos: int, left_open: int, left_close: int, right_open: int, right_close: int, eos: int
) -> Column:
    """``<s> <a> left </a> <b> right </b> </s>`` over token ids."""
    return F.concat(
        F.array(F.lit(bos), F.lit(left_open)),
        left,
        F.array(F.lit(left_close), F.lit(right_open)),
        right,
        F.array(F.lit(right_close), F.lit(eos)),
    )


def keep_tail(tokens: Column, limit: Column) -> Column:
    """The last ``limit`` tokens."""
    return let(tokens, lambda t: slice_from(t, F.greatest(F.size(t) - limit, F.lit(0)), limit))


def shifted_views(window: Column, seq_len: int, n_views: int) -> Column:
    """View v holds tokens ``[v, v + seq_len)``: view 0 is the input, the others targets."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(n_views - 1)), lambda v: slice_from(window, v, F.lit(seq_len))
    )


def split_by_end_token(tokens: Column, end: int) -> Column:
    """Cut a window after every end token.  No token is lost:
    flattening the pieces gives the window back."""

    def pieces(t: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), F.size(t)), lambda i: F.try_element_at(t, i) == end)
        stops = F.array_distinct(F.concat(ends, F.array(F.size(t))))
        return let(
            stops,
            lambda s: F.transform(
                s,
                lambda stop, i: let(
                    F.coalesce(F.get(s, i - 1), F.lit(0)),
                    lambda start: slice_from(t, start, stop - start),
                ),
            ),
        )

    return let(tokens, lambda t: F.when(F.size(t) == 0, F.array(t)).otherwise(pieces(t)))


def cut_points(key: Sequence[Column], seed: str | int, length: Column) -> Column:
    """Two sorted cut places in ``[0, length]``."""
    first = F.floor(md5_uniform(f"{seed}/cut-a", *key) * (length + 1)).cast("int")
    second = F.floor(md5_uniform(f"{seed}/cut-b", *key) * (length + 1)).cast("int")
    return F.struct(F.least(first, second).alias("lo"), F.greatest(first, second).alias("hi"))


def fill_in_middle(
    tokens: Column,
    key: Sequence[Column],
    seed: str | int,
    rate: float,
    bos: int = BYTE_BOS,
    eos: int = BYTE_EOS,
    prefix_id: int = FIM_PREFIX,
    suffix_id: int = FIM_SUFFIX,
    middle_id: int = FIM_MIDDLE,
    truncate: bool = False,
) -> Column:
    """Rewrite to prefix-id prefix suffix-id suffix middle-id middle with probability ``rate``.

    Start and end tokens are taken off and put back.  Fewer than three tokens stay
    as they are.  ``truncate`` keeps the length by taking three tokens off the
    suffix, and leaves the row alone when the suffix is too short for that.
    """

    def rewrite(t: Column) -> Column:
        has_bos = F.try_element_at(t, F.lit(1)) == bos
        has_eos = F.try_element_at(t, F.lit(-1)) == eos
        head = F.when(has_bos, F.slice(t, 1, 1)).otherwise(F.array().cast("array<int>"))
        tail = F.when(has_eos, F.slice(t, -1, 1)).otherwise(F.array().cast("array<int>"))
        body = slice_from(t, has_bos.cast("int"), F.size(t) - has_bos.cast("int") - has_eos.cast("int"))

        def arrange(b: Column) -> Column:
            def at(cut: Column) -> Column:
                rest = F.size(b) - cut["hi"]
                suffix = slice_from(b, cut["hi"], rest - 3 if truncate else rest)
                out = F.concat(
                    head,
                    F.array(F.lit(prefix_id)),
                    slice_from(b, F.lit(0), cut["lo"]),
                    F.array(F.lit(suffix_id)),
                    suffix,
                    F.array(F.lit(middle_id)),
                    slice_from(b, cut["lo"], cut["hi"] - cut["lo"]),
                    tail,
                )
                return F.when(rest <= 3, t).otherwise(out) if truncate else out

            return let(cut_points(key, seed, F.size(b)), at)

        return let(body, arrange)

    chosen = md5_uniform(f"{seed}/apply", *key) < rate
    return let(
        tokens.cast("array<int>"),
        lambda t: F.when(chosen & (F.size(t) >= 3), rewrite(t)).otherwise(t),
    )


def split_long_text(text: Column, size: int = 400_000) -> Column:
    """Consecutive slices of at most ``size`` characters."""
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.length(text) - 1) / size), F.lit(0)).cast("int")),
        lambda i: F.substring(text, i * size + 1, F.lit(size)),
    )


def byte_offsets(text: Column) -> Column:
    """Per byte token: the character it belongs to and that character's start.

    Every byte advances the position, so multi-byte characters keep their place:
    a continuation byte points at the character it continues.
    """
    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    return F.flatten(F.transform(chars, lambda c, i: F.array_repeat(i, F.octet_length(c))))
