"""Tokenizers from rank files: base64 tokens with their ranks, and where each token lies in its text.

Special tokens and pre-tokens are cut by the JVM; an Arrow UDF merges bytes, each different
short word once in a while, and hands out its rows in bounded runs.  No row moves.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.text import RANK_PATTERN
from tokenloom.functions.tokens import split_long_text
from tokenloom.operators.vocab import RANK_SPECIALS

SPECIAL_PLACES = 256  # ids that follow the ranks; those without a named special token are reserved
MAX_FILE_BYTES = 64 << 20  # a rank file goes to every task
REMEMBERED = 200_000  # words a task remembers
REMEMBERED_BYTES = 64  # longer words are merged anew each time
RUN_WORDS = 1 << 16
TOKEN_TYPE = "ids array<int>, starts array<int>, pieces array<string>"


def read_ranks(path: str) -> dict[bytes, int]:
    """``token bytes -> rank`` of a file with a base64 token and a rank a line; a file of over 64 MB is an error."""
    files, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    size = files.get_file_info(place).size
    if size is None or size > MAX_FILE_BYTES:
        raise ValueError(f"{path}: no rank file of at most {MAX_FILE_BYTES} bytes")
    with files.open_input_stream(place) as stream:
        pairs = [line.split() for line in stream.read().splitlines() if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def special_ids(n_ranks: int) -> dict[str, int]:
    """Special tokens and their ids, which follow the ranks."""
    free = set(range(SPECIAL_PLACES)) - set(RANK_SPECIALS.values())
    reserved = {f"<|reserved_special_token_{i}|>": i for i in sorted(free)}
    return {name: n_ranks + place for name, place in (RANK_SPECIALS | reserved).items()}


def merge_bytes(word: bytes, ranks: Mapping[bytes, int]) -> list[bytes]:
    """Join the neighbours of lowest rank (the first of equals) until no two make a token.

    Parts are a linked list; a heap holds every joinable pair, and pairs that no longer stand are
    skipped, so a word of n bytes takes n log n steps.
    """
    n = len(word)
    if n < 2 or word in ranks:
        return [word] if n else []
    end = list(range(1, n + 1))  # end of the part that starts here; 0: no part starts here
    before = list(range(-1, n - 1))  # start of the part before
    heap: list[tuple[int, int, int, int]] = []

    def offer(start: int) -> None:
        middle = end[start]
        if start >= 0 and middle < n:
            rank = ranks.get(word[start : end[middle]])
            if rank is not None:
                heapq.heappush(heap, (rank, start, middle, end[middle]))

    for start in range(n - 1):
        offer(start)
    while heap:
        _, start, middle, stop = heapq.heappop(heap)
        if end[start] != middle or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < n:
            before[stop] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    parts, at = [], 0
    while at < n:
        parts.append(word[at : end[at]])
        at = end[at]
    return parts


def _continues(byte: int) -> bool:
    return 0x80 <= byte < 0xC0


def token_places(parts: list[bytes]) -> tuple[tuple[bool, int], ...]:
    """For each token: whether it starts inside a character, and how many characters start in it."""
    return tuple((_continues(p[0]), sum(not _continues(b) for b in p)) for p in parts)


def row_runs(batches: Iterator[pa.Array]) -> Iterator[list[list[str]]]:
    """Rows of Arrow batches of word lists (null: no words), in runs of at most ``RUN_WORDS`` words or a single row.

    A batch holds thousands of texts; as Python strings a whole one would fill the worker.
    """
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch).fill_null(0).to_numpy(zero_copy_only=False))
        words = batch.flatten()
        at = before = 0
        while at < len(batch):
            stop = max(at + 1, int(np.searchsorted(ends, before + RUN_WORDS, side="right")))
            run = words.slice(before, ends[stop - 1] - before).to_numpy(zero_copy_only=False).tolist()
            cuts = [0, *(ends[at:stop] - before).tolist()]
            yield [run[a:b] for a, b in zip(cuts, cuts[1:])]
            at, before = stop, int(ends[stop - 1])


def cut_words(text: Column, pattern: str, specials: bool) -> Column:
    """Pre-tokens of a text; with ``specials``, those strings stand alone."""
    words = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if not specials:
        return words
    names = "|".join(re.escape(name) for name in special_ids(0))
    parts = F.regexp_extract_all(text, F.lit(f"(?s){names}|.+?(?={names}|\\z)"), F.lit(0))
    cut = F.transform(
        parts,
        lambda p: F.when(p.rlike(f"\\A(?:{names})\\z"), F.array(p)).otherwise(
            F.regexp_extract_all(p, F.lit(pattern), F.lit(0))
        ),
    )
    return F.when(F.contains(text, F.lit("<|")), F.flatten(cut)).otherwise(words)


def rank_tokens(spark: SparkSession, text: Column, ranks: Mapping[bytes, int] | Broadcast,
                pattern: str = RANK_PATTERN, specials: bool = True) -> Column:
    """``ids, starts, pieces`` of a text: token ids, the character each token starts in, and the text up to the next start.

    A token that starts inside a character starts at that character, so a character split over tokens is the
    piece of the last of them, and the ones before have an empty piece.  With ``specials``, special strings in the text are
    their own tokens.  Null and empty texts have no tokens.
    """
    model = ranks if isinstance(ranks, Broadcast) else spark.sparkContext.broadcast(dict(ranks))

    @F.arrow_udf(TOKEN_TYPE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = model.value
        known = special_ids(len(table)) if specials else {}

        def encode(word: str) -> tuple[tuple[int, ...], tuple[tuple[bool, int], ...]]:
            if word in known:
                return (known[word],), ((False, len(word)),)
            parts = merge_bytes(word.encode(), table)
            return tuple(table[p] for p in parts), token_places(parts)

        remembered = lru_cache(maxsize=REMEMBERED)(encode)
        for rows in row_runs(batches):
            ids, starts, pieces, ends = [], [], [], [0]
            for row in rows:
                whole, first, at = "".join(row), len(starts), 0
                for word in row:
                    own, places = remembered(word) if len(word) <= REMEMBERED_BYTES else encode(word)
                    ids += own
                    for inside, n_chars in places:
                        starts.append(max(0, at - inside))
                        at += n_chars
                own_starts = starts[first:]
                pieces += [whole[a:b] for a, b in zip(own_starts, [*own_starts[1:], None])]
                ends.append(len(ids))
            columns = pa.array(ids, pa.int32()), pa.array(starts, pa.int32()), pa.array(pieces, pa.string())
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), c) for c in columns], ["ids", "starts", "pieces"])

    return run(cut_words(text, pattern, specials))


def rank_ids(spark: SparkSession, text: Column, ranks: Mapping[bytes, int], pattern: str = RANK_PATTERN,
             slice_chars: int = 400_000) -> Column:
    """Ids of a text taken as ordinary text, in slices of at most ``slice_chars`` characters."""
    model = spark.sparkContext.broadcast(dict(ranks))
    cut = F.flatten(
        F.transform(split_long_text(F.coalesce(text, F.lit("")), slice_chars), lambda part: cut_words(part, pattern, False))
    )

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = model.value

        def encode(word: str) -> tuple[int, ...]:
            return tuple(table[p] for p in merge_bytes(word.encode(), table))

        remembered = lru_cache(maxsize=REMEMBERED)(encode)
        for rows in row_runs(batches):
            ids, ends = [], [0]
            for row in rows:
                for w in row:
                    ids += remembered(w) if len(w) <= REMEMBERED_BYTES else encode(w)
                ends.append(len(ids))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))

    return run(cut)
