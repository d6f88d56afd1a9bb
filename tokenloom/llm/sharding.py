"""Minimax contiguous sharding of documents into shards of near-equal bytes.

Documents with equal texts form one atomic group; groups lie in order of their smallest id.
The smallest capacity for which a greedy left-to-right filling needs at most ``shards`` shards
is found by a search over the group sizes: every round tries several capacities at once and
checks them greedily, all by aggregates over the table of running group sizes.  The driver only
sees the few border values of a check, never the groups.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.storage import staged
from tokenloom.operators.ordering import ordered_bucket, rank_by_id, running_offset

PARALLEL_CHECKS = 32
HELD_BORDERS = 100_000


def text_group(text: Column) -> Column:
    """Identity of a text: equal texts have equal groups; null is a text of its own."""
    return F.coalesce(F.sha2(text, 256), F.lit("null"))


class Borders:
    """The running sizes at which a shard may end.

    Up to ``HELD_BORDERS`` of them are a sorted list; beyond that every question is one aggregate
    over the table.  The answers are the same.
    """

    def __init__(self, ends: DataFrame):
        self.ends = ends
        found = [r[0] for r in ends.select("end").limit(HELD_BORDERS + 1).collect()]
        self.held = sorted(found) if len(found) <= HELD_BORDERS else None

    def furthest(self, limits: Sequence[int]) -> list[int]:
        """For each limit the largest border up to it (0 if there is none)."""
        if self.held is not None:
            places = [bisect_right(self.held, t) for t in limits]
            return [self.held[i - 1] if i else 0 for i in places]
        end = F.col("end")
        found = self.ends.agg(*[F.max(F.when(end <= t, end)).alias(f"c{i}") for i, t in enumerate(limits)])
        return [v or 0 for v in found.first()]

    def nearest_from(self, limit: int) -> int:
        """The smallest border at or above ``limit``."""
        if self.held is not None:
            return self.held[bisect_left(self.held, limit)]
        return self.ends.agg(F.min(F.when(F.col("end") >= limit, F.col("end")))).first()[0]

    def within(self, spans: Sequence[tuple[int, int]]) -> Borders:
        """Only the borders inside one of the closed spans."""
        keep = F.lit(False)
        for a, b in spans:
            keep = keep | F.col("end").between(a, b)
        return self if self.held is not None else Borders(staged(self.ends.filter(keep), "shard-ends"))


def greedy_cuts(borders: Borders, capacities: Sequence[int], shards: int) -> list[list[int]]:
    """For each capacity the borders of a greedy filling, ``shards`` of them, all capacities in step."""
    cuts = [[0] for _ in capacities]
    for _ in range(shards):
        reached = borders.furthest([c[-1] + capacity for c, capacity in zip(cuts, capacities, strict=True)])
        for c, r in zip(cuts, reached, strict=True):
            c.append(max(r, c[-1]))
    return [c[1:] for c in cuts]


def smallest_capacity(borders: Borders, total: int, largest: int, shards: int) -> int:
    """The smallest capacity with which a greedy filling needs at most ``shards`` shards.

    ``low`` never suffices and ``high`` always does; both move until they are neighbours.  After a
    round, border ``s`` of every capacity in between lies between the borders of the two, so only
    those are kept for the next round.
    """
    low, high = max(-(-total // shards), largest) - 1, -(-total // shards) + largest
    while high - low > 1:
        step = max(1, -(-(high - low) // PARALLEL_CHECKS))
        tried = sorted({*range(low + step, high, step), high})
        cuts = greedy_cuts(borders, tried, shards)
        first = [c[-1] >= total for c in cuts].index(True)
        high = tried[first]
        if first:
            low = tried[first - 1]
            borders = borders.within(list(zip(cuts[first - 1], cuts[first], strict=True)))
    return high


def even_cuts(borders: Borders, total: int, capacity: int, shards: int) -> list[int]:
    """Cuts within the capacity that leave the shards as equal as the groups allow.

    Each cut is the first border that gives its shard a fair part of what is left, but not before
    the earliest border from which the remaining shards still suffice.
    """
    earliest = [total]
    for _ in range(shards - 1):
        back = earliest[-1] - capacity
        earliest.append(borders.nearest_from(back) if back > 0 else 0)
    earliest = earliest[::-1]
    cuts = [0]
    for s in range(shards - 1):
        here, left = cuts[-1], shards - s
        fair = borders.nearest_from(here + -(-(total - here) // left)) if here < total else total
        if fair - here > capacity:
            fair = borders.furthest([here + capacity])[0]
        cuts.append(max(fair, earliest[s], here))
    return cuts[1:]


def group_spans(sized: DataFrame) -> DataFrame:
    """``group, start, end``: where each group lies in the running size of all groups."""
    groups = sized.groupBy("group").agg(F.sum("size").alias("bytes"), F.min("doc_id").alias("first_id"))
    groups = staged(groups, "shard-groups")
    bucket = ordered_bucket(groups, "first_id")
    spans = running_offset(groups, F.col("bytes"), bucket, [F.col("first_id"), F.col("group")], "start")
    return staged(spans.select("group", "start", (F.col("start") + F.col("bytes")).alias("end"), "bytes"), "shard-spans")


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs`` (``doc_id``, ``text``).

    Size: bytes of the text plus 1; null text: 1, checksum of no bytes, and a group of its own.
    Slots number the rows of a shard from 0 in id order (null ids first); repeated rows get a slot
    each.  Shards may stay empty where there are fewer groups than shards.  No rows give no rows.
    """
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint")
    sized = docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        text_group(F.col("text")).alias("group"),
    )
    sized = staged(sized, "shard-sizes")
    spans = group_spans(sized)
    total, largest = spans.agg(F.max("end"), F.max("bytes")).first()
    cuts: list[int] = []
    if total is not None:
        # a cut lies within so many largest groups of its even place, forwards or backwards
        spare = [(s * total // shards, max(s, shards - s) * largest + shards) for s in range(1, shards + 1)]
        near = F.lit(False)
        for place, reach in spare:
            near = near | F.col("end").between(place - reach, place + reach)
        borders = Borders(spans.filter(near).select("end"))
        cuts = even_cuts(borders, total, smallest_capacity(borders, total, largest, shards), shards)
    every = F.array(*[F.lit(c).cast("bigint") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    shard = F.size(F.filter(every, lambda c: c <= F.col("start"))).cast("int")
    placed = sized.join(spans.select("group", "start"), "group")
    placed = staged(placed.select("doc_id", "size", "text_crc32", shard.alias("shard")), "shard-placed")
    return rank_by_id(placed, "doc_id", "slot", ["shard"])


def contract(sharded: DataFrame) -> DataFrame:
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
