"""Shards of nearly equal bytes: the minimax contiguous partition of atomic groups.

Rows with equal texts are one atomic group. Groups are ordered by a 60-bit key taken from the digest of their
text, so a row knows its place in the order without a join. The smallest capacity C such that greedy filling
in this order needs no more than the given number of shards is found by binary search, and the cuts are put
where the greedy filling for C puts them.

The search needs no sorted list of all groups. A directory holds the bytes of ranges of keys (4,096 ranges to
begin with, never more than ``DIRECTORY`` at a time). Filling greedily over ranges that may not be cut, and
over ranges that may be cut anywhere, brackets C and every cut; only the ranges that a cut can still fall into
are split further by the next aggregate, until all of them are single groups. The driver therefore holds a
directory of constant size, whatever the input.

A group as large as a fair share of what remains gets a shard of its own, largest first; the search runs over
the rest. Two texts whose keys collide (some thousand pairs in 10^11 texts) count as one group.

Null texts count as empty ones: size 8, checksum 0. Empty texts, repeated rows and null ids are rows like any
other; a table with fewer groups than shards leaves shards empty; an empty table gives an empty result.
Columns other than the id and the text are never read.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchboard.llm.common import stored, text_of
from matchboard.operators.ranking import zip_with_index

KEY_BITS = 60
FIRST_BITS = 12
DIRECTORY = 1 << 15
ROW_BYTES = 8


@dataclass(frozen=True)
class Range:
    """Keys from ``start`` on, 2 ** ``bits`` wide; ``low`` and ``high`` are the keys that occur."""

    start: int
    bits: int
    size: int
    low: int
    high: int

    @property
    def single(self) -> bool:
        return self.low == self.high


def _ranges(rows: DataFrame, bits: int, among: list[int] | None = None, among_bits: int = 0) -> list[Range]:
    if among is not None:
        rows = rows.where(F.shiftright("key", among_bits).isin(among))
    sums = rows.groupBy(F.shiftright("key", bits).alias("cell")).agg(
        F.sum("size").alias("size"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    return [Range(r.cell << bits, bits, r.size, r.low, r.high) for r in sums.collect()]  # at most DIRECTORY rows


class Directory:
    def __init__(self, ranges: list[Range]):
        self.ranges = sorted(ranges, key=lambda r: r.start)
        self.ends: list[int] = []
        for r in self.ranges:
            self.ends.append((self.ends[-1] if self.ends else 0) + r.size)
        self.total = self.ends[-1] if self.ends else 0

    def fill(self, capacity: int, shards: int, divisible: bool) -> list[int]:
        """Where greedy shards end, in bytes from the start; ``divisible``: inner ranges may be cut anywhere."""
        at, cuts = 0, []
        for _ in range(shards):
            reach = at + capacity
            if reach >= self.total:
                at = self.total
            else:
                i = bisect_right(self.ends, reach)
                whole = self.ends[i - 1] if i else 0
                at = reach if divisible and not self.ranges[i].single else max(at, whole)
            cuts.append(at)
        return cuts

    def least(self, shards: int, divisible: bool, low: int, high: int) -> int:
        """The smallest capacity in (low, high] that fills everything."""
        while high - low > 1:
            middle = (low + high) // 2
            if self.fill(middle, shards, divisible)[-1] == self.total:
                high = middle
            else:
                low = middle
        return high

    def open_ranges(self, first: list[int], last: list[int]) -> list[Range]:
        """Ranges of several groups that a cut between ``first[k]`` and ``last[k]`` may fall into."""
        found: dict[int, Range] = {}
        for a, b in zip(first, last):
            i = bisect_right(self.ends, a)
            while i < len(self.ranges) and (self.ends[i - 1] if i else 0) <= b:
                if not self.ranges[i].single:
                    found[self.ranges[i].start] = self.ranges[i]
                i += 1
        return list(found.values())


def minimax_cuts(rows: DataFrame, shards: int) -> tuple[list[int], list[int], int]:
    """From rows (key, size): keys with a shard of their own, the last key of every further shard but the last, C."""
    directory = Directory(_ranges(rows, KEY_BITS - FIRST_BITS))
    own: list[int] = []
    while directory.total and shards - len(own) > 1:
        fair = math.ceil(directory.total / (shards - len(own)))
        wide = [r.start >> r.bits for r in directory.ranges if r.size >= fair]
        rest = rows.where(~F.col("key").isin(own)) if own else rows
        among = rest.where(F.shiftright("key", KEY_BITS - FIRST_BITS).isin(wide))
        largest = among.groupBy("key").agg(F.sum("size").alias("n")).where(F.col("n") >= fair).orderBy(F.desc("n"), "key").head(1)
        if not largest:
            break
        own.append(largest[0].key)
        rest = rows.where(~F.col("key").isin(own))
        directory = Directory(_ranges(rest, KEY_BITS - FIRST_BITS))
    rest = rows.where(~F.col("key").isin(own)) if own else rows
    shards -= len(own)
    if not directory.total:
        return own, [], 0
    while True:
        floor = max(math.ceil(directory.total / shards), max((r.size for r in directory.ranges if r.single), default=0))
        low = directory.least(shards, True, floor - 1, directory.total)  # the capacity is not below this
        high = directory.least(shards, False, low - 1, directory.total)  # nor above this
        first, last = directory.fill(low, shards, False), directory.fill(high, shards, True)
        inner = directory.open_ranges(first[:-1], last[:-1]) if low != high or first != last else []
        if not inner:
            break
        step = max(1, int(math.log2(max(2, (DIRECTORY - len(directory.ranges)) / len(inner)))))
        gone = {r.start for r in inner}
        kept = [r for r in directory.ranges if r.start not in gone]
        for bits in {r.bits for r in inner}:
            cells = [r.start >> bits for r in inner if r.bits == bits]
            kept += _ranges(rest, max(0, bits - step), cells, bits)
        directory = Directory(kept)
    ends = directory.fill(high, shards, False)[:-1]
    lasts = [directory.ranges[bisect_right(directory.ends, end) - 1].high for end in ends]
    return own, lasts, high


def _shard(key: Column, own: list[int], lasts: list[int]) -> Column:
    later = sum((F.when(key > last, 1).otherwise(0) for last in lasts), F.lit(len(own)))
    return F.coalesce(*[F.when(key == k, F.lit(i)) for i, k in enumerate(own)], later).cast("int")


def assign(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot), one per row; slots count from 0 in each shard."""
    text = text_of(text_col)
    key = F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")
    rows = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            key.alias("key"),
        ),
        "shard-rows",
    )
    own, lasts, _ = minimax_cuts(rows.select("key", "size"), shards)
    placed = rows.withColumn("shard", _shard(F.col("key"), own, lasts))
    counts = {r.shard: r.n for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per shard
    before, starts = 0, []
    for shard in sorted(counts):
        starts.append(F.when(F.col("shard") == shard, F.lit(before)))
        before += counts[shard]
    numbered = zip_with_index(placed, [F.col(c) for c in ("shard", "key", "doc_id")], "__place", start=0)
    slot = (F.col("__place") - F.coalesce(*starts, F.lit(0))).cast("long")
    return numbered.select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"))
