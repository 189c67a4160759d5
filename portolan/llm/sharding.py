"""Shards of contiguous groups whose largest is as small as it can be."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from heapq import nlargest

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.ranks import number_within
from portolan.sources.scratch import store

# Hexadecimal digits of the group's hash that one round of the search looks further into:
# a bucket is replaced by at most 16 ** 3 smaller ones.
DIGITS = 3


@dataclass(frozen=True)
class Bucket:
    """Groups whose hash starts with ``prefix``; ``single`` if there is just one."""

    prefix: str
    size: int
    single: bool


class Line:
    """Buckets in order, with the sizes before each."""

    def __init__(self, buckets: list[Bucket]):
        self.buckets = sorted(buckets, key=lambda b: b.prefix)
        self.ends = [0]
        for b in self.buckets:
            self.ends.append(self.ends[-1] + b.size)
        self.total = self.ends[-1]

    def reach(self, start: int, capacity: float) -> int:
        """The last place that a shard from place ``start`` can end at."""
        return bisect_right(self.ends, self.ends[start] + capacity) - 1

    def greedy(self, capacity: float, shards: int, start: int = 0) -> list[int]:
        """Ends of shards filled one after the other."""
        ends = []
        for _ in range(shards):
            start = self.reach(start, capacity)
            ends.append(start)
        return ends

    def fits(self, capacity: float, shards: int, start: int = 0) -> bool:
        last = len(self.buckets)
        if shards == 0:
            return self.ends[start] == self.total
        return self.ends[self.greedy(capacity, shards, start)[-1]] == self.total if last else True

    def open_between(self, low: int, high: float) -> set[str]:
        """Buckets of several groups that overlap the sizes ``low`` to ``high``."""
        first = max(0, bisect_right(self.ends, low) - 1)
        found = set()
        for i in range(first, len(self.buckets)):
            if self.ends[i] >= high:
                break
            if not self.buckets[i].single and self.ends[i + 1] > low:
                found.add(self.buckets[i].prefix)
        return found


def smallest_capacity(line: Line, shards: int) -> tuple[int, int]:
    """Bounds of the smallest capacity that holds every shard: with buckets as if they could
    be cut anywhere, and with buckets kept whole (found by bisection, checked greedily)."""
    atomic = max((b.size for b in line.buckets if b.single), default=0)
    low = max(-(-line.total // shards), atomic)
    lo, hi = low, max(low, line.total)
    while lo < hi:
        middle = (lo + hi) // 2
        if line.fits(middle, shards):
            hi = middle
        else:
            lo = middle + 1
    return low, lo


def fair_share(sizes: list[int], shards: int) -> float:
    """What each shard gets, apart from sizes beyond that, which take a shard each."""
    rest, total = shards, sum(sizes)
    for size in nlargest(shards - 1, sizes):
        if size * rest <= total:
            break
        rest, total = rest - 1, total - size
    return total / rest


def even_cuts(line: Line, capacity: int, shards: int) -> tuple[list[int], set[str]]:
    """Places of the cuts, and buckets that must be opened before the cuts are final.

    Each shard ends where it comes nearest to a fair share of what is left, if what
    follows then still fits ``capacity``; else as late as the capacity allows.
    """
    start, cuts, last = 0, [], len(line.buckets)
    share = fair_share([b.size for b in line.buckets], shards)
    opened = {b.prefix for b in line.buckets if b.size > share and not b.single}
    for left in range(shards, 1, -1):
        share = fair_share([b.size for b in line.buckets[start:]], left)
        below = line.reach(start, share)
        target = line.ends[start] + share
        opened |= line.open_between(target, target + 1e-9)
        near = [c for c in (below, min(below + 1, last))
                if c > start and line.ends[c] - line.ends[start] <= capacity and line.fits(capacity, left - 1, c)]
        start = min(near, key=lambda c: abs(line.ends[c] - target)) if near else line.reach(start, capacity)
        cuts.append(start)
    return cuts, opened


def cut_keys(groups: DataFrame, shards: int) -> list[str | None]:
    """For each shard but the first, the hash prefix it starts at (None: it is empty).

    ``groups`` has ``_group`` (a hexadecimal hash) and ``_size``; groups are ordered by
    hash and never cut. The smallest feasible capacity is searched over sums of buckets of
    groups; buckets that may hold a cut are opened until the cuts fall between groups. Only
    sums of the opened buckets reach the driver: with each round the stretch that may hold
    the cuts is 4,096 times shorter, so a few rounds settle any number of groups.
    """

    def sums(rows: DataFrame, digits: int) -> list[Bucket]:
        found = (
            rows.groupBy(F.substring("_group", 1, digits).alias("prefix"))
            .agg(F.sum("_size").alias("size"), (F.min("_group") == F.max("_group")).alias("single"))
            .collect()
        )
        return [Bucket(r["prefix"], r["size"], r["single"]) for r in found]

    line = Line(sums(groups, DIGITS))
    while line.buckets:
        low, high = smallest_capacity(line, shards)
        to_open: set[str] = set()
        if low < high:
            for j, place in enumerate(line.greedy(low, shards - 1), 1):
                to_open |= line.open_between(line.ends[place], min(j * high, line.total) + 1)
        cuts, more = even_cuts(line, high, shards)
        to_open |= more
        if not to_open:
            return [line.buckets[c].prefix if c < len(line.buckets) else None for c in cuts]
        kept = [b for b in line.buckets if b.prefix not in to_open]
        for digits in sorted({len(p) for p in to_open}):
            level = sorted(p for p in to_open if len(p) == digits)
            inside = groups.filter(F.substring("_group", 1, digits).isin(level))
            kept += sums(inside, digits + DIGITS)
        line = Line(kept)
    return [None] * (shards - 1)


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal documents into ``shards`` of nearly equal bytes; equal texts stay together.

    Returns ``id_col``, size (UTF-8 bytes and one), text_crc32, shard and slot, a gapless
    number in the shard. Groups of equal texts are ordered by the SHA-256 of the text and
    cut into contiguous shards so that the largest shard is as small as that order allows;
    among such cuts, each shard comes near a fair share of the rest. A group larger than a
    share gets a shard of its own. Null counts as the empty text. Repeated rows are rows
    like any other. With fewer groups than shards some shards are empty; an empty table
    gives no rows. Columns other than the two named are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = store(
        docs.select(
            F.col(id_col),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
            F.sha2(text.cast("binary"), 256).alias("_group"),
        ),
        "shard-groups",
    )
    starts = cut_keys(rows.select("_group", F.col("size").alias("_size")), shards)
    shard = F.lit(0)
    for key in starts:
        if key is not None:
            shard = shard + (F.col("_group") >= F.lit(key)).cast("int")
    placed = rows.withColumn("shard", shard)
    counts = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    return number_within(placed, "shard", [id_col, "_group"], counts, "slot").drop("_group")
