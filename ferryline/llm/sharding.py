"""Minimax contiguous partition of documents into shards.

Equal texts are one atomic group; groups stand in the order of a digest of their text. The smallest capacity is sought
at which a greedy walk over the group sizes needs no more than the wanted shards, and the cuts keep to it.

Group sizes stay in a table. The driver holds cells, the groups of one digest prefix summed up, and splits only cells in
which some walk may cut: a few thousand to begin with, and at most a few per shard and level after that. A cell with
one group is atomic. When no walk between the bounds of the capacity can cut inside a larger cell, the search over the
cells is exact for the groups.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.columns import text_of

FIRST, STEP = 3, 2  # hex digits of the digest in the first cells, and more at every split
ROWS_PER_BUCKET = 500_000
MOST_BUCKETS = 4_096


class Cells:
    """Sizes of all groups in digest order, summed up where no detail is needed."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        self.cells = self._read(groups, FIRST)
        self._index()

    @staticmethod
    def _read(groups: DataFrame, width: int) -> dict[str, tuple[int, int]]:
        """Prefix -> (bytes, groups); bounded by the number of prefixes asked for."""
        cells = groups.groupBy(F.substring("digest", 1, width).alias("p")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n"))
        return {r.p: (r.b, r.n) for r in cells.collect()}

    def _index(self) -> None:
        self.prefixes = sorted(self.cells)
        self.ends = list(accumulate(self.cells[p][0] for p in self.prefixes))
        self.total = self.ends[-1] if self.ends else 0

    def inside(self, low: int, high: int) -> set[str]:
        """Prefixes of cells of several groups in which a cut at ``low`` .. ``high`` bytes may fall."""
        first, last = bisect_right(self.ends, low), bisect_left(self.ends, high)
        return {p for p in self.prefixes[first:last + 1] if self.cells[p][1] > 1}

    def floor(self, position: int) -> int:
        """The last cell edge at or before a position."""
        at = bisect_right(self.ends, position)
        return self.ends[at - 1] if at else 0

    def split(self, prefixes: set[str]) -> None:
        by_width: dict[int, list[str]] = {}
        for p in prefixes:
            by_width.setdefault(len(p), []).append(p)
        for width, listed in by_width.items():
            rows = self.groups.where(F.substring("digest", 1, width).isin(*listed))
            for p in listed:
                del self.cells[p]
            self.cells.update(self._read(rows, width + STEP))
        self._index()


def _greedy(cells: Cells, capacity: int, shards: int) -> list[int] | None:
    """Ends of the shards of a greedy walk over the cells; None if the shards do not suffice."""
    ends, at = [], 0
    for _ in range(shards):
        following = cells.floor(at + capacity)
        if following == at and at < cells.total:
            return None
        at = following
        ends.append(at)
    return ends if at == cells.total else None


def smallest_capacity(cells: Cells, shards: int, largest: int) -> int:
    """The least capacity at which a greedy walk over all groups ends within the shards."""
    least = max(-(-cells.total // shards), largest)
    while True:
        low, high = least, max(least, cells.total)
        while low < high:
            middle = (low + high) // 2
            if _greedy(cells, middle, shards) is None:
                low = middle + 1
            else:
                high = middle
        # Cells are unions of groups, so the true capacity lies between ``least`` and ``low``.
        doubtful: set[str] = set()
        before, beyond = 0, 0
        for _ in range(shards):
            before, beyond = cells.floor(before + least), min(beyond + low, cells.total)
            doubtful |= cells.inside(before, beyond)
        if not doubtful:
            return low
        cells.split(doubtful)


def even_cuts(cells: Cells, shards: int, capacity: int) -> list[int]:
    """Ends of the shards: as even as the groups allow, none above ``capacity``."""
    while True:
        latest, points = cells.total, []
        floors = []  # the least end of each shard that leaves the others enough room
        for _ in range(shards - 1):
            points.append(latest - capacity)
            at = bisect_left(cells.ends, latest - capacity)
            latest = cells.ends[at] if latest - capacity > 0 else 0
            floors.append(latest)
        floors.reverse()
        at, ends = 0, []
        for number in range(shards - 1):
            target = at + (cells.total - at) // (shards - number)
            points += [target, at + capacity]
            under = cells.floor(target)
            over = cells.ends[min(bisect_left(cells.ends, target), len(cells.ends) - 1)]
            choice = over if over - target < target - under else under
            at = max(at, floors[number], min(choice, cells.floor(at + capacity)))
            ends.append(at)
        ends.append(cells.total)
        doubtful = set().union(*[cells.inside(p, p) for p in points if 0 < p < cells.total])
        if not doubtful:
            return ends
        cells.split(doubtful)


def shard_starts(groups: DataFrame, shards: int) -> list[str | None]:
    """The first digest prefix of every shard but the first; None where it and those behind it stay empty."""
    cells = Cells(groups)
    if not cells.total:
        return [None] * (shards - 1)
    largest = groups.agg(F.max("bytes")).head()[0]
    ends = even_cuts(cells, shards, smallest_capacity(cells, shards, largest))
    return [cells.prefixes[bisect_right(cells.ends, end)] if end < cells.total else None for end in ends[:-1]]


def shard(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``size`` is the bytes of the text plus 1; equal texts share a shard. Sizes are as even as whole groups allow.

    Nulls: a null text is an empty one; null ids are kept. Repeated rows have slots of their own; which of them has
    which is the same in every run as far as the result shows. Fewer groups than shards leave shards empty. An empty
    table gives an empty result. Other columns are ignored, whatever their names.
    """
    body = text_of(text)
    size = (F.octet_length(body) + 1).cast("bigint")
    rows = docs.select(F.col(doc_id).alias("doc_id"), size.alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
                       F.md5(body.cast("binary")).alias("digest"))
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).checkpoint()
    count = groups.agg(F.sum("n")).head()[0] or 0
    starts = [s for s in shard_starts(groups, shards) if s is not None]
    placed = rows.withColumn("shard", sum([(F.col("digest") >= s).cast("int") for s in starts], F.lit(0)))

    # Rows are numbered in buckets that take no account of groups, so a large group spreads over all of them.
    buckets = max(1, min(MOST_BUCKETS, -(-count // (shards * ROWS_PER_BUCKET)) * 4))
    dealt = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(
        Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # At most shards * MOST_BUCKETS rows.
    offsets = F.broadcast(sizes.select("shard", "bucket", before.alias("before")))
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("digest", "doc_id"))
    numbered = dealt.withColumn("place", place).join(offsets, ["shard", "bucket"])
    return numbered.select(
        F.col("doc_id").alias(doc_id), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
