"""Minimax contiguous partition of atomic groups into shards.

Equal texts are one atomic group; groups are ordered by a 64-bit hash of the
text. The smallest capacity C for which the greedy cut of that order needs no
more than ``n_shards`` shards is found by binary search, and the order is cut
there. Neither the groups nor their sizes come to the driver: it sees sums
over ranges of hashes (``RANGES`` of them) and searches with an optimistic and
a pessimistic greedy cut, which differ only in ranges that a cut may fall in;
those ranges are summed again in ``FINER`` parts, until they hold one group
each. So the result is exact and what the driver holds depends on the number
of shards, not on the rows.

The rows without their texts are written once with their task's number and
their place in it; slots are the counts of earlier tasks plus the place among
the task's rows of that shard, so that no shard is numbered in one task.

Defined results: null and empty texts are one group; texts with equal hashes
share a group; repeated rows keep slots of their own; an empty table gives an
empty result; columns other than id and text are not looked at. A group larger
than the mean shard makes the capacity at least its own size; where it is just
that, the group has a shard of its own, and what lies before and after it is
cut by the same search for the shards left over, and so on.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.base import quoted, save, workspace

SHARDS = 24
ROW_BYTES = 8
RANGES = 1 << 14
FINER = 1 << 8


class _Profile:
    """The hash order as ranges of keys, with the bytes and the number of groups of each."""

    def __init__(self, ranges: dict[tuple[int, int], tuple[int, int]]):
        """ranges: (first key, width in keys) -> (bytes, groups)."""
        self.spans = sorted(ranges)
        self.groups = [ranges[s][1] for s in self.spans]
        self.ends = list(accumulate(ranges[s][0] for s in self.spans))
        self.total = self.ends[-1]

    def _known_end(self, offset: int) -> int:
        """The last end of a range at or before a byte offset."""
        i = bisect_right(self.ends, offset)
        return self.ends[i - 1] if i else 0

    def _possible_end(self, offset: int) -> int:
        """An upper bound of the last end of a group at or before a byte offset."""
        i = bisect_right(self.ends, offset)
        return offset if i < len(self.ends) and self.groups[i] > 1 else self._known_end(offset)

    def bounds(self, capacity: int, shards: int) -> list[tuple[int, int]]:
        """Where the greedy cuts lie: the least and the largest byte offset of each."""
        low = high = 0
        out = []
        for _ in range(shards):
            low, high = self._known_end(low + capacity), min(self._possible_end(high + capacity), self.total)
            out.append((low, high))
        return out

    def needed(self, capacity: int, shards: int, side: int) -> int:
        """How many shards the greedy cut takes, by the largest offsets (side 1) or the least; more than ``shards`` if those are too few."""
        return next((i for i, b in enumerate(self.bounds(capacity, shards), 1) if b[side] >= self.total), shards + 1)

    def least(self, low: int, high: int, feasible) -> int:
        """The least capacity in [low, high] of which ``feasible`` holds; it holds of ``high``."""
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if feasible(middle) else (middle + 1, high)
        return low

    def doubtful(self, at: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Ranges of several groups that overlap any of these intervals of byte offsets, and so may hold a cut."""
        out = set()
        for low, high in at:
            first, last = bisect_right(self.ends, low), bisect_right(self.ends, high)
            out.update(i for i in range(first, min(last + 1, len(self.ends))) if self.groups[i] > 1)
        return [self.spans[i] for i in sorted(out)]


def capacity_and_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least capacity, and the last key of each shard but the last; ``groups(key, size)``, keys distinct."""
    capacity, largest, ends = _search(groups.withColumn("part", F.lit(0)), shards)
    least, alone = capacity, []
    while ends and least == largest:
        # Such a group has a shard of its own, and what lies between them is cut for the shards left over.
        alone = sorted([*alone, *(r[0] for r in groups.where(F.col("size") == largest).select("key").collect())])
        keys = [F.lit(k).cast("long") for k in alone]
        part = sum([F.when(F.col("key") > k, 1).otherwise(0) for k in keys], F.lit(0))
        between = groups.where(~F.col("key").isin(keys)).withColumn("part", part)  # one scan, however many parts
        least, largest, ends = _search(between, shards - len(alone))
    # The last key of a shard is its greatest possible one; keys of groups that are alone end two shards.
    return capacity, sorted({*ends, *alone})[:-1]


def _search(groups: DataFrame, shards: int) -> tuple[int, int, list[int]]:
    """The least capacity of ``shards`` for ``groups(key, size, part)``, whose parts share no shard; the largest group; the last keys of all shards."""
    width = (1 << 64) // RANGES
    shift = (width.bit_length() - 1)  # RANGES is a power of two, so a range is a run of leading bits
    bucket = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-(1 << 63)).cast("long")), shift)
    last = F.max("key").alias("last")
    first = groups.groupBy("part", bucket.alias("b")).agg(F.sum("size"), F.count(F.lit(1)), F.max("size"), last).collect()
    if not first:
        return 0, 0, []
    present = sorted({r["part"] for r in first})
    ranges = [{(r[1] * width, width): (r[2], r[3]) for r in first if r["part"] == k} for k in present]
    ends = [max(r["last"] for r in first if r["part"] == k) for k in present]
    total, largest = sum(r[2] for r in first), max(r[4] for r in first)
    low, high = max(largest, -(-total // shards)), total
    while True:
        profiles = [_Profile(r) for r in ranges]
        # Whatever groups the ranges hold, the least capacity lies between these two.
        low = profiles[0].least(low, high, lambda c: sum(p.needed(c, shards, 1) for p in profiles) <= shards)
        high = profiles[0].least(low, high, lambda c: sum(p.needed(c, shards, 0) for p in profiles) <= shards)
        at = [
            [(a, b) for (a, _), (_, b) in zip(p.bounds(low, shards), p.bounds(high, shards), strict=True)] for p in profiles
        ]
        if low == high and all(a == b for x in at for a, b in x):
            keys = list(ends)
            for p, x in zip(profiles, at, strict=True):
                index = [bisect_right(p.ends, a) for a, _ in x]
                keys += [p.spans[i][0] - (1 << 63) - 1 for i in index if i < len(p.spans)]
            return low, largest, sorted(keys)
        for k, (p, x) in enumerate(zip(profiles, at, strict=True)):
            if doubtful := p.doubtful(x):
                ranges[k] = _finer(groups.where(F.col("part") == present[k]), ranges[k], doubtful)


def _finer(groups: DataFrame, ranges: dict, doubtful: list[tuple[int, int]]) -> dict:
    """``ranges`` with each doubtful one summed again in parts; its width is a power of two."""
    out = {span: v for span, v in ranges.items() if span not in set(doubtful)}
    flat = F.col("key").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))  # keys from 0 up, as unsigned
    for width in sorted({w for _, w in doubtful}):
        part = max(1, width // FINER)
        heads = [_as_long(start) for start, w in doubtful if w == width]
        inside = groups.where(flat.bitwiseAND(F.lit(_as_long(-width)).cast("long")).isin(heads))
        place = flat.bitwiseAND(F.lit(_as_long(-part)).cast("long"))
        found = inside.groupBy(place.alias("start")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        for r in found.collect():
            out[r["start"] % (1 << 64), part] = (r["size"], r["n"])
    return out


def _as_long(x: int) -> int:
    """The signed long with the bits of x modulo 2**64."""
    x %= 1 << 64
    return x - (1 << 64) if x >> 63 else x


def shard_rows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot."""
    path = workspace(docs.sparkSession, "sharding")
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    rows = docs.select(
        F.col(quoted(id_col)).alias("doc_id"),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("key"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"),
    )
    rows = save(rows, f"{path}/rows")
    groups = save(rows.groupBy("key").agg(F.sum("size").alias("size")), f"{path}/groups")
    _, cuts = capacity_and_cuts(groups, shards)
    shard = sum([F.when(F.col("key") > F.lit(c).cast("long"), 1).otherwise(0) for c in cuts], F.lit(0)).cast("int")
    placed = rows.withColumn("shard", shard)
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = save(counts.select("shard", "part", before.alias("before")), f"{path}/offsets")
    local = F.row_number().over(Window.partitionBy("shard", "part").orderBy("place")) - 1
    numbered = placed.withColumn("local", local).join(offsets, ["shard", "part"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("local")).cast("long").alias("slot"))
