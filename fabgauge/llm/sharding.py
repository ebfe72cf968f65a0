"""Sharding by minimax contiguous partition of atomic groups.

Groups of rows that must stay together stand in a fixed order: first the heavy ones by size, then
all others by digest. The smallest shard capacity for which greedy filling needs no more than the
given shards is found by binary search, and the order is cut there. The search runs on the driver
over a bounded number of sums: heavy groups one by one (each over a thousandth of a shard, so few),
the others summed by digest prefix. Around each cut the prefixes are then refined until they are single
groups, so the cuts are those of the search over all groups.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabgauge.llm.common import numbered, stored

# A group is heavy above this part of an even shard.
HEAVY_PART = 1000
# Hexadecimal digits of the digest by which small groups are summed first, and added when refined.
DIGITS, MORE_DIGITS = 4, 3


@dataclass
class Unit:
    """Adjacent groups in the order: a heavy group, or all small groups with a digest prefix."""

    key: str
    size: int
    groups: int


@dataclass
class ShardPlan:
    """``heavy``: shard of each heavy group by digest. ``cuts``: the first digest of each further
    shard of small groups, beginning with shard ``first``."""

    shards: int
    capacity: int
    heavy: dict[str, int]
    first: int
    cuts: list[str]


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The smallest capacity with which greedy filling in order needs at most ``shards``."""
    ends = list(accumulate(sizes))
    low = max([0, *sizes, -(-(ends[-1] if ends else 0) // shards)])
    high = max(low, ends[-1] if ends else 0)
    while low < high:
        middle = (low + high) // 2
        if len(greedy_cuts(ends, middle)) < shards:
            high = middle
        else:
            low = middle + 1
    return low


def greedy_cuts(ends: list[int], capacity: int) -> list[int]:
    """Positions at which a new shard begins when each is filled as far as it goes."""
    cuts, filled = [], 0
    while True:
        at = bisect_right(ends, filled + capacity)
        if at >= len(ends):
            return cuts
        cuts.append(at)
        filled = ends[at - 1] if at else 0


def balanced_cuts(sizes: list[int], shards: int) -> tuple[int, list[int]]:
    """Capacity and cuts. A group that alone decides the capacity gets a shard of its own, and the
    search goes on with the rest, so that one large group doesn't leave other shards empty."""
    alone, left, top = 0, sum(sizes), 0
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) > left:
        top = max(top, sizes[alone])
        left -= sizes[alone]
        alone += 1
    rest = sizes[alone:]
    capacity = smallest_capacity(rest, shards - alone)
    cuts = [alone + c for c in greedy_cuts(list(accumulate(rest)), capacity)]
    own = [*range(1, alone), *([alone] if alone and rest else [])]
    return max(top, capacity), own + cuts


def group_sizes(docs: DataFrame) -> DataFrame:
    """Rows and bytes of each group: rows of ``docs`` have group (a hex digest) and size."""
    return docs.groupBy("group").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("copies")
    )


def plan_shards(groups: DataFrame, shards: int) -> ShardPlan:
    """Cut the groups (columns group, size) into ``shards`` contiguous shards."""
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    heavy_size = total // (shards * HEAVY_PART)
    large = groups.filter(F.col("size") > heavy_size).select("group", "size").collect()
    heavy = [Unit(r["group"], r["size"], 1) for r in sorted(large, key=lambda r: (-r["size"], r["group"]))]
    small = groups.filter(F.col("size") <= heavy_size)

    def summed(rows: DataFrame, digits: int) -> list[Unit]:
        sums = rows.groupBy(F.substring("group", 1, digits).alias("key")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups")
        )
        return [Unit(*r) for r in sums.collect()]

    units = sorted(summed(small, DIGITS), key=lambda u: u.key)
    digits = DIGITS
    while True:
        sizes = [u.size for u in (*heavy, *units)]
        capacity, cuts = balanced_cuts(sizes, shards)
        at = {c - len(heavy) for c in cuts}
        near = _uncertain(sizes, len(heavy), shards, capacity, cuts)
        coarse = [k for k in sorted(at | near) if 0 <= k < len(units) and units[k].groups > 1]
        if not coarse or digits >= 64:
            break
        # Refine what a cut can fall into; everything else keeps its sum.
        previous, digits = digits, digits + MORE_DIGITS
        keys = {units[k].key for k in coarse}
        wanted = small.join(
            F.broadcast(small.sparkSession.createDataFrame([(k, len(k)) for k in sorted(keys)], "prefix string, n int")),
            F.expr(" OR ".join(f"(n = {n} AND substring(group, 1, {n}) = prefix)" for n in sorted({len(k) for k in keys}))),
            "left_semi",
        )
        finer = summed(wanted, digits)
        units = sorted([u for u in units if u.key not in keys] + finer, key=lambda u: u.key)
    shard_at = [bisect_right(cuts, k) for k in range(len(heavy) + 1)]
    return ShardPlan(
        shards,
        capacity,
        {u.key: shard_at[k] for k, u in enumerate(heavy)},
        shard_at[len(heavy)] if units else 0,
        [units[c - len(heavy)].key for c in cuts if c > len(heavy)],
    )


def _uncertain(
    sizes: list[int], heavy: int, shards: int, capacity: int, cuts: list[int]
) -> set[int]:
    """Units in which a cut may lie once units are split: the true capacity is at most one unit
    smaller, so the k-th cut moves by at most k times the largest unit."""
    if not sizes:
        return set()
    ends = list(accumulate(sizes))
    slack = max([0, *sizes[heavy:]])
    found: set[int] = set()
    for k, cut in enumerate(cuts, 1):
        if cut < heavy:
            continue
        middle = ends[cut - 1] if cut else 0
        low = bisect_right(ends, middle - (k + 1) * slack)
        high = bisect_right(ends, middle + slack)
        found.update(range(low - heavy, high - heavy + 1))
    return found


def assign_shards(
    docs: DataFrame, shards: int, text_column: str = "text", overhead: int = 8
) -> tuple[DataFrame, ShardPlan]:
    """Add ``size``, ``group`` and ``shard`` to every row, and return the plan beside.

    A row's size is the UTF-8 bytes of its text plus ``overhead``; rows with equal texts stay in one
    shard, and a null text counts as the empty one. Shard sizes are near equal, unless one
    group is larger than an even share, which then has its own shard. Other columns are kept; columns named size, group
    or shard are replaced. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    sized = docs.withColumns(
        {"size": F.octet_length(text).cast("long") + overhead, "group": F.sha2(text, 256)}
    )
    plan = plan_shards(stored(group_sizes(sized), "groups"), shards)
    shard = F.lit(plan.first)
    for cut in plan.cuts:
        shard = shard + (F.col("group") >= cut).cast("int")
    if plan.heavy:
        # At most shards * HEAVY_PART rows.
        rows = docs.sparkSession.createDataFrame(list(plan.heavy.items()), "group string, _own int")
        sized = sized.join(F.broadcast(rows), "group", "left")
        shard = F.coalesce("_own", shard)
    return sized.withColumn("shard", shard).drop("_own"), plan


def shard_slots(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, group, shard and slot (gapless from 0 in each shard) of every row."""
    assigned, _ = assign_shards(docs.select("doc_id", "text"), shards)
    rows = assigned.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        "group",
        "shard",
    )
    return numbered(stored(rows, "assigned"), ["shard"], ["doc_id", "group"], "slot")
