"""Minimax contiguous sharding with DataFrame and SQL functions only.

Documents with equal texts form an atomic group.  Groups are ordered by a 60-bit digest key of
their text and cut into ``n_shards`` contiguous runs so that the largest run is as small as can be:
the smallest capacity for which a greedy fill needs no more than ``n_shards`` shards is found by
binary search, and the cuts are those of that greedy fill.

The order is never collected.  The driver sees sums over digest ranges (at most ``2**first_bits``
rows), works out between which ranges each cut can fall for any capacity that is still possible,
and asks for finer sums of just these ranges until they hold single groups.  So each request
returns a bounded number of rows whatever the input's size.

Each group heavier than any fair share is a shard of its own; the search is then repeated over the
rest, so one hot text does not leave other shards empty.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

KEY_BITS = 60


def digest_key(text: Column) -> Column:
    """The first 60 bits of the text's SHA-256, as a long that is never negative.

    Two different texts with equal keys merely share an atomic group.
    """
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, KEY_BITS // 4), 16, 10).cast("long")


@dataclass(frozen=True)
class Run:
    """Groups with keys in [lo, hi): their weight, and how many groups they are."""

    lo: int
    hi: int
    weight: int
    groups: int


def fill(prefix: list[int], start: int, end: int, capacity: int) -> list[int]:
    """Ends of the greedy shards over runs start..end-1; empty when some run exceeds the capacity."""
    ends = []
    while start < end:
        stop = min(end, bisect_right(prefix, prefix[start] + capacity) - 1)
        if stop <= start:
            return []
        ends.append(stop)
        start = stop
    return ends


def smallest_capacity(prefix: list[int], segments: list[tuple[int, int]], shards: int, least: int) -> int:
    """Binary search of the least capacity with which the segments need no more than ``shards`` shards."""
    lo, hi = max(least, 1), max(prefix[-1], least, 1)

    def fits(capacity: int) -> bool:
        used = 0
        for start, end in segments:
            if start < end:
                ends = fill(prefix, start, end, capacity)
                if not ends:
                    return False
                used += len(ends)
        return used <= shards

    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if fits(mid) else (mid + 1, hi)
    return lo


def plan_cuts(runs: list[Run], shards: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """(shards as (first run, end run, weight), segments as (first run, end run, shards, capacity)) of the minimax plan.

    While the binding shard is one run of one group, that run becomes a shard of its own.  With the
    shards that a segment gets at the common capacity, it is cut at its own smallest capacity.
    """
    prefix = [0, *accumulate(r.weight for r in runs)]
    open_, left, cuts = [(0, len(runs))] * bool(runs), shards, []
    capacity = 1
    while open_:
        capacity = smallest_capacity(prefix, open_, left, 0)
        rest = sum(prefix[b] - prefix[a] for a, b in open_)
        heavy = next((i for a, b in open_ for i in range(a, b) if runs[i].weight == capacity and runs[i].groups == 1 and b - a > 1), None)
        if heavy is None or capacity * left <= rest + rest // 64:
            break
        trial = [p for a, b in open_ for p in ([(a, heavy), (heavy + 1, b)] if a <= heavy < b else [(a, b)]) if p[0] < p[1]]
        if len(trial) > left - 1:
            break
        cuts.append((heavy, heavy + 1))
        open_, left = trial, left - 1
    segments = []
    for start, end in open_:
        k = len(fill(prefix, start, end, capacity))
        own = smallest_capacity(prefix, [(start, end)], k, 0)
        segments.append((start, end, k, own))
        for stop in fill(prefix, start, end, own):
            cuts.append((start, stop))
            start = stop
    return [(a, b, prefix[b] - prefix[a]) for a, b in sorted(cuts)], segments


def doubtful(runs: list[Run], shards: int) -> list[tuple[int, int]]:
    """Intervals (first, end) of runs, at most one for each cut, in which cuts of the exact plan may lie.

    A capacity that is too small even if runs could be cut anywhere is a lower bound; the plan that
    cuts between runs only gives an upper bound.  Between both, the k-th cut of a segment lies
    between the greedy fill at the lower and k shares at the upper bound.  Intervals of single
    groups alone need no finer sums.
    """
    prefix = [0, *accumulate(r.weight for r in runs)]
    found: list[tuple[int, int]] = []
    for a, b, k, high in plan_cuts(runs, shards)[1]:
        low = max(-(-(prefix[b] - prefix[a]) // k), max((r.weight for r in runs[a:b] if r.groups == 1), default=1))
        low = min(low, high)
        first = last = prefix[a]
        while first < prefix[b] and len(found) <= 4 * shards:
            # slowest fill: a run that does not fit whole is left out whole
            i = bisect_right(prefix, first + low) - 1
            first = max(prefix[min(b, i)], first + 1)
            last = min(prefix[b], last + high)
            lo, hi = max(a, bisect_right(prefix, first) - 1), min(b, bisect_right(prefix, last))
            inner = [j for j in range(lo, hi) if runs[j].groups > 1]
            if inner:
                if found and inner[0] < found[-1][1]:
                    found[-1] = (min(found[-1][0], inner[0]), max(found[-1][1], inner[-1] + 1))
                else:
                    found.append((inner[0], inner[-1] + 1))
    return found


def summed(groups: DataFrame, shift: int, heavy: list[int]) -> DataFrame:
    """Weights and group counts by key >> shift, with each heavy group apart."""
    step = F.lit(0)
    for k in heavy:
        step = step + F.when(F.col("gkey") > k, 2).when(F.col("gkey") == k, 1).otherwise(0)
    return (
        groups.groupBy(F.shiftright("gkey", shift).alias("cell"), step.alias("step"))
        .agg(F.sum("weight").alias("weight"), F.count("*").alias("n"), F.min("gkey").alias("lo"), F.max("gkey").alias("hi"))
    )


def minimax_cuts(groups: DataFrame, n_shards: int = 8, first_bits: int = 14, step_bits: int = 7) -> list[int]:
    """First keys of shards 1, 2, ... for ``groups(gkey, weight)``; rows sent to the driver are bounded."""
    total = groups.agg(F.sum("weight")).first()[0] or 0
    heavy = sorted(r.gkey for r in groups.where(F.col("weight") * 2 * n_shards > total).select("gkey").collect())

    def fetch(source: DataFrame, shift: int) -> list[Run]:
        rows = sorted(summed(source, shift, heavy).collect(), key=lambda r: r.lo)
        return [Run(r.lo, r.hi + 1, r.weight, r.n) for r in rows]

    shift = KEY_BITS - first_bits
    runs = fetch(groups, shift)
    while shift > 0 and (open_ := doubtful(runs, n_shards)):
        shift = max(0, shift - step_bits)
        where = F.lit(False)
        for a, b in open_:
            where = where | ((F.col("gkey") >= runs[a].lo) & (F.col("gkey") < runs[b - 1].hi))
        inside = {i for a, b in open_ for i in range(a, b)}
        kept = [r for i, r in enumerate(runs) if i not in inside]
        runs = sorted(kept + fetch(groups.where(where), shift), key=lambda r: r.lo)
    if doubtful(runs, n_shards):
        raise RuntimeError("cuts are not settled between single groups")
    shards, _ = plan_cuts(runs, n_shards)
    return [runs[a].lo for a, _, _ in shards[1:]]


def shard_documents(docs: DataFrame, n_shards: int = 8, slot_cells: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its shard and its place in the shard.

    Returns doc_id, size (UTF-8 bytes + 1), text_crc32, law ('bytes'), shard, slot (0, 1, ... in each
    shard), grown_shard (null: this law is not by key).  A null text counts as empty.  Repeated rows
    and repeated ids each keep a slot of their own.  An empty table gives an empty result.  Other
    columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            digest_key(text).alias("gkey"),
        ),
        "keyed",
    )
    groups = cut(keyed.groupBy("gkey").agg(F.sum("size").alias("weight")), "groups")
    shard = F.lit(0)
    for k in minimax_cuts(groups, n_shards):
        shard = shard + F.when(F.col("gkey") >= k, 1).otherwise(0)
    placed = keyed.withColumn("shard", shard.cast("int")).withColumn("cell", F.pmod(F.xxhash64("doc_id", "gkey"), F.lit(slot_cells)).cast("int"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "cell").count().select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "gkey")
    # offsets: n_shards * slot_cells rows at most
    return (
        placed.withColumn("nth", F.row_number().over(within))
        .join(F.broadcast(offsets), ["shard", "cell"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("base") + F.col("nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
