"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (equal texts) of one size are alike, so the packing is worked out on counts: sizes in falling order, each with
its number of groups; a size's groups enter the tightest bin that still takes one, as many as it takes, then the next.
The remaining capacities are kept in a balanced tree. The counts are gathered in full; sizes from 8192 on are rounded
up to 13 binary digits, so there are under 200,000 different ones whatever the input, and no bin is ever overfilled by
rounding. Everything by row (ranks of groups within their size, slots within a shard) is numbered in blocks by Spark.
"""

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.tables import blocks, running, written

DIGITS = 13
LEAF = 256


class Capacities:
    """(remaining, bin) pairs in order, in a balanced tree of two levels: leaves of up to 2 * LEAF pairs each."""

    def __init__(self):
        self.leaves: list[list[tuple[int, int]]] = [[]]
        self.tops: list[tuple[int, int]] = []

    def add(self, remaining: int, number: int) -> None:
        i = bisect.bisect_left(self.tops, (remaining, number))
        leaf = self.leaves[i]
        bisect.insort(leaf, (remaining, number))
        if len(leaf) > 2 * LEAF:
            self.leaves[i:i + 1] = [leaf[:LEAF], leaf[LEAF:]]
            self.tops.insert(i, leaf[LEAF - 1])

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and gives the tightest bin that takes `size`."""
        i = bisect.bisect_left(self.tops, (size, -1))
        for leaf in self.leaves[i:]:
            at = bisect.bisect_left(leaf, (size, -1))
            if at < len(leaf):
                return leaf.pop(at)
        return None


def rounded(size: int) -> int:
    extra = max(0, size.bit_length() - DIGITS)
    return (size + (1 << extra) - 1) >> extra << extra


def best_fit_decreasing(counts: list[tuple[int, int]], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """(size, first rank, rank after the last, bin) and the number of bins, for (size, number of groups).

    A group larger than the capacity gets a bin of its own, filled by it alone.
    """
    tree, out, bins = Capacities(), [], 0
    for size, count in sorted(counts, reverse=True):
        rank = 0
        while rank < count:
            found = tree.take(size)
            if found is None:
                found, bins = (capacity, bins), bins + 1
            remaining, number = found
            n = min(count - rank, remaining // size) if remaining >= size else 1
            out.append((size, rank, rank + n, number))
            tree.add(max(0, remaining - n * size), number)
            rank += n
    return out, bins


def into_bins(counts: list[tuple[int, int]], n_bins: int) -> list[tuple[int, int, int, int]]:
    """The packing under the smallest capacity for which best-fit-decreasing needs at most `n_bins`.

    A group above the fair share of the bins left takes one of them alone; the others share the rest.
    """
    counts, own, left = sorted(counts, reverse=True), [], n_bins
    total, i, used = sum(s * n for s, n in counts), 0, 0
    while i < len(counts) and left > 1 and counts[i][0] * left > total:
        own.append((counts[i][0], used, used + 1, n_bins - left))
        total, left, used = total - counts[i][0], left - 1, used + 1
        if used == counts[i][1]:
            i, used = i + 1, 0
    rest = [(s, n - used * (k == 0)) for k, (s, n) in enumerate(counts[i:])]
    if not rest:
        return own
    low, high = max(rest[0][0], -(-total // left)), total
    best = best_fit_decreasing(rest, high)[0]
    while low < high:
        middle = (low + high) // 2
        found, bins = best_fit_decreasing(rest, middle)
        low, high, best = (low, middle, found) if bins <= left else (middle + 1, high, best)
    shift = {rest[0][0]: used}
    return own + [(s, a + shift.get(s, 0), b + shift.get(s, 0), n_bins - left + number) for s, a, b, number in best]


def packed(docs: DataFrame, n_shards: int | None = 8, capacity: int | None = None, text: str = "text",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of each row, equal texts in one shard.

    With `n_shards`, sizes per shard come out near equal; without, as few shards as best fit opens at `capacity`.
    Null text: size 1, a group of its own, apart from the empty text. Repeated rows are members of one group and get
    slots of their own. A group beyond the fair share has a shard to itself. Empty table: no rows. Other columns are
    not read, but for those named in `keep`.
    """
    spark = docs.sparkSession
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(data).alias("text_crc32"),
        F.when(F.col(text).isNotNull(), F.xxhash64(text)).alias("_hash"), *keep), "pack-rows")
    rows = rows.withColumn("_group", F.xxhash64(F.coalesce("_hash", F.lit(0)), "text_crc32", "size",
                                                F.col("_hash").isNull()))
    extra = F.expr(f"greatest(0, length(conv(cast(bytes AS string), 10, 2)) - {DIGITS})")
    groups = (rows.groupBy("_group").agg(F.sum("size").alias("bytes")).withColumn("extra", extra)
              .selectExpr("_group", "shiftleft(shiftright(bytes + shiftleft(1L, extra) - 1, extra), extra) AS class"))
    groups = written(groups, "pack-groups")
    sizes = groups.groupBy("class").count()
    counts = [(r["class"], r["count"]) for r in sizes.toLocalIterator()]
    plan = (into_bins(counts, n_shards) if n_shards is not None
            else best_fit_decreasing(counts, rounded(capacity))[0]) if counts else []
    places = spark.createDataFrame(plan, "class long, low long, high long, shard int")
    n_groups = sum(n for _, n in counts)
    ranked = running(groups.withColumn("block", F.pmod("_group", F.lit(blocks(n_groups)))), ["class"], "block",
                     [F.col("_group")], F.lit(1), "rank")
    shard_of = (ranked.join(F.broadcast(places), "class")
                .where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).select("_group", "shard"))
    placed = written(rows.join(written(shard_of, "pack-shards"), "_group").drop("_group", "_hash"), "pack-placed")
    block: Column = F.pmod(F.xxhash64("doc_id"), F.lit(blocks(rows.count())))
    slots = running(placed.withColumn("block", block), ["shard", ], "block",
                    [F.col("doc_id"), F.col("size"), F.col("text_crc32")], F.lit(1), "slot")
    return slots.drop("block")


def query(docs: DataFrame) -> DataFrame:
    return packed(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                               F.lit(None).cast("int").alias("grown_shard"))
