"""Shards by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text are one group and stay together. Groups are sorted by size, and each enters the
bin with the tightest remaining capacity, found in a balanced tree of capacities. With a given
number of shards the capacity is the least at which best fit needs no more bins (bisection).

Best fit itself is a sequence of choices, so it runs over a bounded number of items: groups of at
least 1/``GRAIN`` of all bytes (at most ``GRAIN`` of them can exist) are items of their own; all
smaller groups are gathered by hash into at most ``BUNDLES`` bundles, which are items too. Every
group takes its item's bin. Nothing is dropped, and the bound does not depend on the input.

Defined cases: a null text has no bytes and is one group with the empty text; repeated rows have
slots of their own; a group larger than any fair share sets the capacity; an empty table gives no
rows; other columns are left alone.
"""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sqlloom.sources.scratch import RunScratch

GRAIN = 32_768
BUNDLES = 32_768
SLICES = 1_024  # parts of a shard that are numbered apart


class CapacityTree:
    """Bins by remaining capacity, in a tree of blocks: the tightest fit takes logarithmic time."""

    BLOCK = 512

    def __init__(self):
        self.blocks: list[list[tuple[int, int]]] = []

    def add(self, entry: tuple[int, int]) -> None:
        if not self.blocks:
            self.blocks.append([entry])
            return
        at = min(bisect.bisect_left([b[-1] for b in self.blocks], entry), len(self.blocks) - 1)
        block = self.blocks[at]
        bisect.insort(block, entry)
        if len(block) > 2 * self.BLOCK:
            self.blocks[at : at + 1] = [block[: self.BLOCK], block[self.BLOCK :]]

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the least (capacity, bin) with capacity >= size."""
        at = bisect.bisect_left([b[-1] for b in self.blocks], (size, -1))
        if at == len(self.blocks):
            return None
        block = self.blocks[at]
        entry = block.pop(bisect.bisect_left(block, (size, -1)))
        if not block:
            self.blocks.pop(at)
        return entry


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of each of the sizes, which must be in decreasing order and fit a bin. None if it takes
    more than ``most`` bins."""
    tree, bins, out = CapacityTree(), 0, []
    for size in sizes:
        entry = tree.take(size)
        if entry is None:
            if bins == most:
                return None
            entry, bins = (capacity, bins), bins + 1
        out.append(entry[1])
        tree.add((entry[0] - size, entry[1]))
    return out


def least_capacity(sizes: list[int], bins: int) -> list[int]:
    """Best fit at the least capacity for which it takes at most ``bins`` bins."""
    if not sizes:
        return []
    low, high = max(sizes[0], -(-sum(sizes) // bins)), max(sizes[0], 2 * -(-sum(sizes) // bins))
    while best_fit(sizes, high, bins) is None:  # can't be at twice the mean; kept as a guard
        high *= 2
    while low < high:
        middle = (low + high) // 2
        if best_fit(sizes, middle, bins) is None:
            low = middle + 1
        else:
            high = middle
    return best_fit(sizes, high, bins)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the group of every row; no text goes on."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("group"),
    )


def with_items(rows: DataFrame, total: int, grain: int, bundles: int) -> DataFrame:
    """The item of every group: itself when it is large, else a bundle."""
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    bundle = F.format_string("b%d", F.pmod(F.xxhash64("group"), F.lit(bundles)))
    large = F.col("bytes") * grain >= total
    return groups.select("group", "bytes", F.when(large, F.concat(F.lit("g"), F.hex("group"))).otherwise(bundle).alias("item"))


def assign(
    docs: DataFrame, shards: int | None = None, capacity: int | None = None, grain: int = GRAIN, bundles: int = BUNDLES
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: into ``shards`` shards of near equal bytes, or into as
    few shards of ``capacity`` bytes as best fit takes (a group larger than that has its own)."""
    spark = docs.sparkSession
    scratch = RunScratch(spark, "sharding")
    rows = scratch.write(sized(docs), "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = scratch.write(with_items(rows, total, grain, bundles), "groups")
    # At most grain + bundles rows, by construction.
    items = groups.groupBy("item").agg(F.sum("bytes").alias("bytes")).orderBy(F.desc("bytes"), "item").collect()
    sizes = [r["bytes"] for r in items]
    if shards is not None:
        bins = least_capacity(sizes, shards)
    else:
        bins = best_fit(sizes, max([capacity, *sizes[:1]]))
    plan = spark.createDataFrame(
        pd.DataFrame({"item": [r["item"] for r in items], "shard": bins}),
        T.StructType([T.StructField("item", T.StringType()), T.StructField("shard", T.IntegerType())]),
    )
    # Both lookups are on groups, one row each, and rows of one group spread by Spark's skew join.
    where = groups.join(F.broadcast(plan), "item").select("group", "shard")
    placed = rows.join(where, "group").select("doc_id", "size", "text_crc32", "shard")
    return with_slots(scratch.write(placed, "placed"))


def with_slots(placed: DataFrame, slices: int = SLICES) -> DataFrame:
    """Number the rows of each shard from 0 without gaps: slices of a shard are numbered apart and
    shifted by the rows in front of them, so no task holds a whole shard."""
    cut = placed.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slices)).cast("int"))
    counts = cut.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    shifts = counts.select("shard", "slice", (F.sum("n").over(Window.partitionBy("shard").orderBy("slice")) - F.col("n")).alias("shift"))
    local = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size"))
    return cut.withColumn("local", local).join(shifts, ["shard", "slice"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("shift") + F.col("local") - 1).alias("slot")
    )
