"""Seeded order, sample and exact-size split without a global sort.

Rows are ordered by a digest of their id, so the order survives repartitioning. Sampling and
splitting only ask on which side of a few ranks a row falls. The keys sitting at those ranks are
found from a histogram of key prefixes (at most 65,536 rows) and one look into the buckets the
ranks fall in; the full rows are then labelled in place, without being moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sqlloom.options import SplitRatios

PREFIX = 4


def order_key(ordinal: str, seed: int, purpose: str) -> Column:
    """Unique, sortable text per id; ``purpose`` keeps different uses independent."""
    text = F.col(ordinal).cast("string")
    return F.concat(F.md5(F.concat(F.lit(f"{seed}|{purpose}|"), text)), F.lit(":"), text)


def keys_at_ranks(keys: DataFrame, ranks: dict[str, Column]) -> DataFrame:
    """One row: per name the ``key`` at that 0-based rank, null when the rank is past the end.

    Ranks are expressions over ``total``, the row count of ``keys``.
    """
    prefix = F.substring("key", 1, PREFIX)
    histogram = keys.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    # Unpartitioned windows: over the bounded histogram only.
    everything = Window.orderBy("prefix")
    placed = histogram.select(
        "prefix",
        "n",
        (F.sum("n").over(everything) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    wanted = F.array(
        *(
            F.struct(F.lit(name).alias("name"), rank.cast("bigint").alias("rank"))
            for name, rank in ranks.items()
        )
    )
    buckets = (
        placed.withColumn("w", F.explode(wanted))
        .where("w.rank >= before AND w.rank < before + n")
        .select("prefix", F.col("w.name").alias("name"), (F.col("w.rank") - F.col("before")).alias("offset"))
    )
    # At most one row per name on the broadcast side.
    inside = keys.select("key", prefix.alias("prefix")).join(F.broadcast(buckets), "prefix")
    position = F.row_number().over(Window.partitionBy("name").orderBy("key"))
    found = inside.withColumn("position", position).where("position = offset + 1")
    return found.agg(*(F.max(F.when(F.col("name") == n, F.col("key"))).alias(n) for n in ranks))


def sample(
    df: DataFrame, ordinal: str, size: int | None, seed: int, ids: DataFrame | None = None
) -> DataFrame:
    """Exactly min(size, rows) rows without replacement; no size means all of them.

    ``ids``, when given, has the ids of ``df`` in a form that is cheaper to read.
    """
    if not size:
        return df
    key = order_key(ordinal, seed, "sample")
    keys = (df if ids is None else ids).select(key.alias("key"))
    edge = keys_at_ranks(keys, {"edge": F.lit(int(size))}).scalar()
    return df.where(F.coalesce(key < edge, F.lit(True)))


def split(
    df: DataFrame, ordinal: str, ratios: SplitRatios, seed: int, ids: DataFrame | None = None
) -> DataFrame:
    """Adds ``split``: the first int(n*train) rows, the next int(n*val), and all the rest as test.

    ``ids`` as in ``sample``.
    """
    key = order_key(ordinal, seed, "split")
    total = F.col("total").cast("double")
    train_end = F.floor(total * F.lit(float(ratios.train)))
    val_end = train_end + F.floor(total * F.lit(float(ratios.val)))
    keys = (df if ids is None else ids).select(key.alias("key"))
    edges = keys_at_ranks(keys, {"train_end": train_end, "val_end": val_end})
    below_train = F.coalesce(key < edges.select("train_end").scalar(), F.lit(True))
    below_val = F.coalesce(key < edges.select("val_end").scalar(), F.lit(True))
    label = F.when(below_train, F.lit("train")).when(below_val, F.lit("val")).otherwise(F.lit("test"))
    return df.withColumn("split", label)


def top_k(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values, ties by name."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.col(column)).limit(k)


def rank_within(df: DataFrame, group: str, ordinal: str, seed: int, purpose: str) -> DataFrame:
    """Adds the 0-based ``rank`` inside ``group`` by seeded order.

    A group of any size is cut into 4,096 key ranges that are ranked apart and then shifted by
    the rows in front of them, so no task holds a whole group.
    """
    keyed = df.withColumn("__key", order_key(ordinal, seed, purpose))
    keyed = keyed.withColumn("__range", F.substring("__key", 1, 3))
    sizes = keyed.groupBy(group, "__range").agg(F.count(F.lit(1)).alias("__n"))
    in_front = F.sum("__n").over(Window.partitionBy(group).orderBy("__range")) - F.col("__n")
    shifts = sizes.select(group, "__range", in_front.alias("__shift"))
    local = F.row_number().over(Window.partitionBy(group, "__range").orderBy("__key"))
    ranked = keyed.withColumn("__local", local).join(shifts, [group, "__range"])
    return ranked.withColumn("rank", F.col("__shift") + F.col("__local") - 1).drop(
        "__key", "__range", "__local", "__shift"
    )
