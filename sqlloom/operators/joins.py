"""Equi-join against a unique-key lookup table, safe for hot keys and large lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sqlloom.options import JoinOptions
from sqlloom.sources.scratch import materialize

_SALT = "__salt"
_HOT = "__hot"


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes, counted where the data is."""
    width = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.octet_length(F.to_json(F.struct(f.name)))
        else:
            width = width + F.lit(8)
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return int(row[0]), int(row[1])


def fits_broadcast(rows: int, size: int, options: JoinOptions) -> bool:
    return rows <= options.broadcast_max_rows and size <= options.broadcast_max_bytes


def hot_keys(probe: DataFrame, key: str, options: JoinOptions) -> DataFrame:
    """(key): keys holding more than ``hot_share`` of the probe rows; at most 1/hot_share of them.
    Counts are partial before the shuffle, so a hot key sends one row a task."""
    counts = probe.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    counts = materialize(counts, "key-counts")
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    return counts.where(F.col("__n") > total * options.hot_share).select(key)


def salt_of(key: str, spread_by: str, salts: int, hot: Column) -> Column:
    """For rows of hot keys one of the salts by the hash of ``spread_by``, for others 0. Rows without
    a key match nothing, so they take the whole hash and go anywhere rather than to the few places a
    null key hashes to."""
    spread = F.xxhash64(spread_by)
    salt = F.when(hot, F.pmod(spread, F.lit(salts))).otherwise(F.lit(0).cast("bigint"))
    return F.when(F.col(key).isNull(), spread).otherwise(salt)


def shuffled_lookup(
    probe: DataFrame, table: DataFrame, key: str, spread_by: str, options: JoinOptions = JoinOptions()
) -> DataFrame:
    """Left join on the unique ``key`` of ``table`` by a shuffle, whatever the sizes.

    Only keys found hot are copied once per salt, and their rows spread over the salts; the list of
    hot keys is at most 1/hot_share long and so broadcast.
    """
    hot = F.broadcast(hot_keys(probe, key, options).withColumn(_HOT, F.lit(True)))
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(options.salts - 1).cast("bigint"))
    one = F.array(F.lit(0).cast("bigint"))
    is_hot = F.coalesce(_HOT, F.lit(False))
    copies = table.join(hot, key, "left").withColumn(_SALT, F.explode(F.when(is_hot, every_salt).otherwise(one))).drop(_HOT)
    salted = probe.join(hot, key, "left").withColumn(_SALT, salt_of(key, spread_by, options.salts, is_hot)).drop(_HOT)
    # Without the hint the copies could be broadcast when their files are small.
    return salted.join(copies.hint("shuffle_hash"), [key, _SALT], "left").drop(_SALT)


def lookup(
    probe: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: str,
    options: JoinOptions = JoinOptions(),
) -> DataFrame:
    """Left join on ``key``, which must be unique in ``table``.

    The table is written once, measured, and joined from the files. A small one is broadcast and
    the probe side stays where it is; a larger one is joined by ``shuffled_lookup``, with the rows of
    hot keys shared by many tasks. Both ways give the same rows.
    """
    table = materialize(table, "lookup")
    rows, size = measured_size(table)
    if fits_broadcast(rows, size, options):
        return probe.join(F.broadcast(table), key, "left")
    return shuffled_lookup(probe, table, key, spread_by, options)
