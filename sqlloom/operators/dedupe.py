"""Keep-first deduplication on normal forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sqlloom.functions.text import sql_key, text_key


def dedupe_keys(fields: tuple[str, ...]) -> list[Column]:
    """Comparison key per field: SQL key for ``sql``, text key for any other."""
    return [(sql_key(f) if f == "sql" else text_key(f)).alias(f"{f}_key") for f in fields]


def dedupe_digest(fields: tuple[str, ...]) -> Column:
    """Fixed-width digest of all keys. Lengths go in front of the parts, so no choice of text
    can make two different key lists meet."""
    parts: list[Column] = []
    for key in dedupe_keys(fields):
        parts += [F.length(key).cast("string"), F.lit(":"), key]
    return F.sha2(F.concat(*parts), 256)


def keep_first(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """One row per key: the one with the smallest ordinal.

    The filter on row_number makes Spark cut each key to one row per task before the shuffle
    (WindowGroupLimit), so a key held by a third of the table moves only one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(ordinal)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")
