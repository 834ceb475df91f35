"""Removal of rows that also occur in an evaluation set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sqlloom.functions.sqltext import canonical_sql
from sqlloom.functions.text import sql_key, text_key
from sqlloom.operators.joins import fits_broadcast, measured_size, shuffled_lookup
from sqlloom.options import JoinOptions
from sqlloom.sources.scratch import materialize


def first_filled(*names: str) -> Column:
    return F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names), F.lit(""))


def blocked_question_keys(blocklist: DataFrame) -> DataFrame:
    keys = blocklist.select(text_key(first_filled("question", "prompt")).alias("question_key"))
    return keys.where("question_key <> ''").distinct()


def blocked_sql_keys(blocklist: DataFrame) -> DataFrame:
    """Both sides of the comparison take the canonical form, so spelling does not hide a leak."""
    keys = blocklist.select(sql_key(canonical_sql(first_filled("sql", "query"))).alias("sql_key"))
    return keys.where("sql_key <> ''").distinct()


def flag_leaks(
    df: DataFrame,
    blocklist: DataFrame,
    question_key: Column,
    sql_key_: Column,
    ordinal: str,
    options: JoinOptions = JoinOptions(),
) -> DataFrame:
    """Adds ``leaked``: the question or the SQL is listed. A listed pair implies a listed
    question, so pairs need no test of their own.

    Keys are compared by their digests, in one list that is written and measured once. A small list
    is broadcast. With a large one the rows are written, only (ordinal, digest) is joined to the
    list by a shuffle, and the ordinals found come back to the rows once.
    """
    questions = blocked_question_keys(blocklist).select(_digest(_QUESTION, F.col("question_key")).alias(_KEY))
    statements = blocked_sql_keys(blocklist).select(_digest(_STATEMENT, F.col("sql_key")).alias(_KEY))
    listed = materialize(questions.unionByName(statements), "blocklist")
    keyed = df.withColumns({_QUESTION: _digest(_QUESTION, question_key), _STATEMENT: _digest(_STATEMENT, sql_key_)})
    hit = F.lit(True)
    rows, size = measured_size(listed)
    if fits_broadcast(rows, size, options):
        for name in (_QUESTION, _STATEMENT):
            side = listed.select(F.col(_KEY).alias(name), hit.alias(f"{name}_hit"))
            keyed = keyed.join(F.broadcast(side), name, "left")
        leaked = F.coalesce(f"{_QUESTION}_hit", f"{_STATEMENT}_hit", F.lit(False))
        return keyed.withColumn("leaked", leaked).select(*df.columns, "leaked")
    written = materialize(keyed, "keyed")
    pairs = written.select(F.col(ordinal), F.explode(F.array(_QUESTION, _STATEMENT)).alias(_KEY))
    pairs = pairs.where(F.col(_KEY).isNotNull())
    found = shuffled_lookup(pairs, listed.withColumn("leaked", hit), _KEY, ordinal, options)
    ids = materialize(found.where("leaked").select(ordinal).distinct().withColumn("leaked", hit), "leaked")
    side = F.broadcast(ids) if fits_broadcast(*measured_size(ids), options) else ids.hint("shuffle_hash")
    back = written.join(side, ordinal, "left").withColumn("leaked", F.coalesce("leaked", F.lit(False)))
    return back.select(*df.columns, "leaked")


_KEY, _QUESTION, _STATEMENT = "__key", "__question", "__statement"


def _digest(kind: str, key: Column) -> Column:
    """Fixed-width form of a key; null for a null key."""
    return F.md5(F.concat(F.lit(f"{kind}|"), key))
