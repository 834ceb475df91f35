"""Reading and scoring model answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sqlloom.functions.sqltext import canonical_sql
from sqlloom.functions.text import drop_turn_marker, extract_answer, sql_key
from sqlloom.functions.tokens import TURN_END


def answer_sql(response: Column | str) -> Column:
    """SQL of a decoded answer, with or without special tokens left in."""
    return extract_answer(drop_turn_marker(response, TURN_END))


def match_key(sql: Column | str) -> Column:
    return sql_key(canonical_sql(sql))


def exact_match(
    predicted: DataFrame, gold: DataFrame, ordinal: str, groups: list[str]
) -> DataFrame:
    """(groups, n, matched, rate). ``predicted`` has response, ``gold`` has gold_sql; a gold row
    without an answer counts as a miss. The id is unique, and groups are counted partially
    before the shuffle."""
    joined = gold.join(predicted.select(ordinal, "response"), ordinal, "left")
    hit = F.coalesce(match_key(answer_sql("response")) == match_key("gold_sql"), F.lit(False))
    scored = joined.select(*groups, hit.alias("hit"))
    return scored.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("hit").alias("matched"),
        (F.count_if("hit") / F.count(F.lit(1))).alias("rate"),
    )
