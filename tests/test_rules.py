"""Row rules and the validity check."""

import pytest
from pyspark.sql import functions as F

from sqlloom.functions.validity import compiles, open_checker, valid_sqlite
from sqlloom.operators import filters
from sqlloom.options import BLOCKED_DIALECT_PATTERNS, FilterOptions, SplitRatios

RULES = FilterOptions()


@pytest.mark.parametrize(
    "sql, valid",
    [
        ("SELECT a FROM missing_table", True),
        ("SELECT a FROM t;", True),
        ("SELECT 'a;b' FROM t", True),
        ("SELECT a FROM t; SELECT b FROM t", False),
        ("SELECT a FROM missing; garbage", False),
        ("SELECT FROM WHERE ;", False),
        ("SELECT id FROM t WHERE (a >", False),
        ("select top 5 id from t", False),
        ("( SELECT 1 )", False),
        ("SELECT 'open", False),
        ("", False),
        ("SELECT 1 -- a; b", True),
        ("QUERY PLAN SELECT 1", False),
        ("EXPLAIN SELECT 1", True),
        ("ATTACH 'x.db' AS y", True),
        ("SELECT a\0b", False),
    ],
)
def test_compiles(sql, valid):
    assert compiles(open_checker(), sql) is valid


def test_nothing_is_executed(tmp_path):
    checker = open_checker()
    target = tmp_path / "made.db"
    compiles(checker, f"ATTACH '{target}' AS y")
    compiles(checker, "CREATE TABLE t (a)")
    assert not target.exists()
    assert checker.execute("SELECT count(*) FROM sqlite_master").fetchone() == (0,)


def test_valid_sqlite_keeps_nulls_and_order(spark):
    rows = [(0, "SELECT 1"), (1, None), (2, "SELECT"), (3, "SELECT 1"), (4, None)]
    df = spark.createDataFrame(rows, "i int, s string").repartition(3)
    got = {r.i: r.v for r in df.select("i", valid_sqlite("s").alias("v")).collect()}
    assert got == {0: True, 1: None, 2: False, 3: True, 4: None}


def flags(spark, texts, rule):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r.v for r in sorted(df.select("i", rule.alias("v")).collect())]


def test_read_only(spark):
    texts = ["SELECT updated_at FROM t", "SELECT 'please DROP it'", "select replace(a, 'b', 'c') from t", "WITH x AS (SELECT 1) SELECT * FROM x", "SELECT drop_, _drop, Drop1 FROM t", "SELECT éDROP FROM t", "DELETE FROM t", "SELECT a FROM t; drop table t"]
    assert flags(spark, texts, filters.is_read_only(F.col("s"), RULES)) == [True, False, False, True, True, True, False, False]


def test_each_dialect_pattern_is_found(spark):
    hits = ["date_sub (", "CURDATE(", "now()", "sysdate", "datediff(", "DATEADD (", "TIMESTAMPDIFF(", "interval", "ilike", "qualify", "unnest", "string_agg(", "listagg (", "array [", "struct(", "top  10", "cross apply", "outer   apply", "try_cast(", "regexp", "extract("]
    assert len(hits) == len(BLOCKED_DIALECT_PATTERNS)
    misses = ["date_sub", "xnow()", "intervals", "stop 10", "topping 1", "array", "regexps", "crossapply"]
    got = flags(spark, [f"SELECT a, {t} b" for t in hits + misses], filters.has_blocked_dialect(F.col("s"), RULES))
    assert got == [True] * len(hits) + [False] * len(misses)


def test_custom_patterns_without_word_edge(spark):
    rules = FilterOptions(blocked_dialect_patterns=(r"::", r"\bfoo\b"))
    assert flags(spark, ["a::int", "FOO", "food"], filters.has_blocked_dialect(F.col("s"), rules)) == [True, True, False]


def test_first_reason_wins(spark):
    df = spark.createDataFrame([("short", "x", "wrong")], "p string, s string, t string")
    reason = df.select(filters.cheap_reason("p", "s", "t").alias("r")).first().r
    assert reason == filters.SHORT_PROMPT


def test_ratio_contract():
    SplitRatios(0.8, 0.2, 0.0)
    with pytest.raises(ValueError, match="1.0 is needed"):
        SplitRatios(0.8, 0.1, 0.2)


def test_only_living_sql_goes_to_python(spark, sf):
    from sqlloom.plans import jobs, views

    classified = jobs.classify_corpus(views.corpus(spark, sf), views.blocklist(spark, sf))
    plan = classified._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "valid_sqlite(sql#" in plan
    assert "BatchEvalPython" not in plan and "MapInPandas" not in plan
    screened = jobs.screen(views.corpus(spark, sf)).where("drop_reason LIKE 'drop_short%'")
    assert screened.where("sql IS NOT NULL OR sql_context IS NOT NULL OR domain IS NOT NULL").count() == 0
    assert screened.count() > 0


def test_own_dialect_patterns_stay_as_they_are(spark):
    import re
    from dataclasses import replace

    from sqlloom.options import FilterOptions

    patterns = (r"\bfoo|::", r"(a)b\1", r"\bTOP\s+[0-9]+", r"(x)(y)\2", r"\bz(?:1|2)")
    texts = ["x :: y", "aba", "abb", "select top 5", "xyy", "xyx", "food", "az1", "z2", "stop 5", "plain"]
    options = replace(FilterOptions(), blocked_dialect_patterns=patterns)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.hit for r in df.select(filters.has_blocked_dialect(F.col("t"), options).alias("hit")).collect()]
    assert got == [any(re.search(p, t, re.IGNORECASE) for p in patterns) for t in texts]


def test_what_sqlite_gives_up_on_is_not_valid():
    checker = open_checker()
    assert not compiles(checker, "SELECT " + "(" * 150 + "1" + ")" * 150)
    assert not compiles(checker, "SELECT " + "+".join(["1"] * 1_500))
    assert compiles(checker, "SELECT " + "+".join(["1"] * 100))
