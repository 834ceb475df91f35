"""Text functions on random strings against small Python restatements, and on known traps."""

import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sqlloom.functions import sqltext, text

SETTINGS = settings(
    max_examples=8, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)
PIECES = ["'", '"', "\\", ";", " ", "\n", "\t", "\xa0", "\u2003", "a", "B", "é", "''", "CREATE TABLE x", "--", "```", "```sql", "Final SQL:", "(", "1"]
TEXTS = st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=60, max_size=120)


def evaluate(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    rows = df.select("i", column.alias("v")).collect()
    return [v for _, v in sorted((r.i, r.v) for r in rows)]


def cut_at_free_semicolons(script):
    """Statements of a script; only the tokens that matter are looked at."""
    ends, closing = [], None
    for m in re.finditer(r"\\.|['\";]", script, re.S):
        mark = m.group()
        if mark == ";" and closing is None:
            ends.append(m.end())
        elif mark in "'\"" and closing in (None, mark):
            closing = mark if closing is None else None
    starts = [0, *ends]
    parts = [script[a:b].strip() for a, b in zip(starts, [*ends, len(script)])]
    return [p for p in parts if p]


@SETTINGS
@given(TEXTS)
def test_whitespace_and_keys(spark, texts):
    collapsed = [" ".join(t.split()) for t in texts]
    assert evaluate(spark, texts, text.normalize_whitespace("s")) == collapsed
    assert evaluate(spark, texts, text.text_key("s")) == [c.lower() for c in collapsed]
    assert evaluate(spark, texts, text.sql_key("s")) == [c.rstrip(";").lower() for c in collapsed]
    assert evaluate(spark, texts, text.strip("s")) == [t.strip() for t in texts]


@SETTINGS
@given(TEXTS)
def test_split_statements(spark, texts):
    expected = [cut_at_free_semicolons(t) for t in texts]
    assert evaluate(spark, texts, sqltext.split_statements("s")) == expected


@SETTINGS
@given(TEXTS)
def test_extract_answer(spark, texts):
    def restated(t):
        for opener, closer in (("```sql", "```"), ("```", "```"), ("Final SQL:", None)):
            _, found, rest = t.strip().partition(opener)
            if found:
                return (rest.partition(closer)[0] if closer else rest).strip()
        return t.strip()

    assert evaluate(spark, texts, text.extract_answer("s")) == [restated(t) for t in texts]


def test_nulls_are_empty(spark):
    for function in (text.normalize_whitespace, text.text_key, text.sql_key, text.leading_keyword, text.extract_answer, sqltext.extract_schema_ddl, sqltext.canonical_sql):
        assert evaluate(spark, [None, "x"], function("s"))[0] == ""
    assert evaluate(spark, [None, "x"], sqltext.split_statements("s"))[0] == []


def test_leading_keyword(spark):
    texts = ["(SELECT 1)", "( SELECT 1)", "-- c\nSELECT 1", "  with t as", "((select", "1 select", "sélect"]
    assert evaluate(spark, texts, text.leading_keyword("s")) == ["SELECT", "", "", "WITH", "SELECT", "", "S"]


def test_sql_key_keeps_blank_before_semicolon(spark):
    assert evaluate(spark, ["x ;", "x;;", "X 'A';"], text.sql_key("s")) == ["x ", "x", "x 'a'"]


def test_schema_ddl_traps(spark):
    scripts = [
        "create table a (x int)",
        "CREATE  TABLE a (x int);",
        "CREATE TEMP TABLE a (x int);",
        "-- c\nCREATE TABLE a (x int);",
        "INSERT INTO t VALUES ('a;CREATE TABLE f (x INT);');CREATE TABLE b (y INT);;CREATE VIEW v AS SELECT 1;",
    ]
    got = evaluate(spark, scripts, sqltext.extract_schema_ddl("s"))
    assert got == ["create table a (x int);", "", "", "", "CREATE TABLE b (y INT);"]
    with_view = evaluate(spark, scripts, sqltext.extract_schema_ddl("s", keep_create_view=True))
    assert with_view[4] == "CREATE TABLE b (y INT);\nCREATE VIEW v AS SELECT 1;"


def test_canonical_sql(spark):
    cases = {
        "select count( * ), max(a.b)  from t where x!=1e5 and y == 'a;  B'": "SELECT COUNT(*), MAX(a.b) FROM t WHERE x <> 1e5 AND y = 'a;  B'",
        "SELECT [my  col], `q``r`, \"x\"\"y\" FROM t;": "SELECT [my  col], `q``r`, \"x\"\"y\" FROM t",
        "select a -- note\nfrom t": "SELECT a /* note */ FROM t",
        "select -1, a - 1, - -2, x'aB', :p, ?1, .5": "SELECT -1, a - 1, - - 2, x'aB', :p, ?1, .5",
        "create table t (id int, n varchar ( 50 ), foreign key (id) references u(id))": "CREATE TABLE t (id int, n VARCHAR(50), FOREIGN KEY (id) REFERENCES u (id))",
        "select\u00a0été ,\u3000b\u2003from t": "SELECT été, b FROM t",
        "select * from (select 1) where a in(1,2) and not exists(select 1)": "SELECT * FROM (SELECT 1) WHERE a IN (1, 2) AND NOT EXISTS (SELECT 1)",
    }
    assert evaluate(spark, list(cases), sqltext.canonical_sql("s")) == list(cases.values())


def test_canonical_sql_is_stable_and_still_parses(spark):
    from sqlloom.functions.validity import compiles, open_checker

    statements = [
        "select a.b, count(*) c from t as a left join u on a.x=u.x group by 1 having count(*)>=2 order by c desc limit 5 offset 1",
        "with r(n) as (select 1 union all select n+1 from r where n<5) select * from r",
        "select case when a='x' then 1 else -2 end, cast(b as text), a||'z' from t where c between -1 and 1",
        "select strftime('%Y', d), iif(a>1, b, c) from t where d like '%a' escape '!' and e is not null",
        "select sum(x) filter (where y>0) over (partition by z order by w rows between 1 preceding and current row) from t",
        "select a->>'$.k', b<<2, ~c, x % 2, (select max(y) from u) from t where (a, b) in (select 1, 2)",
    ]
    once = evaluate(spark, statements, sqltext.canonical_sql("s"))
    assert evaluate(spark, once, sqltext.canonical_sql("s")) == once
    checker = open_checker()
    assert all(compiles(checker, s) for s in statements + once)


def test_canonical_sql_keeps_the_program(spark):
    """SQLite compiles source and canonical form to the same program."""
    import random
    import sqlite3

    con = sqlite3.connect(":memory:")
    con.execute("create table t (id integer, key text, view int, filter int, rows int, offset int, desc int, end int, a int, b text)")
    con.execute("create table u (id integer, key text, x int)")
    rnd = random.Random(5)
    names = ["key", "view", "t.filter", "rows", "t.offset", "a", "B", "T.Key", "id", "t.end", "t.Desc"]
    values = ["0x1F", "0XaB", "1e3", ".5", "'it''s; -- x'", "-1", "- 2", "?1", ":p", "x'0a'", "NULL"]

    def value(depth=0):
        kind = rnd.random()
        if depth > 2 or kind < 0.35:
            return rnd.choice(names + values)
        if kind < 0.6:
            return f"({value(depth + 1)}{rnd.choice([' ', ''])}{rnd.choice(['+', '-', '*', '||', '==', '!=', '<=', ' and ', ' or ', ' is not '])} {value(depth + 1)})"
        if kind < 0.7:
            return f"{rnd.choice(['max', 'Coalesce', 'iif'])}( {value(depth + 1)},{value(depth + 1)},1)"
        if kind < 0.8:
            return f"case when {value(depth + 1)} then {value(depth + 1)} else 0 end"
        if kind < 0.9:
            return f"cast({value(depth + 1)} as integer)"
        return f"{rnd.choice(names)} in(select x from u where u.key={value(depth + 1)})"

    def query():
        text = f"select {value()} , {value()} as c\nfrom t left join u on t.id=u.id where {value()}"
        if rnd.random() < 0.4:
            text += f" group by {rnd.choice(names)} having count(*)>{rnd.randint(0, 3)}"
        if rnd.random() < 0.5:
            text += f" order by {rnd.choice(['1', '2'])} {rnd.choice(['desc', 'asc', 'DESC nulls last'])} limit 5 offset {rnd.randint(0, 9)}"
        if rnd.random() < 0.3:
            text = f"with r(n) as (select 1), s(n,m) as (select 2,0x10) select * from r,s,({text.replace('?1', '3').replace(':p', '4')})"
        return text

    def program(sql):
        return [row[:7] for row in con.execute("explain " + sql, {"1": 0, "p": 0} if ":p" in sql else ([0] if "?1" in sql else []))]

    sources = []
    while len(sources) < 250:
        sql = query()
        if ":p" in sql and "?1" in sql:
            continue
        try:
            program(sql)
        except sqlite3.Error:
            continue
        sources.append(sql)
    made = evaluate(spark, sources, sqltext.canonical_sql("s"))
    assert [m for s, m in zip(sources, made) if program(s) != program(m)] == []


def test_long_texts_do_not_exhaust_the_stack(spark):
    texts = ["'" + "''" * 200_000, ";" * 100_000, "a;" * 50_000, "\\'" * 100_000, "/*" + "* " * 100_000, "(" * 100_000]
    assert evaluate(spark, texts, F.size(sqltext.split_statements("s")))[1:3] == [100_000, 50_000]
    assert evaluate(spark, texts, F.size(sqltext.sql_tokens("s")))[0] == 1


def test_line_comment_flag(spark):
    assert evaluate(spark, ["select 1 -- x", "select '-- x'", "a - - b"], sqltext.has_line_comment("s")) == [True, False, False]
