"""Text functions in Spark and in DuckDB on random strings, so the oracles rest on more than the
test views."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sqlloom.checks import duck as D
from sqlloom.functions import sqltext, text, tokens
from sqlloom.operators import answers, filters
from sqlloom.options import FilterOptions

PIECES = """' " \\ ; ( ) , . - -- /* */ /** ' '' "" ` [ ] ? :p @q $r != == <> <= || ->> 1 2.5 .5 1e5 x'ab'
SELECT select from WHERE and count cast FOO foo_bar t.a CREATE|TABLE create|table CREATE|VIEW INSERT DROP
é ñandú 日本 ß Final|SQL: ``` ```sql <|im_end|> NOW( TOP|5 interval ilike""".split()
BLANKS = [" ", "\n", "\t", " ", " ", "", "", ""]

FUNCTIONS = {
    "ws": (lambda: text.normalize_whitespace("s"), D.ws("s")),
    "strip": (lambda: text.strip("s"), D.strip("s")),
    "text_key": (lambda: text.text_key("s"), D.text_key("s")),
    "sql_key": (lambda: text.sql_key("s"), D.sql_key("s")),
    "leading": (lambda: text.leading_keyword("s"), D.leading_keyword("s")),
    "statements": (lambda: sqltext.split_statements("s"), D.statements("s")),
    "ddl": (lambda: sqltext.extract_schema_ddl("s", True), D.script(D.schema_statements("s", True))),
    "tokens": (lambda: sqltext.sql_tokens("s"), D.sql_tokens("s")),
    "canonical": (lambda: sqltext.canonical_sql("s"), D.canonical("tk")),
    "quoted": (lambda: text.quote_ident("s"), D.quote("s")),
    "answer": (lambda: answers.answer_sql("s"), D.answer("s")),
    "read_only": (
        lambda: filters.is_read_only(text.normalize_whitespace("s"), FilterOptions()),
        D.read_only(D.ws("s")),
    ),
    "pieces": (lambda: tokens.pieces(F.col("s")), D.pieces("s")),
    "ids": (lambda: tokens.hashed(F.col("s"), 20), D.piece_ids(f"list_slice({D.pieces('s')}, 1, 20)")),
}


@pytest.fixture(scope="module")
def strings():
    rng = random.Random(11)
    made = []
    for _ in range(4000):
        words = [rng.choice(PIECES).replace("|", " ", 1) if rng.random() < 0.9 else "|" for _ in range(rng.randrange(14))]
        made.append("".join(w + rng.choice(BLANKS) for w in words))
    return made


@pytest.fixture(scope="module")
def both(spark, strings):
    df = spark.createDataFrame(list(enumerate(strings)), "i int, s string")
    got = df.select("i", *(column().alias(name) for name, (column, _) in FUNCTIONS.items())).collect()
    frame = pd.DataFrame({"i": range(len(strings)), "s": strings})  # noqa: F841  (read by DuckDB)
    columns = ", ".join(f"{sql} AS {name}" for name, (_, sql) in FUNCTIONS.items())
    relation = duckdb.sql(f"SELECT i, {columns} FROM (SELECT *, {D.sql_tokens('s')} AS tk FROM frame)")
    want = [dict(zip(relation.columns, row)) for row in relation.fetchall()]
    return {r.i: r.asDict() for r in got}, {r["i"]: r for r in want}


@pytest.mark.parametrize("name", FUNCTIONS)
def test_engines_agree(both, strings, name):
    spark_rows, duck_rows = both
    bad = [(strings[i], r[name], duck_rows[i][name]) for i, r in spark_rows.items() if r[name] != duck_rows[i][name]]
    assert bad[:3] == []
