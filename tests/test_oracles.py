"""Every registered query against its DuckDB oracle, whole results, values and types."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from sqlloom.checks.registry import ORACLES, QUERIES

SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    sql = entry.oracle_sql()[name]
    relation = con.sql(sql)
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == types
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert differences(df, con, sql) is None


def test_checks_are_not_vacuous(spark, sf, con):
    """Rules that keep, cut, drop or flag do each of it in the tables they are checked on."""
    one = lambda sql: con.sql(sql).fetchall()[0]
    queries = entry.queries()
    total = one("SELECT count(*) FROM orders")[0]
    assert 0 < queries["f10_skip_full_prompts"](spark, sf).count() < total
    masks = queries["k2_label_mask"](spark, sf).groupBy("skip_example").count().count()
    assert masks == 2
    sizes = queries["k5_batch_plan"](spark, sf).selectExpr("max(length) AS longest", "min(length) AS least").first()
    assert sizes.least < sizes.longest == 95
    assert queries["line_comment_flag"](spark, sf).select("flagged").distinct().count() == 2
    assert queries["f5_dialect_custom"](spark, sf).select("flagged").distinct().count() == 2
    documents = one("SELECT count(*) FROM documents")[0]
    assert queries["t5_split_documents"](spark, sf).count() > documents
    held = one("SELECT count(*) FROM documents WHERE source = 'src0'")[0]
    assert queries["j2_documents_benchmark"](spark, sf).count() <= documents - held < documents
    changed = queries["t7_canonical_written"](spark, sf).where("canonical LIKE '%0x1F%' OR canonical LIKE '%t.key%'")
    assert changed.count() > 0


def test_entry_runs(spark):
    rows = {r.metric: r.value for r in entry.entry(spark).collect()}
    dropped = sum(v for k, v in rows.items() if k.startswith("drop_") and k != "drop_duplicate")
    assert rows["seen"] == dropped + rows["kept_before_dedupe"]
    assert rows["kept_before_dedupe"] == rows["drop_duplicate"] + rows["kept_after_dedupe"]
