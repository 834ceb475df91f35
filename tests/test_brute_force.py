"""The whole curate chain on random rows against a plain Python account of the rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sqlloom.functions.sqltext import canonical_sql
from sqlloom.functions.text import sql_key, text_key
from sqlloom.functions.validity import compiles, open_checker
from sqlloom.operators import filters, profiles
from sqlloom.options import FilterOptions
from sqlloom.plans import jobs
from sqlloom.sources import readers
from test_text import cut_at_free_semicolons

RULES = FilterOptions()
HEADS = ["SELECT", "select", "WITH x AS (SELECT 1) SELECT", "(SELECT", "( SELECT", "DELETE", "sélect", "-- c\nSELECT", ""]
BODIES = ["a FROM t", "a,\tb FROM t WHERE c = 'x;y'", "count( * ) FROM t", "updated_at FROM t", "éDROP, a FROM t", "drop FROM t", "NOW( ) FROM t", "top 5 a FROM t", "a FROM t WHERE b ilike 'x'", "stop 5 FROM t", "a FROM", "a FROM t; SELECT b FROM u", "'replace' FROM t", "İnterval FROM t", "a FROM t -- note"]
TAILS = ["", ";", " ;", ";;", ")", "\n"]
PROMPTS = ["How many rows are there?", "how MANY rows are there?", "short", None, "", "  What is the largest   value? ", "Listed question, please?"]
CONTEXTS = ["CREATE TABLE t (a INT);", "create table t(a int)", "CREATE  TABLE t (a);", "INSERT INTO t VALUES ('CREATE TABLE;');", None, "x;CREATE TABLE u (b TEXT)　;\nCREATE TABLE v (c)"]
TASKS = ["analytics and reporting"] * 4 + ["Analytics and reporting", None]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [
        (
            i,
            rng.choice(["d1", None]),
            "dd",
            "basic",
            rng.choice(TASKS),
            rng.choice(PROMPTS),
            rng.choice(CONTEXTS),
            rng.choice([None, *[rng.choice(HEADS) + " " + rng.choice(BODIES) + rng.choice(TAILS)] * 30]),
            rng.choice([None, "why  so"]),
        )
        for i in range(3000)
    ]


@pytest.fixture(scope="module")
def source(spark, rows):
    schema = "example_id long, domain string, domain_description string, sql_complexity string, sql_task_type string, sql_prompt string, sql_context string, sql string, sql_explanation string"
    return spark.createDataFrame(rows, schema).repartition(7)


@pytest.fixture(scope="module")
def blocklist(spark):
    entries = [("listed QUESTION, please?", None, None, None), (None, None, "SELECT updated_at  from T", None)]
    return spark.createDataFrame(entries, readers.BLOCKLIST)


def one_line(value):
    return " ".join((value or "").split())


def early_reason(task, prompt, sql):
    prompt, sql = one_line(prompt), one_line(sql)
    word = re.match(r"\(*([A-Za-z]+)", sql)
    blocked = r"\b(?:" + "|".join(RULES.blocked_sql_keywords) + r")\b"
    if len(prompt) < RULES.min_prompt_chars:
        return filters.SHORT_PROMPT
    if len(sql) < RULES.min_sql_chars:
        return filters.SHORT_SQL
    if task not in RULES.allowed_task_types:
        return filters.TASK_TYPE
    if not word or word[1].upper() not in RULES.allowed_leading_keywords or re.search(blocked, sql.upper()):
        return filters.NON_READ_ONLY
    if any(re.search(p, sql, re.I) for p in RULES.blocked_dialect_patterns):
        return filters.BLOCKED_DIALECT
    return None


def create_tables(context):
    bare = [s.rstrip(";") for s in cut_at_free_semicolons(context or "")]
    return [s for s in bare if s.upper().startswith("CREATE TABLE")]


def test_reasons(rows, source, blocklist):
    checker = open_checker()
    got = {r.example_id: r.drop_reason for r in jobs.classify_corpus(source, blocklist).collect()}
    for i, _, _, _, task, prompt, context, sql, _ in rows:
        reason = early_reason(task, prompt, sql)
        if reason is None and not compiles(checker, one_line(sql)):
            reason = filters.PARSE_FAILED
        if reason is None and not create_tables(context):
            reason = filters.MISSING_DDL
        if reason is None and (
            one_line(prompt).lower() == "listed question, please?"
            or one_line(sql).rstrip("; ").lower() == "select updated_at from t"
        ):
            reason = filters.LEAKED
        assert got[i] == reason, (prompt, sql, context)
    assert set(got.values()) == {None, *filters.CORPUS_REASONS}


def test_kept_rows_and_funnel(source, blocklist):
    classified = jobs.classify_corpus(source, blocklist).cache()
    keys = classified.where("drop_reason IS NULL").select(
        "example_id", text_key("sql_prompt").alias("q"), text_key("schema_ddl").alias("d"), sql_key("sql").alias("s")
    )
    first = {}
    for r in sorted(keys.collect()):
        first.setdefault((r.q, r.d, r.s), r.example_id)
    kept = jobs.curated_rows(source, blocklist)
    assert sorted(r.example_id for r in kept.select("example_id").collect()) == sorted(first.values())
    funnel = {r.metric: r.value for r in profiles.curate_funnel(classified, filters.CORPUS_REASONS).collect()}
    assert funnel["seen"] == 3000 == sum(v for k, v in funnel.items() if k.startswith("drop_") and k != "drop_duplicate") + funnel["kept_before_dedupe"]
    assert funnel["kept_after_dedupe"] == len(first)
    assert funnel["drop_duplicate"] == funnel["kept_before_dedupe"] - len(first) > 0
    classified.unpersist()


def test_kept_columns(rows, source):
    by_id = {r[0]: r for r in rows}
    for r in jobs.curated_rows(source).collect():
        _, domain, _, _, task, prompt, context, _, explanation = by_id[r.example_id]
        assert (r.domain, r.sql_task_type, r.sql_prompt) == (domain, task, one_line(prompt))
        assert r.sql_context_raw == (context or "").strip() and r.sql_explanation == one_line(explanation)
        assert len(r.schema_ddl.split("\n")) == len(create_tables(context))
        assert r.messages[1].content == f"Database schema:\n{r.schema_ddl}\n\nQuestion:\n{r.sql_prompt}\n\nReturn only SQLite SQL."


def test_canonical_form_of_kept_sql_is_stable(source):
    kept = jobs.curated_rows(source)
    assert kept.where(canonical_sql("sql") != F.col("sql")).count() == 0
