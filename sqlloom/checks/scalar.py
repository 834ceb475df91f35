"""Text functions and row rules (sections 2.3 and 2.4 of the survey)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sqlloom.checks import duck as D
from sqlloom.checks.registry import check
from sqlloom.functions import sqltext, text
from sqlloom.functions.validity import valid_sqlite
from sqlloom.operators import filters
from sqlloom.operators.catalog import catalog_columns, normalize_catalog
from sqlloom.options import FilterOptions, TokenOptions
from sqlloom.plans import jobs, views
from sqlloom.sources.spread import spread

RULES = FilterOptions()


def documents(spark, sf):
    return spread(views.table(spark, sf, "documents"), "doc_id")


def corpus(spark, sf):
    return spread(views.corpus(spark, sf), "example_id")


def from_corpus(columns):
    return D.with_(D.view("corpus"), select=f"SELECT example_id, {columns} FROM corpus")


@check("t1_normalize_whitespace", from_corpus(f"{D.ws('sql_prompt')} AS prompt, {D.ws('sql')} AS sql_text"))
def _(spark, sf):
    return corpus(spark, sf).select(
        "example_id",
        text.normalize_whitespace("sql_prompt").alias("prompt"),
        text.normalize_whitespace("sql").alias("sql_text"),
    )


@check("t1_documents", f"SELECT doc_id, {D.ws('text')} AS normalized, {D.strip('text')} AS stripped FROM documents")
def _(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        text.normalize_whitespace("text").alias("normalized"),
        text.strip("text").alias("stripped"),
    )


@check("t2_text_key", f"SELECT doc_id, {D.text_key('text')} AS text_key FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", text.text_key("text").alias("text_key"))


@check("t3_sql_key", from_corpus(f"{D.sql_key('sql')} AS sql_key"))
def _(spark, sf):
    return corpus(spark, sf).select("example_id", text.sql_key("sql").alias("sql_key"))


@check("t4_leading_keyword", from_corpus(f"{D.leading_keyword('sql')} AS keyword"))
def _(spark, sf):
    return corpus(spark, sf).select("example_id", text.leading_keyword("sql").alias("keyword"))


def exploded(source, key, column):
    return f"SELECT {key}, unnest(range(len(s))) AS pos, unnest(s) AS statement FROM (SELECT {key}, {D.statements(column)} AS s FROM {source})"


@check("t5_split_statements", D.with_(D.view("corpus"), select=exploded("corpus", "example_id", "sql_context")))
def _(spark, sf):
    return corpus(spark, sf).select(
        "example_id", F.posexplode(sqltext.split_statements("sql_context")).alias("pos", "statement")
    ).withColumn("pos", F.col("pos").cast("bigint"))


# The documents have no semicolons of their own: their sentences are taken for statements.
@check("t5_split_documents", exploded("(SELECT doc_id, replace(text, '.', ';') AS text FROM documents)", "doc_id", "text"))
def _(spark, sf):
    return documents(spark, sf).select(
        "doc_id", F.posexplode(sqltext.split_statements(F.replace("text", F.lit("."), F.lit(";")))).alias("pos", "statement")
    ).withColumn("pos", F.col("pos").cast("bigint"))


@check(
    "t6_schema_ddl",
    from_corpus(
        f"{D.script(D.schema_statements('sql_context'))} AS schema_ddl,"
        f" {D.script(D.schema_statements('sql_context', view=True))} AS with_views"
    ),
)
def _(spark, sf):
    return corpus(spark, sf).select(
        "example_id",
        sqltext.extract_schema_ddl("sql_context").alias("schema_ddl"),
        sqltext.extract_schema_ddl("sql_context", keep_create_view=True).alias("with_views"),
    )


@check(
    "t7_canonical_sql",
    D.with_(
        D.view("corpus"),
        f"tokens AS (SELECT example_id, {D.sql_tokens('sql')} AS tk FROM corpus)",
        select=f"SELECT example_id, {D.canonical('tk')} AS canonical FROM tokens",
    ),
)
def _(spark, sf):
    return corpus(spark, sf).select("example_id", sqltext.canonical_sql("sql").alias("canonical"))


@check(
    "t7_canonical_documents",
    D.with_(
        f"tokens AS (SELECT doc_id, {D.sql_tokens('text')} AS tk FROM documents)",
        select=f"SELECT doc_id, {D.canonical('tk')} AS canonical FROM tokens",
    ),
)
def _(spark, sf):
    return documents(spark, sf).select(
        "doc_id", sqltext.canonical_sql("text").alias("canonical")
    )


# Texts and what they must become, both written by hand; %s stands for a number of the row.
WRITTEN = (
    ("select 0x1F, 0XabC from t where n=%s", "SELECT 0x1F, 0XabC FROM t WHERE n = %s"),
    ("select t.key,t.view , t.Filter from t where t.rows>%s", "SELECT t.key, t.view, t.Filter FROM t WHERE t.rows > %s"),
    ("create table t (key text, filter int, view int, k%s int, primary key(key))", "CREATE TABLE t (key text, filter int, view int, k%s int, PRIMARY KEY (key))"),
    ("with a(x) as (select 1), b(x, y) as (select %s,2) select x from b", "WITH a (x) AS (SELECT 1), b (x, y) AS (SELECT %s, 2) SELECT x FROM b"),
    ("select max(a),min(b) from t order by a desc limit %s offset 3", "SELECT MAX(a), MIN(b) FROM t ORDER BY a DESC LIMIT %s OFFSET 3"),
    ("select offset, rows,end from t order by desc, key asc nulls last limit %s", "SELECT offset, rows, end FROM t ORDER BY desc, key ASC NULLS last LIMIT %s"),
    ("select sum(a) filter(where a>%s) over (partition by key order by id rows between 1 preceding and current row) from t", "SELECT SUM(a) FILTER (WHERE a > %s) OVER (PARTITION BY key ORDER BY id ROWS BETWEEN 1 preceding AND current row) FROM t"),
    ("select case when a then %s else 1 end from t", "SELECT CASE WHEN a THEN %s ELSE 1 END FROM t"),
    ("create view if not exists v as select if from t where id=%s", "CREATE VIEW IF NOT EXISTS v AS SELECT if FROM t WHERE id = %s"),
)


def written(side: int) -> str:
    cases = " ".join(f"WHEN {i} THEN replace('{pair[side]}', '%s', CAST(o_orderkey AS STRING))" for i, pair in enumerate(WRITTEN))
    return f"SELECT o_orderkey AS example_id, CASE o_orderkey % {len(WRITTEN)} {cases} END AS canonical"


@check("t7_canonical_written", written(1) + " FROM orders")
def _(spark, sf):
    source = spread(spark.sql(written(0) + " FROM {orders}", orders=views.table(spark, sf, "orders")), "example_id")
    return source.select("example_id", sqltext.canonical_sql("canonical").alias("canonical"))


@check(
    "t8_canonical_ddl",
    D.with_(
        D.view("corpus"),
        D.CORPUS_DDL,
        select="SELECT example_id, coalesce(schema_ddl, '') AS schema_ddl FROM corpus LEFT JOIN ddl USING (example_id)",
    ),
)
def _(spark, sf):
    ddl = sqltext.extract_schema_ddl("sql_context")
    return corpus(spark, sf).select("example_id", sqltext.canonical_ddl(ddl).alias("schema_ddl"))


@check(
    "t9_sqlite_type",
    D.with_(D.view("catalog_cols"), select=f"SELECT db_id, column_idx, {D.sqlite_type('column_type')} AS sqlite_type FROM catalog_cols"),
)
def _(spark, sf):
    flat = catalog_columns(normalize_catalog(views.raw_catalog(spark, sf))).where("table_idx >= 0")
    return flat.select("db_id", "column_idx", text.sqlite_type("column_type").alias("sqlite_type"))


@check(
    "t10_quote_ident",
    D.with_(D.view("catalog_cols"), select=f"SELECT db_id, column_idx, {D.quote('column_name')} AS quoted FROM catalog_cols"),
)
def _(spark, sf):
    flat = catalog_columns(normalize_catalog(views.raw_catalog(spark, sf))).where("table_idx >= 0")
    return flat.select("db_id", "column_idx", text.quote_ident("column_name").alias("quoted"))


@check(
    "t11_extract_answer",
    D.with_(D.view("responses"), select=f"SELECT example_id, {D.extract_answer('response')} AS answer FROM responses"),
)
def _(spark, sf):
    return views.responses(spark, sf).select("example_id", text.extract_answer("response").alias("answer"))


@check("f1_short_prompt", from_corpus(f"length({D.ws('sql_prompt')}) < 12 AS dropped"))
def _(spark, sf):
    rule = filters.too_short(text.normalize_whitespace("sql_prompt"), RULES.min_prompt_chars)
    return views.corpus(spark, sf).select("example_id", rule.alias("dropped"))


@check("f2_short_sql", from_corpus(f"length({D.ws('sql')}) < 8 AS dropped"))
def _(spark, sf):
    rule = filters.too_short(text.normalize_whitespace("sql"), RULES.min_sql_chars)
    return views.corpus(spark, sf).select("example_id", rule.alias("dropped"))


@check("f3_task_type", from_corpus("coalesce(sql_task_type, '') NOT IN ('analytics and reporting') AS dropped"))
def _(spark, sf):
    rule = filters.wrong_task_type(F.col("sql_task_type"), RULES)
    return views.corpus(spark, sf).select("example_id", rule.alias("dropped"))


@check("f4_read_only", from_corpus(f"NOT {D.read_only(D.ws('sql'))} AS dropped"))
def _(spark, sf):
    rule = ~filters.is_read_only(text.normalize_whitespace("sql"), RULES)
    return corpus(spark, sf).select("example_id", rule.alias("dropped"))


@check("f5_dialect", from_corpus(f"{D.dialect(D.ws('sql'))} AS dropped"))
def _(spark, sf):
    rule = filters.has_blocked_dialect(text.normalize_whitespace("sql"), RULES)
    return corpus(spark, sf).select("example_id", rule.alias("dropped"))


# Truth by construction of the view: these classes are not SQLite syntax.
@check("f6_valid_sqlite", from_corpus("example_id % 20 NOT IN (5, 8, 9, 10, 13) AS sql_valid"))
def _(spark, sf):
    return corpus(spark, sf).select(
        "example_id", valid_sqlite(text.normalize_whitespace("sql")).alias("sql_valid")
    )


@check("f7_missing_ddl", from_corpus(f"len({D.schema_statements('sql_context')}) = 0 AS dropped"))
def _(spark, sf):
    rule = F.size(sqltext.schema_statements("sql_context")) == 0
    return corpus(spark, sf).select("example_id", rule.alias("dropped"))


@check(
    "f8_missing_fields",
    D.with_(
        D.view("examples"),
        select=f"SELECT example_id, {D.ws('question')} = '' OR {D.ws('query')} = '' OR coalesce(db_id, '') = '' AS dropped FROM examples",
    ),
)
def _(spark, sf):
    rule = filters.missing_fields(
        text.normalize_whitespace("question"),
        text.normalize_whitespace("query"),
        text.text_or_empty("db_id"),
    )
    return views.examples(spark, sf).select("example_id", rule.alias("dropped"))


@check(
    "f9_soft_validity",
    D.with_(*D.EXAMPLE_STEPS, select="SELECT example_id, sql_valid, sql FROM prepared"),
)
def _(spark, sf):
    classified = jobs.classify_examples(views.examples(spark, sf), views.raw_catalog(spark, sf))
    return classified.where("drop_reason IS NULL").select("example_id", "sql_valid", "sql")


TIGHT = TokenOptions(max_seq_length=95)


# An alternative that begins with a word edge, and a group that is referred to.
CUSTOM = FilterOptions(blocked_dialect_patterns=(r"\bzz|\|", r"(q)", r"(ea|on)h\1"))


@check("f5_dialect_custom", r"SELECT doc_id, regexp_matches(text, '(?i)\bzz|\||q|eahea|onhon') AS flagged FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", filters.has_blocked_dialect(F.col("text"), CUSTOM).alias("flagged"))


@check(
    "f10_skip_full_prompts",
    D.with_(
        D.view("corpus"),
        D.CORPUS_DDL,
        f"rows AS (SELECT example_id, {D.ws('sql_prompt')} AS sql_prompt, coalesce(schema_ddl, '') AS schema_ddl, {D.target('sql')} AS sql FROM corpus LEFT JOIN ddl USING (example_id))",
        D.supervision_steps(TIGHT),
        select="SELECT example_id, n_tokens FROM kept",
    ),
)
def _(spark, sf):
    return jobs.supervised_rows(chat_rows(spark, sf), TIGHT).select(
        "example_id", F.size("input_ids").cast("bigint").alias("n_tokens")
    )


def chat_rows(spark, sf):
    """The whole corpus with messages, nothing filtered."""
    rows = corpus(spark, sf).select(
        "example_id",
        text.normalize_whitespace("sql_prompt").alias("sql_prompt"),
        sqltext.canonical_script(sqltext.schema_statements("sql_context")).alias("schema_ddl"),
        sqltext.target_sql("sql").alias("sql"),
    )
    return jobs.with_messages(rows)


@check(
    "f_drop_reason",
    from_corpus(f"{D.cheap_reason(D.ws('sql_prompt'), D.ws('sql'), 'sql_task_type')} AS drop_reason"),
)
def _(spark, sf):
    return corpus(spark, sf).select(
        "example_id", filters.cheap_reason("sql_prompt", "sql", "sql_task_type").alias("drop_reason")
    )


# Every comma followed by a blank becomes the start of a comment.
@check("line_comment_flag", f"SELECT doc_id, list_contains(list_transform(regexp_extract_all(replace(text, ', ', ' -- '), {D.regex(sqltext.TOKEN)}), lambda t: starts_with(t, '--')), true) AS flagged FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", sqltext.has_line_comment(F.replace("text", F.lit(", "), F.lit(" -- "))).alias("flagged"))
