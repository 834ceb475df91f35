"""DuckDB text of the scalar functions and shared steps, for the correctness oracles."""

from __future__ import annotations

import re

from sqlloom.functions import sqltext, text, tokens
from sqlloom.operators import filters
from sqlloom.options import CurateOptions, FilterOptions, PromptOptions, TokenOptions
from sqlloom.plans import views


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def regex(pattern: str) -> str:
    """Java pattern to RE2: possessive quantifiers become plain ones."""
    plain = re.sub(r"(?<!\\)\*\+", "*", pattern).replace("++", "+")
    return lit(plain)


WS_CHARS = " || ".join(f"chr({ord(c)})" for c in text.WS_CHARS)


def ws(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), {regex(text.WS + '+')}, ' ', 'g'), ' ')"


def strip(c: str) -> str:
    return f"trim({c}, {WS_CHARS})"


def text_key(c: str) -> str:
    return f"lower({ws(c)})"


def target(c: str) -> str:
    return f"rtrim({ws(c)}, ';')"


def sql_key(c: str) -> str:
    return f"lower({target(c)})"


def leading_keyword(c: str) -> str:
    return f"upper(regexp_extract({ws(c)}, '^\\(*([A-Za-z]+)', 1))"


def statements(c: str) -> str:
    """List of trimmed, non-empty statements."""
    pieces = f"regexp_extract_all(coalesce({c}, ''), {regex(sqltext.STATEMENT)})"
    return f"list_filter(list_transform({pieces}, lambda s: {strip('s')}), lambda s: s <> '')"


def schema_statements(c: str, view: bool = False) -> str:
    keep = "upper(s) LIKE 'CREATE TABLE%'" + (" OR upper(s) LIKE 'CREATE VIEW%'" if view else "")
    bare = f"list_transform({statements(c)}, lambda s: rtrim(s, ';'))"
    return f"list_filter({bare}, lambda s: {keep})"


def script(items: str) -> str:
    return f"coalesce(array_to_string(list_transform({items}, lambda s: s || ';'), chr(10)), '')"


def sql_tokens(c: str) -> str:
    found = f"regexp_extract_all(coalesce({c}, ''), {regex(sqltext.TOKEN)})"
    return f"list_filter({found}, lambda t: t <> ';')"


def _in(value: str, words: tuple[str, ...]) -> str:
    return f"{value} IN ({', '.join(lit(w) for w in words)})"


def _call(token: str, before: str, following: str, subquery: str) -> str:
    return (
        f"({following} = '(' AND regexp_matches({token}, '^[A-Za-z_]')"
        f" AND NOT {_in(f'upper({token})', sqltext.NEVER_CALLED)}"
        f" AND NOT {_in(f'upper({before})', sqltext.NAME_CONTEXT)} AND NOT {subquery})"
    )


def _in_its_clause(prev: str, following: str) -> str:
    value = "'^[0-9?:@$]'"
    return f"""CASE upper(t) WHEN 'KEY' THEN {prev} IN ('PRIMARY', 'FOREIGN')
 WHEN 'VIEW' THEN {prev} IN ('CREATE', 'TEMP', 'TEMPORARY', 'DROP') WHEN 'BY' THEN {prev} IN ('GROUP', 'ORDER', 'PARTITION')
 WHEN 'FILTER' THEN {prev} = ')' AND {following} = '(' WHEN 'IF' THEN {following} IN ('NOT', 'EXISTS')
 WHEN 'NULLS' THEN {following} IN ('FIRST', 'LAST') WHEN 'PARTITION' THEN {following} = 'BY' WHEN 'RECURSIVE' THEN {prev} = 'WITH'
 WHEN 'ROWS' THEN {following} IN ('BETWEEN', 'UNBOUNDED', 'CURRENT') OR regexp_matches({following}, {value})
 WHEN 'OFFSET' THEN (regexp_matches({prev}, {value}) OR {prev} = ')') AND (regexp_matches({following}, {value}) OR {following} IN ('(', '-'))
 ELSE NOT {_in(prev, sqltext.OPENERS)} END"""


def canonical(tk: str) -> str:
    """Canonical text of a token-list column."""

    def at(offset: int) -> str:
        # List positions start at 1, lambda indexes too; outside the list is NULL.
        return f"coalesce(CASE WHEN i + ({offset}) >= 1 THEN {tk}[i + ({offset})] END, '')"

    prev, prev2, following = at(-1), at(-2), at(1)

    def subquery(shift: int) -> str:
        ends = [
            f"({at(shift + 2 * k + 1)} = ')' AND upper({at(shift + 2 * k + 2)}) = 'AS' AND {at(shift + 2 * k + 3)} = '(')"
            for k in range(1, sqltext.LISTED_COLUMNS + 1)
        ]
        return f"({at(shift - 1)} = ',' AND ({' OR '.join(ends)}))"

    always = tuple(w for w in sqltext.KEYWORDS if w not in sqltext.CLAUSE_WORDS)
    clause = f"({_in('upper(t)', sqltext.CLAUSE_WORDS)} AND {_in_its_clause(f'upper({prev})', f'upper({following})')})"
    tight = (
        f"i = 1 OR {prev} IN ('(', '.') OR t IN (')', ',', '.')"
        f" OR (t = '(' AND {_call(prev, prev2, 't', subquery(-1))})"
        f" OR ({prev} IN ('-', '+') AND t NOT IN ('-', '+') AND {_in(f'upper({prev2})', sqltext.BEFORE_UNARY)})"
    )
    inner = strip(f"replace(substr(t, 3), {lit('*/')}, {lit('* /')})")
    comment = f"'/* ' || {inner} || ' */'"
    word = (
        f"CASE WHEN t = '!=' THEN '<>' WHEN t = '==' THEN '=' WHEN t LIKE '--%' THEN {comment}"
        f" WHEN {prev} <> '.' AND ({_in('upper(t)', always)} OR {clause} OR {_call('t', prev, following, subquery(0))}) THEN upper(t) ELSE t END"
    )
    body = f"(CASE WHEN {tight} THEN '' ELSE ' ' END) || ({word})"
    return f"coalesce(array_to_string(list_transform({tk}, lambda t, i: {body}), ''), '')"


def quote(c: str) -> str:
    return f"('\"' || replace({c}, '\"', '\"\"') || '\"')"


def sqlite_type(c: str) -> str:
    cases = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in text.SQLITE_TYPES.items())
    return f"(CASE lower(coalesce({c}, '')) {cases} ELSE 'TEXT' END)"


def extract_answer(c: str) -> str:
    full = strip(f"coalesce({c}, '')")

    def after(marker: str) -> str:
        return f"substr({full}, instr({full}, {lit(marker)}) + {len(marker)})"

    def fenced(marker: str) -> str:
        return strip(f"split_part({after(marker)}, {lit(text.FENCE)}, 1)")

    return (
        f"(CASE WHEN contains({full}, {lit(text.SQL_FENCE)}) THEN {fenced(text.SQL_FENCE)}"
        f" WHEN contains({full}, {lit(text.FENCE)}) THEN {fenced(text.FENCE)}"
        f" WHEN contains({full}, {lit(text.FINAL_SQL)}) THEN {strip(after(text.FINAL_SQL))} ELSE {full} END)"
    )


def answer(c: str) -> str:
    return extract_answer(f"replace(coalesce({c}, ''), {lit(tokens.TURN_END)}, '')")


def read_only(c: str, options: FilterOptions = FilterOptions()) -> str:
    # RE2 has no lookaround; explicit edges on both sides say the same for a yes/no question.
    words = "|".join(options.blocked_sql_keywords)
    edge = r"[^\p{L}\p{N}_]"
    return (
        f"({_in(leading_keyword(c), options.allowed_leading_keywords)}"
        f" AND NOT regexp_matches(upper({c}), {lit(f'(?:^|{edge})(?:{words})(?:{edge}|$)')}))"
    )


def dialect(c: str, options: FilterOptions = FilterOptions()) -> str:
    body = "|".join(f"(?:{p})" for p in options.blocked_dialect_patterns)
    return f"regexp_matches({c}, {lit('(?i)' + body)})"


def cheap_reason(prompt: str, sql: str, task: str) -> str:
    o = FilterOptions()
    return (
        f"CASE WHEN length({prompt}) < {o.min_prompt_chars} THEN '{filters.SHORT_PROMPT}'"
        f" WHEN length({sql}) < {o.min_sql_chars} THEN '{filters.SHORT_SQL}'"
        f" WHEN NOT {_in(f'coalesce({task}, {lit(str())})', o.allowed_task_types)} THEN '{filters.TASK_TYPE}'"
        f" WHEN NOT {read_only(sql)} THEN '{filters.NON_READ_ONLY}'"
        f" WHEN {dialect(sql)} THEN '{filters.BLOCKED_DIALECT}' END"
    )


def user_message(question: str, schema: str, options: PromptOptions = PromptOptions()) -> str:
    head, rest = options.user_template.split("{schema}")
    middle, tail = rest.split("{question}")
    return strip(
        f"({lit(head)} || {strip(schema)} || {lit(middle)} || {strip(question)} || {lit(tail)})"
    )


def chat_text(contents: list[tuple[str, str]], generation: bool = False) -> str:
    parts = [
        f"{lit(tokens.TURN_START + role + chr(10))} || {content} || {lit(tokens.TURN_END + chr(10))}"
        for role, content in contents
    ]
    if generation:
        parts.append(lit(tokens.TURN_START + "assistant\n"))
    return " || ".join(parts)


def pieces(c: str) -> str:
    return f"regexp_extract_all({c}, {regex(tokens.PIECE)})"


def piece_ids(tk: str) -> str:
    return f"list_transform({tk}, lambda t: CAST('0x' || substr(md5(t), 1, 7) AS INTEGER) + 1)"


def order_key(ordinal: str, seed: int, purpose: str) -> str:
    return f"md5('{seed}|{purpose}|' || CAST({ordinal} AS VARCHAR))"


def split_label(rank: str, total: str, options: CurateOptions) -> str:
    """rank is 1-based."""
    r = options.ratios
    train = f"floor(CAST({total} AS DOUBLE) * CAST({r.train} AS DOUBLE))"
    val = f"floor(CAST({total} AS DOUBLE) * CAST({r.val} AS DOUBLE))"
    return f"CASE WHEN {rank} <= {train} THEN 'train' WHEN {rank} <= {train} + {val} THEN 'val' ELSE 'test' END"


# --- Views as common table expressions. ---


def view(name: str) -> str:
    body = {
        "corpus": views.CORPUS,
        "blocklist": views.BLOCKLIST,
        "catalog_cols": views.CATALOG_COLUMNS,
        "examples": views.EXAMPLES,
        "responses": views.RESPONSES,
    }[name].format(orders="orders", customer="customer")
    return f"{name} AS ({body})"


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# --- Shared steps. Each expects the ones above it. ---

BLOCK_KEYS = f"""
block_raw AS (SELECT coalesce(nullif(question, ''), nullif(prompt, ''), '') AS q, {sql_tokens("coalesce(nullif(sql, ''), nullif(query, ''), '')")} AS tk FROM blocklist),
block_keys AS (
 SELECT DISTINCT 'question' AS kind, {text_key('q')} AS key FROM block_raw WHERE {text_key('q')} <> ''
 UNION ALL SELECT DISTINCT 'sql', {sql_key(canonical('tk'))} FROM block_raw WHERE {sql_key(canonical('tk'))} <> '')"""

# One row per kept CREATE TABLE statement, put back together in canonical form.
CORPUS_DDL = f"""
ddl_parts AS (SELECT example_id, unnest(st) AS s, unnest(range(len(st))) AS pos FROM (SELECT example_id, {schema_statements('sql_context')} AS st FROM corpus)),
ddl_tokens AS (SELECT example_id, pos, {sql_tokens('s')} AS tk FROM ddl_parts),
ddl AS (SELECT example_id, string_agg({canonical('tk')} || ';', chr(10) ORDER BY pos) AS schema_ddl FROM ddl_tokens GROUP BY example_id)"""

CLASSIFIED = f"""
texts AS (SELECT example_id, domain, domain_description, sql_complexity, coalesce(sql_task_type, '') AS sql_task_type, {ws('sql_prompt')} AS sql_prompt, {ws('sql')} AS sql, {strip("coalesce(sql_context, '')")} AS sql_context_raw, {ws('sql_explanation')} AS sql_explanation FROM corpus),
canon AS (SELECT t.*, {sql_tokens('t.sql')} AS tk, d.schema_ddl, {cheap_reason('t.sql_prompt', 't.sql', 't.sql_task_type')} AS cheap FROM texts t LEFT JOIN ddl d USING (example_id)),
canon2 AS (SELECT * EXCLUDE (sql, tk), {canonical('tk')} AS sql FROM canon),
judged AS (SELECT *,
 CASE WHEN cheap IS NOT NULL THEN cheap
  WHEN example_id % 20 = 10 THEN '{filters.PARSE_FAILED}'
  WHEN schema_ddl IS NULL THEN '{filters.MISSING_DDL}'
  WHEN {text_key('sql_prompt')} IN (SELECT key FROM block_keys WHERE kind = 'question') OR {sql_key('sql')} IN (SELECT key FROM block_keys WHERE kind = 'sql') THEN '{filters.LEAKED}' END AS drop_reason FROM canon2),
alive AS (SELECT * FROM judged WHERE drop_reason IS NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {text_key('sql_prompt')}, {text_key('schema_ddl')}, {sql_key('sql')} ORDER BY example_id) AS rn FROM alive),
deduped AS (SELECT * FROM ranked WHERE rn = 1)"""

CORPUS_STEPS = (view("corpus"), view("blocklist"), BLOCK_KEYS, CORPUS_DDL, CLASSIFIED)

SCHEMAS = f"""
pk AS (SELECT db_id, table_idx, count(*) AS n, string_agg({quote('column_name')}, ', ' ORDER BY column_idx) AS names FROM catalog_cols WHERE is_pk GROUP BY ALL),
lines AS (
 SELECT c.db_id, c.table_idx, c.table_name, 0 AS part, c.column_idx AS pos, '  ' || {quote('c.column_name')} || ' ' || {sqlite_type('c.column_type')} || CASE WHEN c.is_pk AND pk.n = 1 THEN ' PRIMARY KEY' ELSE '' END AS line
 FROM catalog_cols c LEFT JOIN pk USING (db_id, table_idx)
 UNION ALL SELECT DISTINCT c.db_id, c.table_idx, c.table_name, 1, 0, '  PRIMARY KEY (' || pk.names || ')' FROM catalog_cols c JOIN pk USING (db_id, table_idx) WHERE pk.n > 1
 UNION ALL SELECT c.db_id, c.table_idx, c.table_name, 2, c.column_idx, '  FOREIGN KEY (' || {quote('c.column_name')} || ') REFERENCES ' || {quote('t.table_name')} || ' (' || {quote('t.column_name')} || ')'
 FROM catalog_cols c JOIN catalog_cols t ON c.db_id = t.db_id AND c.fk_target_idx = t.column_idx),
create_tables AS (SELECT db_id, table_idx, 'CREATE TABLE ' || {quote('table_name')} || ' (' || chr(10) || string_agg(line, ',' || chr(10) ORDER BY part, pos) || chr(10) || ');' AS stmt FROM lines GROUP BY db_id, table_idx, table_name),
schemas AS (SELECT db_id, string_agg(stmt, chr(10) ORDER BY table_idx) AS schema_ddl FROM create_tables GROUP BY db_id)"""

PREPARED = f"""
ex AS (SELECT example_id, coalesce(db_id, '') AS db_id, {ws('question')} AS sql_prompt, {ws('query')} AS sql FROM examples),
ex_tokens AS (SELECT ex.*, {sql_tokens('ex.sql')} AS tk, s.schema_ddl, example_id % 10 <> 6 AS sql_valid FROM ex LEFT JOIN schemas s USING (db_id)),
ex_judged AS (SELECT example_id, db_id, sql_prompt, schema_ddl, sql_valid, CASE WHEN sql_valid THEN {canonical('tk')} ELSE rtrim(sql, ';') END AS sql,
 CASE WHEN sql_prompt = '' OR sql = '' OR db_id = '' THEN '{filters.MISSING_FIELDS}' WHEN schema_ddl IS NULL THEN '{filters.MISSING_SCHEMA}' END AS drop_reason FROM ex_tokens),
prepared AS (SELECT * FROM ex_judged WHERE drop_reason IS NULL)"""

EXAMPLE_STEPS = (view("examples"), view("catalog_cols"), SCHEMAS, PREPARED)


def split_step(source: str, options: CurateOptions) -> str:
    """labelled: source with its split."""
    key = order_key("example_id", options.seed, "split")
    return (
        f"labelled AS (SELECT * EXCLUDE (r, total), {split_label('r', 'total', options)} AS split FROM"
        f" (SELECT *, row_number() OVER (ORDER BY {key}, CAST(example_id AS VARCHAR)) AS r, count(*) OVER () AS total FROM {source}))"
    )


def training_contents(options: PromptOptions = PromptOptions()) -> list[tuple[str, str]]:
    return [
        ("system", lit(options.direct_system_prompt)),
        ("user", user_message("sql_prompt", "schema_ddl", options)),
        ("assistant", strip("sql")),
    ]


# Supervision over a table ``rows`` (example_id, sql_prompt, schema_ddl, sql).
def supervision_steps(options: TokenOptions) -> str:
    contents = training_contents()
    n = options.max_seq_length
    return f"""
chat AS (SELECT example_id, {chat_text(contents)} AS full_text, {chat_text(contents[:2], True)} AS prompt_text FROM rows),
tok AS (SELECT example_id, {piece_ids(f"list_slice({pieces('full_text')}, 1, {n})")} AS full_ids, least(len({pieces('prompt_text')}), {n}) AS prompt_len FROM chat),
sup AS (SELECT example_id, full_ids, len(full_ids) AS n_tokens, prompt_len, prompt_len >= len(full_ids) AS skip_example FROM tok),
kept AS (SELECT * FROM sup WHERE NOT skip_example)"""


def batch_steps(seed: int, options: TokenOptions) -> str:
    return f"""
bucketed AS (SELECT *, n_tokens // {options.length_bucket} AS length_bucket FROM kept),
placed AS (SELECT *, (row_number() OVER (PARTITION BY length_bucket ORDER BY {order_key('example_id', seed, 'batch')}, CAST(example_id AS VARCHAR)) - 1) // {options.batch_size} AS batch_no FROM bucketed),
batches AS (SELECT *, max(n_tokens) OVER (PARTITION BY length_bucket, batch_no) AS pad_to FROM placed)"""


def padded(values: str, filler: int) -> str:
    return f"CAST({values} || list_transform(range(pad_to - n_tokens), lambda x: {filler}) AS VARCHAR)"


LABELS = "(list_transform(range(prompt_len), lambda x: -100) || list_slice(full_ids, prompt_len + 1, n_tokens))"
ONES = "list_transform(full_ids, lambda x: 1)"
