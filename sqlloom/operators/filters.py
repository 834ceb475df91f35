"""Row rules. The first failing rule names the drop; the order is part of the result."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

from sqlloom.functions.text import leading_word, normalize_whitespace, text_or_empty
from sqlloom.options import FilterOptions

SHORT_PROMPT = "drop_short_prompt"
SHORT_SQL = "drop_short_sql"
TASK_TYPE = "drop_task_type"
NON_READ_ONLY = "drop_non_read_only_sql"
BLOCKED_DIALECT = "drop_blocklisted_dialect"
PARSE_FAILED = "drop_sqlite_parse_failed"
MISSING_DDL = "drop_missing_schema_ddl"
LEAKED = "drop_leak_blocklist"
MISSING_FIELDS = "drop_missing_fields"
MISSING_SCHEMA = "drop_missing_schema"

CORPUS_REASONS = (
    SHORT_PROMPT,
    SHORT_SQL,
    TASK_TYPE,
    NON_READ_ONLY,
    BLOCKED_DIALECT,
    PARSE_FAILED,
    MISSING_DDL,
    LEAKED,
)
EXAMPLE_REASONS = (MISSING_FIELDS, MISSING_SCHEMA)


def first_reason(*rules: tuple[str, Column]) -> Column:
    """Name of the first rule that holds, null when none does."""
    chain = F
    for name, failed in rules:
        chain = chain.when(failed, F.lit(name))
    return chain.otherwise(F.lit(None).cast("string"))


def too_short(normalized: Column, minimum: int) -> Column:
    return F.length(normalized) < minimum


def wrong_task_type(task_type: Column, options: FilterOptions) -> Column:
    return ~text_or_empty(task_type).isin(*options.allowed_task_types)


def blocked_word_pattern(words: tuple[str, ...]) -> str:
    # Explicit edges: what \b means for letters outside ASCII depends on the Java release.
    body = "|".join(re.escape(word) for word in words)
    # The first letters come first: they rule out most positions at the cost of one test.
    first = "".join(sorted({re.escape(word[0]) for word in words}))
    return rf"(?=[{first}])(?<![\p{{L}}\p{{N}}_])(?:{body})(?![\p{{L}}\p{{N}}_])"


def is_read_only(sql: Column, options: FilterOptions) -> Column:
    """Over whitespace-normalized SQL."""
    starts_well = leading_word(sql).isin(*options.allowed_leading_keywords)
    if not options.blocked_sql_keywords:
        return starts_well
    return starts_well & ~F.upper(sql).rlike(blocked_word_pattern(options.blocked_sql_keywords))


def dialect_pattern(patterns: tuple[str, ...]) -> str:
    """One pattern for all those without groups of their own; a leading word edge is tested once
    for those that share it and have no alternatives."""
    edge = r"\b"
    shares = [p for p in patterns if p.startswith(edge) and "|" not in p]
    anywhere = [f"(?:{p})" for p in patterns if p not in shares]
    if shares:
        after_edge = "|".join(f"(?:{p.removeprefix(edge)})" for p in shares)
        anywhere.insert(0, f"{edge}(?:{after_edge})")
    return f"(?iU)(?:{'|'.join(anywhere)})"


def numbers_groups(pattern: str) -> bool:
    """Whether joining the pattern with others could change what its groups are called."""
    return bool(re.search(r"\\[1-9]|\\k<|\(\?P?<[A-Za-z]|\(\?[a-zA-Z]+[-:)]", pattern))


def has_blocked_dialect(sql: Column, options: FilterOptions) -> Column:
    if not options.blocked_dialect_patterns:
        return F.lit(False)
    patterns = options.blocked_dialect_patterns
    apart = [p for p in patterns if numbers_groups(p)]
    joined = tuple(p for p in patterns if p not in apart)
    tests = [sql.rlike(dialect_pattern(joined))] if joined else []
    tests += [sql.rlike(f"(?iU){p}") for p in apart]
    return reduce(Column.__or__, tests)


def cheap_rules(
    prompt: Column, sql: Column, task_type: Column, options: FilterOptions
) -> list[tuple[str, Column]]:
    """Rules up to the dialect filter, over whitespace-normalized prompt and SQL."""
    return [
        (SHORT_PROMPT, too_short(prompt, options.min_prompt_chars)),
        (SHORT_SQL, too_short(sql, options.min_sql_chars)),
        (TASK_TYPE, wrong_task_type(task_type, options)),
        (NON_READ_ONLY, ~is_read_only(sql, options)),
        (BLOCKED_DIALECT, has_blocked_dialect(sql, options)),
    ]


def cheap_reason(
    prompt: str, sql: str, task_type: str, options: FilterOptions = FilterOptions()
) -> Column:
    """drop_reason of raw columns for the rules that need no Python."""
    return first_reason(
        *cheap_rules(
            normalize_whitespace(prompt), normalize_whitespace(sql), F.col(task_type), options
        )
    )


def missing_fields(question: Column, sql: Column, db_id: Column) -> Column:
    return (question == "") | (sql == "") | (db_id == "")
