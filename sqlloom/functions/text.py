"""Scalar text functions as column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode whitespace spelled out: the engine's own \s is ASCII-only.
WS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# Runs that are not one plain blank already; single blanks, the usual case, cost no replacement.
WS_RUN = WS + r"(?:(?<!\x{20})" + WS + "*+|" + WS + "++)"

# The same characters as a set for trimming.
WS_CHARS = "".join(
    chr(c)
    for a, b in (
        (0x9, 0xD), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
        (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    )
    for c in range(a, b + 1)
)

FENCE = "```"
SQL_FENCE = "```sql"
FINAL_SQL = "Final SQL:"

# Benchmark column type -> SQLite storage name. Anything else is TEXT.
SQLITE_TYPES = {
    "text": "TEXT",
    "number": "REAL",
    "time": "TEXT",
    "boolean": "INTEGER",
    "others": "TEXT",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Remove whitespace at both ends, Unicode blanks included."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def normalize_whitespace(c: Column | str) -> Column:
    """Whitespace runs become one blank, ends trimmed, null becomes ''."""
    return F.trim(F.regexp_replace(text_or_empty(c), WS_RUN, " "))


def text_key(c: Column | str) -> Column:
    """Comparison key of free text."""
    return F.lower(normalize_whitespace(c))


def sql_key(c: Column | str) -> Column:
    """Comparison key of SQL: as text_key, after cutting trailing semicolons."""
    return F.lower(F.rtrim(normalize_whitespace(c), F.lit(";")))


def leading_keyword(c: Column | str) -> Column:
    """First ASCII word in upper case, looking through opening parentheses only."""
    return leading_word(normalize_whitespace(c))


def leading_word(normalized: Column) -> Column:
    """leading_keyword of text that is whitespace-normalized already."""
    return F.upper(F.regexp_extract(normalized, r"^\(*+([A-Za-z]++)", 1))


def sqlite_type(c: Column | str) -> Column:
    lowered = F.lower(text_or_empty(c))
    mapped = F
    for name, storage in SQLITE_TYPES.items():
        mapped = mapped.when(lowered == name, F.lit(storage))
    return mapped.otherwise(F.lit("TEXT"))


def quote_ident(c: Column | str) -> Column:
    return F.concat(F.lit('"'), F.replace(_col(c), F.lit('"'), F.lit('""')), F.lit('"'))


def _after(text: Column, marker: str) -> Column:
    return F.substr(text, F.instr(text, marker) + F.lit(len(marker)))


def extract_answer(c: Column | str) -> Column:
    """SQL inside a model answer: sql-tagged fence, any fence, 'Final SQL:', else all of it."""
    text = strip(text_or_empty(c))
    return (
        F.when(
            F.contains(text, F.lit(SQL_FENCE)),
            strip(F.substring_index(_after(text, SQL_FENCE), FENCE, 1)),
        )
        .when(
            F.contains(text, F.lit(FENCE)),
            strip(F.substring_index(_after(text, FENCE), FENCE, 1)),
        )
        .when(F.contains(text, F.lit(FINAL_SQL)), strip(_after(text, FINAL_SQL)))
        .otherwise(text)
    )


def drop_turn_marker(c: Column | str, marker: str) -> Column:
    """Remove end-of-turn markers left in by a decoder that keeps special tokens."""
    return F.replace(text_or_empty(c), F.lit(marker), F.lit(""))
