"""SQLite syntax check: the one place where rows cross into Python."""

from __future__ import annotations

import re
import sqlite3
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# Ship the functions themselves, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Parts of SQLite's messages. The last ones say that a text was not compiled at all: what
# could not be judged does not count as valid.
SYNTAX_FAILURES = (
    "syntax error",
    "incomplete input",
    "unrecognized token",
    "one statement at a time",
    "null character",
    "stack overflow",
    "too large",
    "too many",
    "too big",
    "out of memory",
)

# Quoted runs and comments: semicolons in them do not end a statement.
_HIDDEN = re.compile(
    r"'(?:[^']|'')*+'|\"(?:[^\"]|\"\")*+\"|`[^`]*+`|\[[^\]]*+\]|--[^\n]*+|/\*.*?(?:\*/|\Z)", re.S
)
_EXPLAIN = re.compile(r"\s*EXPLAIN\b", re.I)
_QUERY_PLAN = re.compile(r"\s*QUERY\s+PLAN\b", re.I)


def _deny(action: int, *_: object) -> int:
    # Compiling must never touch files or settings of the worker.
    blocked = action in (sqlite3.SQLITE_ATTACH, sqlite3.SQLITE_DETACH, sqlite3.SQLITE_PRAGMA)
    return sqlite3.SQLITE_DENY if blocked else sqlite3.SQLITE_OK


def open_checker() -> sqlite3.Connection:
    connection = sqlite3.connect(":memory:")
    connection.set_authorizer(_deny)
    return connection


def compiles(connection: sqlite3.Connection, sql: str) -> bool:
    """True unless SQLite rejects the text as syntax or gives up on its size. Unknown tables are
    fine; nothing runs."""
    if ";" in sql and ";" in _HIDDEN.sub(" ", sql).rstrip("; \t\r\n"):
        return False
    if _QUERY_PLAN.match(sql):
        return False
    try:
        connection.execute(sql if _EXPLAIN.match(sql) else "EXPLAIN " + sql).close()
    except sqlite3.Error as error:
        return not any(part in str(error) for part in SYNTAX_FAILURES)
    return True


@F.pandas_udf(T.BooleanType())
def valid_sqlite(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Null in, null out; equal texts of a batch are compiled once."""
    connection = open_checker()
    for batch in batches:
        codes, texts = pd.factorize(batch)
        verdicts = [compiles(connection, text) for text in texts]
        yield pd.Series(
            [verdicts[code] if code >= 0 else None for code in codes], dtype="object"
        )
