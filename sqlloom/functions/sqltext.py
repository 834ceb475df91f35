"""Functions over SQL text: statement splitting, DDL extraction, canonical form.

Patterns use possessive quantifiers throughout: they match in a loop instead of
recursing, so a script of any length cannot exhaust the task's stack.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from sqlloom.functions.text import WS, normalize_whitespace, strip, text_or_empty

# One statement with its semicolon. Quotes hide semicolons, a backslash escapes
# the next character anywhere, an open quote runs to the end.
STATEMENT = (
    r"(?s)(?:[^;'\"\\]++|\\.|'(?:[^'\\]++|\\.)*+(?:'|\\?\z)"
    r"|\"(?:[^\"\\]++|\\.)*+(?:\"|\\?\z)|\\\z)++;?|;"
)

# Characters beyond ASCII that are not blanks; all of them may be part of a word.
WIDE = (
    r"\x{80}-\x{84}\x{86}-\x{9f}\x{a1}-\x{167f}\x{1681}-\x{1fff}\x{200b}-\x{2027}"
    r"\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}"
)

# One lexical token of SQL. The frequent kinds come first; what several kinds can start with is
# tried from the longest down.
TOKEN = "|".join(
    (
        r"[xX]'[0-9A-Fa-f]*+'",  # blob
        rf"[A-Za-z_{WIDE}][A-Za-z0-9_${WIDE}]*+",  # word
        r"[(),;*+%]",
        r"0[xX][0-9A-Fa-f]++",  # hexadecimal number
        r"(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?",  # number
        r"'(?:[^']++|'')*+'?",  # string
        r'"(?:[^"]++|"")*+"?',  # quoted names
        r"`(?:[^`]++|``)*+`?",
        r"\[[^\]]*+\]",
        r"--[^\n]*+",  # comments
        r"/\*[^*]*+\*++(?:[^/*][^*]*+\*++)*+/",
        rf"[:@$][A-Za-z_{WIDE}][A-Za-z0-9_${WIDE}]*+",  # parameter
        r"\?[0-9]*+",
        r"->>|->|<<|>>|<>|!=|<=|>=|==|\|\|",
        WS.replace("[", "[^", 1),
    )
)

# Words written in upper case by the canonical form.
KEYWORDS = tuple(
    """
    ALL AND AS ASC AUTOINCREMENT BETWEEN BY CASE CAST CHECK COLLATE CONSTRAINT CREATE CROSS
    DEFAULT DELETE DESC DISTINCT ELSE END ESCAPE EXCEPT EXISTS FILTER FOREIGN FROM FULL GLOB
    GROUP HAVING IF IN INNER INSERT INTERSECT INTO IS ISNULL JOIN KEY LEFT LIKE LIMIT NATURAL NOT
    NOTNULL NULL NULLS OFFSET ON OR ORDER OUTER OVER PARTITION PRIMARY RECURSIVE REFERENCES
    RIGHT ROWS SELECT SET TABLE THEN UNION UNIQUE UPDATE USING VALUES VIEW WHEN WHERE WITH
    """.split()
)

# Keywords that SQLite also takes as names. Each is one only in its clause.
CLAUSE_WORDS = ("ASC", "BY", "DESC", "END", "FILTER", "IF", "KEY", "NULLS", "OFFSET", "PARTITION", "RECURSIVE", "ROWS", "VIEW")

# After one of these a name or an expression begins, so ASC, DESC and END can't stand there.
OPENERS = (
    "", "(", ",", ".", "SELECT", "DISTINCT", "WHERE", "AND", "OR", "NOT", "ON", "BY", "SET", "FROM",
    "JOIN", "TABLE", "HAVING", "=", "<", ">", "<=", ">=", "<>", "!=", "+", "-", "*", "/", "||",
)

# How many column names a named subquery may list for its name to be told from a call.
LISTED_COLUMNS = 12

NEVER_CALLED = tuple(word for word in KEYWORDS if word != "CAST")

# A sign right after one of these belongs to the number or name behind it.
BEFORE_UNARY = (
    "", "(", ",", "=", "==", "<>", "!=", "<", ">", "<=", ">=", "||", "*", "/", "%",
    "SELECT", "WHERE", "AND", "OR", "NOT", "ON", "HAVING", "BETWEEN", "WHEN", "THEN",
    "ELSE", "BY", "LIMIT", "OFFSET", "IN", "LIKE",
)

# A word before "(" is a name, not a call, right after one of these.
NAME_CONTEXT = (
    "TABLE", "VIEW", "INTO", "REFERENCES", "EXISTS", "FROM", "JOIN", "UPDATE",
    "WITH", "RECURSIVE", "ON", "AS", "CONSTRAINT", ".",
)


def split_statements(c: Column | str) -> Column:
    """Array of trimmed, non-empty statements, each with its own semicolon if it had one."""
    pieces = F.regexp_extract_all(text_or_empty(c), F.lit(STATEMENT), F.lit(0))
    return F.filter(F.transform(pieces, strip), lambda s: s != "")


def schema_statements(c: Column | str, keep_create_view: bool = False) -> Column:
    """CREATE TABLE statements of a mixed script without their semicolons."""
    bare = F.transform(split_statements(c), lambda s: F.rtrim(s, F.lit(";")))

    def wanted(statement: Column) -> Column:
        # The longest prefix asked for has 12 characters.
        head = F.upper(F.substring(statement, 1, 12))
        hit = head == "CREATE TABLE"
        return hit | F.startswith(head, F.lit("CREATE VIEW")) if keep_create_view else hit

    return F.filter(bare, wanted)


def _as_script(statements: Column) -> Column:
    return F.array_join(F.transform(statements, lambda s: F.concat(s, F.lit(";"))), "\n")


def extract_schema_ddl(c: Column | str, keep_create_view: bool = False) -> Column:
    """schema_statements as one text, one per line, each closed by one semicolon."""
    return _as_script(schema_statements(c, keep_create_view))


def sql_tokens(c: Column | str) -> Column:
    """Lexical tokens without semicolons."""
    tokens = F.regexp_extract_all(text_or_empty(c), F.lit(TOKEN), F.lit(0))
    return F.filter(tokens, lambda t: t != ";")


def canonical_sql(c: Column | str) -> Column:
    """One-line form of a statement: keywords and call names upper, one spelling per operator,
    fixed spacing, literals and quoted names untouched, no semicolon."""
    tokens = sql_tokens(c)
    # Made once: the tests below use each list several times.
    always = tuple(word for word in KEYWORDS if word not in CLAUSE_WORDS)
    keywords, sometimes, not_called, names, signed, openers = (
        [F.lit(word) for word in words]
        for words in (always, CLAUSE_WORDS, NEVER_CALLED, NAME_CONTEXT, BEFORE_UNARY, OPENERS)
    )

    def at(i: Column) -> Column:
        # get() gives null outside the array; the empty string keeps the tests two-valued.
        return F.coalesce(F.get(tokens_col, i), F.lit(""))

    def names_subquery(i: Column) -> Column:
        """The word at i is a further named subquery with a column list: name (a, b) AS (."""
        ends = [
            (at(i + 2 * k + 1) == ")") & (F.upper(at(i + 2 * k + 2)) == "AS") & (at(i + 2 * k + 3) == "(")
            for k in range(1, LISTED_COLUMNS + 1)
        ]
        return (at(i - 1) == ",") & reduce(Column.__or__, ends)

    def is_call(i: Column, token: Column, upper: Column, prev_upper: Column, following: Column) -> Column:
        return (
            (following == "(")
            & token.rlike(r"^[A-Za-z_]")
            & ~upper.isin(*not_called)
            & ~prev_upper.isin(*names)
            & ~names_subquery(i)
        )

    def in_its_clause(upper: Column, prev: Column, following: Column) -> Column:
        value = r"^[0-9?:@$]"
        return (
            F.when(upper == "KEY", prev.isin("PRIMARY", "FOREIGN"))
            .when(upper == "VIEW", prev.isin("CREATE", "TEMP", "TEMPORARY", "DROP"))
            .when(upper == "BY", prev.isin("GROUP", "ORDER", "PARTITION"))
            .when(upper == "FILTER", (prev == ")") & (following == "("))
            .when(upper == "IF", following.isin("NOT", "EXISTS"))
            .when(upper == "NULLS", following.isin("FIRST", "LAST"))
            .when(upper == "PARTITION", following == "BY")
            .when(upper == "RECURSIVE", prev == "WITH")
            .when(upper == "ROWS", following.isin("BETWEEN", "UNBOUNDED", "CURRENT") | following.rlike(value))
            .when(upper == "OFFSET", (prev.rlike(value) | (prev == ")")) & (following.rlike(value) | following.isin("(", "-")))
            .otherwise(~prev.isin(*openers))
        )

    def render(token: Column, i: Column) -> Column:
        # The body runs once per token, so words and other tokens take the tests they need only.
        prev, prev2, following = at(i - 1), F.upper(at(i - 2)), at(i + 1)
        upper = F.upper(token)
        glued = prev.isin("", "(", ".", "-", "+") & (
            prev.isin("", "(", ".") | (~token.isin("-", "+") & prev2.isin(*signed))
        )
        blank = F.when(glued, F.lit("")).otherwise(F.lit(" "))
        keyword = upper.isin(*keywords) | (
            upper.isin(*sometimes) & in_its_clause(upper, F.upper(prev), F.upper(following))
        )
        # Behind a dot there are only names.
        word = F.when(
            (prev != ".") & (keyword | is_call(i, token, upper, F.upper(prev), following)), upper
        ).otherwise(token)
        opens_call = (token == "(") & is_call(i - 1, prev, F.upper(prev), prev2, token)
        tight = token.isin(")", ",", ".") | glued | opens_call
        other = (
            F.when(token == "!=", F.lit("<>"))
            .when(token == "==", F.lit("="))
            .when(F.startswith(token, F.lit("--")), _block_comment(token))
            .otherwise(token)
        )
        # Letters sort behind every ASCII digit and almost every sign.
        return F.when(token >= "A", F.concat(blank, word)).otherwise(
            F.concat(F.when(tight, F.lit("")).otherwise(F.lit(" ")), other)
        )

    # Bind the token array once: a one-element outer transform acts as a let.
    def body(bound: Column) -> Column:
        nonlocal tokens_col
        tokens_col = bound
        return F.array_join(F.transform(bound, render), "")

    tokens_col = tokens
    return F.get(F.transform(F.array(tokens), body), F.lit(0))


def _block_comment(token: Column) -> Column:
    inner = F.replace(F.substr(token, F.lit(3)), F.lit("*/"), F.lit("* /"))
    return F.concat(F.lit("/* "), strip(inner), F.lit(" */"))


def canonical_script(statements: Column) -> Column:
    """canonical_sql per statement, each closed by a semicolon, one per line."""
    return _as_script(F.transform(statements, canonical_sql))


def canonical_ddl(c: Column | str) -> Column:
    bare = F.transform(split_statements(c), lambda s: F.rtrim(s, F.lit(";")))
    return canonical_script(F.filter(bare, lambda s: s != ""))


def has_line_comment(c: Column | str) -> Column:
    """True when a '--' comment outside quotes would swallow the rest of a one-line query."""
    tokens = F.regexp_extract_all(text_or_empty(c), F.lit(TOKEN), F.lit(0))
    return F.exists(tokens, lambda t: F.startswith(t, F.lit("--")))


def target_sql(c: Column | str) -> Column:
    """One-line SQL without trailing semicolons, spelled as it came."""
    return F.rtrim(normalize_whitespace(c), F.lit(";"))
