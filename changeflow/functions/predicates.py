"""Row checks, written as SQL boolean expressions so that they can be stored, logged and
counted by name. Catalyst pushes the simple ones down to the parquet scan."""

from __future__ import annotations


def _literal(value: object) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def not_null(column: str) -> str:
    return f"{column} IS NOT NULL"


def in_order(start: str, end: str) -> str:
    """``end`` is open (NULL) or not before ``start``."""
    return f"{end} IS NULL OR {end} >= {start}"


def matches(column: str, pattern: str) -> str:
    """The text matches a Java regular expression. A ``$`` also accepts one trailing newline."""
    return f"{column} RLIKE {_literal(pattern)}"


def one_of(column: str, values: tuple) -> str:
    return f"{column} IN ({', '.join(_literal(v) for v in values)})"
