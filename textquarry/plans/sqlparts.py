"""Shared fragments for the DuckDB oracle SQL.

The oracle side is written independently of the Spark code: plain SQL over
the driver's views, using the same fixed constants (stop words, suffix
rules, regular expressions) that define the semantics.
"""

from __future__ import annotations

from ..functions.stopwords import full_stopwords, sql_list
from ..functions.text import SINGULAR_SUFFIX

# RE2 equivalents of Python's str.split() white space.
SQL_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
SQL_NON_WORD = r"[^\p{L}\p{N}]+"
SQL_TOKEN_SHAPE = r"[a-z]\p{L}*"


def stop_list() -> str:
    return sql_list(full_stopwords())


def words_of(expr: str) -> str:
    """Lower-cased white-space words of ``expr`` as a list (empties dropped)."""
    return (
        f"list_filter(regexp_split_to_array(lower({expr}), '{SQL_WS}'), lambda w: w <> '')"
    )


def singular_sql(w: str) -> str:
    parts = []
    for suffix, repl in SINGULAR_SUFFIX:
        s = suffix.replace("'", "''")
        r = repl.replace("'", "''")
        parts.append(f"WHEN suffix({w}, '{s}') THEN left({w}, length({w}) - {len(suffix)}) || '{r}'")
    return "CASE " + " ".join(parts) + f" ELSE {w} END"


def tokens_of(expr: str, stop: bool = True, singular: bool = False) -> str:
    """Tokenizer: letters/digits split, length > 2, ASCII-letter start, all
    letters, not a stop word."""
    base = f"regexp_split_to_array(lower({expr}), '{SQL_NON_WORD}')"
    if singular:
        base = f"list_transform({base}, lambda t: {singular_sql('t')})"
    cond = f"length(t) > 2 AND regexp_full_match(t, '{SQL_TOKEN_SHAPE}')"
    if stop:
        cond += f" AND NOT list_contains({stop_list()}, t)"
    return f"list_filter({base}, lambda t: {cond})"
