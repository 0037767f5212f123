"""Column expressions for text handling.

Everything here returns a ``Column`` built from built-in Spark functions,
so it stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``str.split()`` splits on Unicode white space plus the four
# separator controls 0x1c-0x1f; Java's ``\s`` is ASCII-only without (?U).
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
# Token boundary for the tokenizer: anything that is not a letter or digit.
NON_WORD = r"(?U)[^\p{L}\p{N}]+"
# A kept token starts with an ASCII letter and holds letters only.
TOKEN_SHAPE = r"^[a-z]\p{L}*$"
NON_ALNUM = r"[^a-zA-Z0-9]"

# Suffix rules of the singulariser, first match wins.
SINGULAR_SUFFIX = (
    ("people", "person"),
    ("men", "man"),
    ("wives", "wife"),
    ("menus", "menu"),
    ("us", "us"),
    ("ss", "ss"),
    ("is", "is"),
    ("'s", "'s"),
    ("ies", "y"),
    ("es", "e"),
    ("s", ""),
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(c) -> Column:
    """White-space split that drops empty pieces (Python ``str.split()``)."""
    return F.filter(F.split(_col(c), WHITESPACE), lambda w: w != "")


def lower_words(c) -> Column:
    return split_words(F.lower(_col(c)))


def split_spaces(c) -> Column:
    """Single-space split keeping empty pieces (Python ``str.split(' ')``)."""
    return F.split(_col(c), " ", -1)


def truncate_words(c, n: int) -> Column:
    """First ``n`` space-separated words, ``...`` appended only when cut."""
    c = _col(c)
    parts = split_spaces(c)
    return F.when(
        F.size(parts) > n, F.concat(F.array_join(F.slice(parts, 1, n), " "), F.lit("..."))
    ).otherwise(c)


def summary_or_body(abstract, body, n: int = 100) -> Column:
    """Abstract summary: empty abstract -> first ``n`` words of the body."""
    abstract, body = _col(abstract), _col(body)
    return F.when(F.length(abstract) == 0, truncate_words(body, n)).otherwise(truncate_words(abstract, n))


def abbreviate_list(c, sep: str = ";", keep: int = 2, joiner: str = ". ") -> Column:
    """Split on ``sep``; keep all joined by ``joiner`` when at most ``keep``
    parts, else the first ``keep`` parts plus ``...``. Null stays null."""
    c = _col(c)
    parts = F.split(c, re.escape(sep), -1)
    return F.when(
        F.size(parts) > keep,
        F.concat(F.array_join(F.slice(parts, 1, keep), joiner), F.lit("...")),
    ).otherwise(F.array_join(parts, joiner))


def parse_pub_date(c) -> Column:
    """``YYYY`` -> Jan 1 of that year; longer text parsed as year-month-day.

    Text that is not a date (or shorter than four characters) becomes null,
    so a later null drop removes it instead of stopping the job.
    """
    c = F.trim(_col(c))
    ts = F.when(F.length(c) == 4, F.try_to_timestamp(F.concat(c, F.lit("-01-01")), F.lit("yyyy-M-d"))).when(
        F.length(c) > 4, F.try_to_timestamp(c, F.lit("yyyy-M-d"))
    )
    return ts.cast("date")


def strip_non_alnum(c) -> Column:
    return F.regexp_replace(_col(c), NON_ALNUM, "")


def singularize(c) -> Column:
    """Suffix singulariser: the first matching rule of ``SINGULAR_SUFFIX``."""
    w = _col(c)
    out = None
    for suffix, repl in SINGULAR_SUFFIX:
        stem = w.substr(F.lit(1), F.length(w) - F.lit(len(suffix)))
        branch = F.concat(stem, F.lit(repl))
        cond = w.endswith(suffix)
        out = F.when(cond, branch) if out is None else out.when(cond, branch)
    return out.otherwise(w)


def tokenize(c, stopwords: Iterable[str] = (), singular: bool = False) -> Column:
    """Lower-case tokens of letters/digits, kept when longer than two
    characters, starting with an ASCII letter, all letters, and not a stop
    word. ``singular`` applies the suffix singulariser before the filter.

    The stop test is an ``IN`` list, which Catalyst turns into a hash set
    lookup (``InSet``) for lists longer than ten words.
    """
    stop = sorted(set(stopwords))
    tokens = F.split(F.lower(_col(c)), NON_WORD)
    if singular:
        tokens = F.transform(tokens, singularize)

    def keep(t: Column) -> Column:
        cond = (F.length(t) > 2) & t.rlike(TOKEN_SHAPE)
        if stop:
            cond = cond & ~t.isin(*stop)
        return cond

    return F.filter(tokens, keep)


def explode_values(arr, name: str, *keep) -> tuple:
    """Select list for one row per array element, as ``name``.

    ``explode_outer`` plus a null filter instead of ``explode``: for an inner
    explode Catalyst infers ``size(arr) > 0`` and copies the whole array
    expression (a tokenizer, say) into that filter, evaluating it twice.
    Use as ``df.select(*explode_values(...)).where(col(name).isNotNull())``.
    """
    arr = _col(arr)
    return (*keep, F.explode_outer(arr).alias(name))
