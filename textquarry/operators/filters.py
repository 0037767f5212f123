"""Row filters and small projections. All narrow: they run in the scan's
codegen stage and, on Parquet, push down as scan filters where possible."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_language(df: DataFrame, col: str = "language", lang: str = "en") -> DataFrame:
    return df.where(F.col(col) == lang)


def year_range(df: DataFrame, col: str, start: int, end: int) -> DataFrame:
    """Inclusive year range."""
    return df.where(F.col(col).between(start, end))


def drop_null_rows(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of ``cols`` (default: every column)."""
    return df.na.drop("any", subset=list(cols) if cols is not None else None)


def drop_empty(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.length(F.col(col)) > 0)


def min_key(df: DataFrame, key: str):
    """Smallest key (one aggregate row to the driver)."""
    return df.agg(F.min(key)).first()[0]


def label_target(df: DataFrame, key: str, target, col: str = "doc_type") -> DataFrame:
    """Constant label, overwritten for the target row."""
    return df.withColumn(
        col, F.when(F.col(key) == F.lit(target), "target document").otherwise("other documents")
    )


def drop_columns(df: DataFrame, names: Iterable[str] = (), regex: str | None = None) -> DataFrame:
    """Drop columns by name and by a full-match regular expression."""
    names = set(names)
    pat = re.compile(regex) if regex else None
    keep = [c for c in df.columns if c not in names and not (pat and pat.fullmatch(c))]
    return df.select(*keep)
