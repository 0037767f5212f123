"""Join operators.

A side is broadcast only when its size in bytes is known to be below a bound
(``checked_broadcast``); past it the plain join is left to the planner
(sort-merge or, with AQE, a runtime switch once the real size is known).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes a side may hold to be broadcast.
BROADCAST_BYTES = 32 << 20


def _field_bytes(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(c) + F.lit(16)
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.ArrayType, T.StructType, T.MapType)):
        return F.size(c) * 8 + F.lit(24)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.octet_length(F.to_json(F.struct(c)))
    return F.lit(8)


def side_bytes(df: DataFrame, enough: int) -> int:
    """Size of ``df``: the optimizer's estimate if that is at most ``enough``
    (a limit or a literal table bounds it), else measured by one aggregate."""
    try:
        estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except ValueError:  # joins multiply up to numbers of thousands of digits, which don't convert
        estimate = enough + 1
    if estimate <= enough:
        return estimate
    row = sum((F.coalesce(_field_bytes(f.name, f.dataType), F.lit(8)) for f in df.schema.fields), F.lit(16))
    return int(df.agg(F.sum(row.cast("bigint"))).first()[0] or 0)


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when it holds at most ``max_bytes`` bytes, else ``df``."""
    return F.broadcast(df) if side_bytes(df, max_bytes) <= max_bytes else df


def anti_join_small(df: DataFrame, words, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``words``.

    A Python collection becomes an ``IN`` list (a hash-set filter in the
    same codegen stage); a DataFrame is anti-joined, broadcast when small.
    """
    if isinstance(words, DataFrame):
        other = words.select(F.col(words.columns[0]).alias(key)).distinct()
        return df.join(checked_broadcast(other), key, "left_anti")
    words = sorted(set(words))
    if not words:
        return df
    return df.where(~F.col(key).isin(*words))


def first_match_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     order: Sequence[str | Column]) -> DataFrame:
    """Inner join where each left row takes only the first right row of its
    key by ``order`` (left rows without a match are dropped).

    The first row per key is picked by ``min_by`` with map-side partial
    aggregation: a key holding a third of the right side is reduced inside
    every map task, never sorted whole in one task as a ``row_number`` window
    would.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    order_key = F.struct(*order_cols) if len(order_cols) > 1 else order_cols[0]
    payload = [c for c in right.columns if c != right_key]
    firsts = right.groupBy(right_key).agg(
        F.min_by(F.struct(*[F.col(c) for c in payload]), order_key).alias("_first")
    ).select(F.col(right_key), *[F.col(f"_first.{c}").alias(c) for c in payload])
    return left.join(firsts, left[left_key] == firsts[right_key], "inner")


def combine_results(frames: Iterable[DataFrame], key: str = "doc_num") -> DataFrame:
    """Full outer join of result frames on ``key`` (a fold)."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key, "full")
    return out

