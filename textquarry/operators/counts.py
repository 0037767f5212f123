"""Counting operators: word counts, top-k lists, grouped counts, histograms,
group summaries and column variances.

All of them are hash aggregations with map-side partial aggregation, so a
hot key (one word holding a third of all tokens) is folded inside each map
task before the shuffle and never lands whole in one reducer.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import explode_values, lower_words, strip_non_alnum
from .joins import anti_join_small, checked_broadcast


def text_source(df: DataFrame, cols: Sequence[str | int], name: str = "text") -> DataFrame:
    """Several text columns as one text column, one row per cell (UNION ALL
    without a second scan): ``explode(array(c1, c2, ...))``. Columns may be
    given by name or by 0-based position (e.g. ``[4, 9]``)."""
    names = [df.columns[c] if isinstance(c, int) else c for c in cols]
    return df.select(F.explode(F.array(*[F.col(f"`{c}`").cast("string") for c in names])).alias(name))


def word_count(df: DataFrame, col: str = "text", stopwords=None) -> DataFrame:
    """``(word, count)``: lower-cased white-space words, summed.

    ``stopwords`` (a collection or a one-column DataFrame ``word``) removes
    words after aggregation, where there is one row per distinct word
    instead of one per token. The raw word is compared, so ``the,`` stays.
    """
    words = df.select(*explode_values(lower_words(col), "word")).where(F.col("word").isNotNull())
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    if stopwords is None:
        return counts
    return anti_join_small(counts, stopwords, "word")


def word_count_normalized(counts: DataFrame) -> DataFrame:
    """Counts re-summed after stripping non-alphanumerics and lower-casing;
    the empty key (words made only of other characters) is kept."""
    return counts.groupBy(F.lower(strip_non_alnum("word")).alias("word")).agg(
        F.sum("count").cast("bigint").alias("count")
    )


def top_k(df: DataFrame, n: int, order: Sequence[Column], ordinal: str = "rank") -> DataFrame:
    """First ``n`` rows by ``order`` with a 1-based ordinal.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps
    its own ``n`` best rows, so only ``n x tasks`` rows reach the final
    merge. The ordinal window then runs over those ``n`` rows only.
    """
    top = df.orderBy(*order).limit(n)
    return top.withColumn(ordinal, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def top_words(counts: DataFrame, n: int = 50) -> DataFrame:
    """Top ``n`` words, count descending, word ascending as the tie key."""
    return top_k(counts, n, [F.col("count").desc(), F.col("word").asc()])


def count_having(df: DataFrame, key: str, gt: int = 20) -> DataFrame:
    """Groups with more than ``gt`` rows, counts ascending (key breaks ties)."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > gt)
        .orderBy("count", key)
    )


def value_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def bucket_expr(value: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bucket 1..bins; below ``lo`` -> 0, at or above ``hi`` ->
    bins+1 (the ``width_bucket`` convention), null stays null."""
    raw = F.floor((value - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)).cast("bigint") + F.lit(1)
    return (
        F.when(value.isNull(), F.lit(None).cast("bigint"))
        .when(value < F.lit(lo), F.lit(0).cast("bigint"))
        .when(value >= F.lit(hi), F.lit(bins + 1).cast("bigint"))
        .otherwise(raw)
    )


def histogram(df: DataFrame, col: str, by: Iterable[str] = (), lo: float = 0.0, hi: float = 1.0,
              bins: int = 10) -> DataFrame:
    """Row counts per equal-width bucket of ``col`` within each ``by`` group."""
    by = list(by)
    return df.groupBy(*by, bucket_expr(F.col(col), lo, hi, bins).alias("bucket")).agg(
        F.count(F.lit(1)).alias("count")
    )


def _magnitude(v: Column) -> Column:
    """Rises with ``v``, by one where its size doubles."""
    return F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (F.log2(F.abs(v)) + 1100))


def exact_median(df: DataFrame, keys: Sequence[str], value_col: str, name: str = "median",
                 buckets: int = 1024) -> DataFrame:
    """``keys`` and the exact median of ``value_col``, which no task gathers.

    Two order statistics a group (the same one for an odd count) are found by
    refining histograms: the range of a group is cut into ``buckets``, by size
    while it spans more than a doubling and evenly below that; each bucket's count, least and largest value are one partially aggregated row,
    and the range becomes that of the bucket that holds the rank, until all
    its values are equal. A group that holds most rows thus costs a few counting
    passes over ``df``, which should be a stored table. Null and NaN values are left out; a group without others has
    a null median. Null keys are a group.
    """
    v = F.col(value_col).cast("double")
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.when(~F.isnan(v), v).alias("_v"))
    groups = rows.groupBy(*names).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    groups = groups.checkpoint(eager=True)
    # rank: how many values of the range stand before the one sought
    open_ = groups.where("_n > 0").select(
        *names, F.explode(F.array(F.expr("(_n - 1) div 2"), F.expr("_n div 2"))).alias("_place"), "_lo", "_hi",
    ).distinct().withColumn("_rank", F.col("_place"))
    found = []
    while True:
        found.append(open_.where("_lo = _hi").select(*names, "_place", F.col("_lo").alias("_at")))
        open_ = open_.where("_lo < _hi")
        if open_.isEmpty():
            break
        side = checked_broadcast(open_.select(*[F.col(n).alias(f"{n}s") for n in names], "_place", "_rank", "_lo", "_hi"))
        same = functools.reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}s")) for n in names], F.lit(True))
        low, wide = _magnitude(F.col("_lo")), _magnitude(F.col("_hi")) - _magnitude(F.col("_lo"))
        share = F.when(wide >= 1, (_magnitude(F.col("_v")) - low) / wide).otherwise(
            (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))
        cells = (
            rows.join(side, same & (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
            .groupBy(*names, "_place", "_rank", F.least(F.floor(share * buckets), F.lit(buckets - 1)).alias("_b"))
            .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        )
        before = F.sum("_c").over(Window.partitionBy(*names, "_place").orderBy("_b")) - F.col("_c")
        open_ = (
            cells.withColumn("_before", before).where("_before <= _rank and _rank < _before + _c")
            .select(*names, "_place", "_lo", "_hi", (F.col("_rank") - F.col("_before")).alias("_rank"))
            .checkpoint(eager=True)
        )
    at = functools.reduce(lambda a, b: a.unionByName(b), found)
    middle = at.groupBy(*[F.col(n).alias(f"{n}s") for n in names]).agg(F.avg("_at").alias("_m"))
    on = functools.reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}s")) for n in names], F.lit(True))
    return groups.join(middle, on, "left").select(*[F.col(n).alias(k) for k, n in zip(keys, names)], F.col("_m").alias(name))


def group_summary(df: DataFrame, keys: Sequence[str], count_col: str, value_col: str) -> DataFrame:
    """Count of ``count_col`` and mean/median of ``value_col`` per group,
    with flat column names."""
    df = df.select(*dict.fromkeys([*keys, count_col, value_col])).checkpoint(eager=True)
    flat = df.groupBy(*keys).agg(
        F.count(count_col).alias(f"{count_col}_count"),
        F.avg(value_col).alias(f"{value_col}_mean"),
    )
    middle = exact_median(df, keys, value_col, f"{value_col}_median")
    other = middle.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)], f"{value_col}_median")
    on = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(keys)], F.lit(True))
    return flat.join(other, on).select(*flat.columns, f"{value_col}_median")


def column_variance(df: DataFrame, cols: Sequence[str], name: str = "metric",
                    value: str = "variance") -> DataFrame:
    """Sample variance (n-1) of every column, ascending: unpivot, then one
    grouped aggregation."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), name, "v"
    )
    return long.groupBy(name).agg(F.var_samp("v").alias(value)).orderBy(value, name)
