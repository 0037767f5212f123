"""Target-versus-all document measures over a long matrix, rank tables and
Pearson correlation.

The target's row (at most one vocabulary's worth of terms) is broadcast and
equi-joined on ``term``; every other document row stays where it is and
is folded per ``doc_num`` by one hash aggregation. No cross join and no
dense matrix.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import FEATURE_CAP
from .joins import checked_broadcast
from .keys import avg_rank


def target_row(x: DataFrame, target) -> DataFrame:
    return x.where(F.col("doc_num") == F.lit(target)).select("term", F.col("value").alias("b"))


def pair_stats(x: DataFrame, docs: DataFrame, target, cap: int = FEATURE_CAP) -> DataFrame:
    """Per document of ``docs``: sums needed by L1, L2, cosine and Jaccard
    against the target row, computed in one pass over ``x``.

    Columns: ``doc_num, a1, a2, dot, dmin, l1_part, l2_part, shared_b,
    shared_b2`` plus the target's ``tb1`` and ``tb2`` (sum and sum of
    squares, read as two scalars on the driver).
    """
    t = target_row(x, target)
    tb = t.agg(F.sum("b").alias("s1"), F.sum(F.col("b") * F.col("b")).alias("s2")).first()
    tb1, tb2 = float(tb["s1"] or 0.0), float(tb["s2"] or 0.0)
    b = F.coalesce(F.col("b"), F.lit(0.0))
    a = F.col("value")
    per_doc = (
        x.join(checked_broadcast(t), "term", "left")
        .groupBy("doc_num")
        .agg(
            F.sum(a).alias("a1"),
            F.sum(a * a).alias("a2"),
            F.sum(a * b).alias("dot"),
            F.sum(F.least(a, b)).alias("dmin"),
            F.sum(F.abs(a - b)).alias("l1_part"),
            F.sum((a - b) * (a - b)).alias("l2_part"),
            F.sum(b).alias("shared_b"),
            F.sum(b * b).alias("shared_b2"),
        )
    )
    filled = [F.coalesce(F.col(c), F.lit(0.0)).alias(c)
              for c in ("a1", "a2", "dot", "dmin", "l1_part", "l2_part", "shared_b", "shared_b2")]
    return docs.select("doc_num").join(per_doc, "doc_num", "left").select(
        "doc_num", *filled, F.lit(tb1).alias("tb1"), F.lit(tb2).alias("tb2")
    )


def l1_expr() -> Column:
    return F.col("l1_part") + F.greatest(F.col("tb1") - F.col("shared_b"), F.lit(0.0))


def l2_expr() -> Column:
    return F.sqrt(F.greatest(F.col("l2_part") + F.col("tb2") - F.col("shared_b2"), F.lit(0.0)))


def cosine_expr() -> Column:
    return F.coalesce(F.try_divide(F.col("dot"), F.sqrt(F.col("a2")) * F.sqrt(F.col("tb2"))), F.lit(0.0))


def jaccard_expr() -> Column:
    """Exact Jaccard of presence rows (values 0/1): |A∩B| / |A∪B|, 0 when empty."""
    return F.coalesce(
        F.try_divide(F.col("dot"), F.col("a2") + F.col("tb2") - F.col("dot")), F.lit(0.0)
    )


def document_similarity(x: DataFrame, docs: DataFrame, target, attrs: Sequence[str] = (),
                        jaccard: bool = False) -> DataFrame:
    """L1, L2 and cosine of every document against the target document, with
    ``jaccard`` also the Jaccard similarity of presence rows.

    Every document of ``docs`` gets a row (documents without any
    vocabulary term included); a zero norm gives cosine 0. Attribute
    columns of ``docs`` are joined after the measures are filled.
    """
    s = pair_stats(x, docs, target)
    out = s.select(
        "doc_num",
        l1_expr().alias("doc_l1_norm"),
        l2_expr().alias("doc_l2_norm"),
        cosine_expr().alias("doc_cosine_similarity"),
        *([jaccard_expr().alias("doc_jaccard_similarity")] if jaccard else []),
    )
    if attrs:
        out = out.join(docs.select("doc_num", *attrs), "doc_num", "left")
    return out


def pearson(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson ``correlation`` and ``n`` (per ``by`` group); the t statistic
    ``t = r * sqrt((n-2)/(1-r^2))`` is added as a column; the two-sided
    p-value needs the t distribution and is added by ``with_pvalue``."""
    r = F.corr(a, b)
    g = df.groupBy(*by) if by else df.groupBy()
    out = g.agg(r.alias("correlation"), F.count(F.lit(1)).alias("n"))
    out = out.withColumn("correlation", F.when(F.isnan("correlation"), None).otherwise(F.col("correlation")))
    return out


def _log_gamma_step(a: Column) -> Column:
    """``ln(gamma(a + 1/2) / gamma(a))``: the asymptotic series sixteen steps up,
    and the quotients of the recurrence on the way."""
    z = a + 16.0
    odd = F.lit(1.0) / z
    series = (
        0.5 * F.log(z) - odd / 8 + F.pow(odd, 3) / 192 - F.pow(odd, 5) / 640 + F.pow(odd, 7) * (17 / 14336)
        - F.pow(odd, 9) * (31 / 18432)
    )
    steps = F.aggregate(F.sequence(F.lit(0), F.lit(15)), F.lit(0.0), lambda s, j: s + F.log((a + j) / (a + j + 0.5)))
    return series + steps


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, folded from its
    front; of a length at which it has settled left of the mean."""
    def turn(s, coefficient):
        d, c = F.lit(1.0) / (1.0 + coefficient * s["d"]), 1.0 + coefficient / s["c"]
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    def term(s, k):
        m = k.cast("double")
        s = turn(s, m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m)))
        return turn(s, -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0)))

    first = F.lit(1.0) / (1.0 - (a + b) * x / (a + 1.0))
    length = (F.ceil(4 * F.sqrt(F.greatest(a, b))) + 64).cast("int")
    folded = F.aggregate(F.sequence(F.lit(1), length),
                         F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h")), term)
    return folded["h"]


def log_pvalue(r: Column, n: Column) -> Column:
    """Natural logarithm of the two-sided p-value of a Pearson correlation (t test,
    n - 2 degrees): ``I_x(d/2, 1/2)`` with ``x = 1 - r^2``. Null without a correlation
    or with fewer than three rows, minus infinity at a correlation of one."""
    r = r.cast("double")
    a, b = (n.cast("double") - 2.0) / 2.0, F.lit(0.5)
    x, y = (1.0 - r) * (1.0 + r), r * r
    front = a * F.log1p(-y) + 0.5 * F.log(y) + _log_gamma_step(a) - 0.5 * math.log(math.pi)
    left = front - F.log(a) + F.log(_beta_fraction(a, b, x))
    right = F.log1p(-F.exp(front + math.log(2.0)) * _beta_fraction(b, a, y))
    return (
        F.when(r.isNull() | F.isnan(r) | (n < 3), None)
        .when(F.abs(r) >= 1.0, F.lit(float("-inf"))).when(r == 0.0, F.lit(0.0))
        .when(x < (a + 1.0) / (a + 2.5), left).otherwise(right)
    )


def with_pvalue(corr: DataFrame) -> DataFrame:
    """Adds ``pvalue`` and its decimal logarithm ``log10_pvalue``, which holds on
    where the value itself is too small for a double."""
    log = log_pvalue(F.col("correlation"), F.col("n"))
    return corr.withColumn("_log", log).select(
        "*", F.exp("_log").alias("pvalue"), (F.col("_log") / math.log(10.0)).alias("log10_pvalue")).drop("_log")


def rank_table(measures: Mapping[str, tuple[DataFrame, str, bool]], key: str = "doc_num") -> DataFrame:
    """Average rank per measure, one column each, full-outer joined on key.

    ``measures`` maps output name -> (frame, value column, ascending).
    """
    out = None
    for name, (frame, col, asc) in measures.items():
        r = avg_rank(frame.select(key, col), col, ascending=asc, name=name).select(key, name)
        out = r if out is None else out.join(r, key, "full")
    return out


def rank_diff(ranks: DataFrame, benchmark: str, key: str = "doc_num") -> DataFrame:
    """Every rank column minus the benchmark column; benchmark dropped."""
    others = [c for c in ranks.columns if c not in (key, benchmark)]
    return ranks.select(key, *[(F.col(c) - F.col(benchmark)).alias(c) for c in others])
