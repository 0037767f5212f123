"""Global orderings without a single-partition window.

A ``row_number()`` or ``rank()`` over a window with no ``partitionBy``
moves every row into one task. The helpers here range-partition the rows
instead, number them inside each partition, and add per-partition offsets
(one small aggregate, one row per partition, read on the driver).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import checked_broadcast


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def _offset_expr(pid_totals: list[tuple[int, int]], pid_col: Column) -> Column:
    """Number of rows in earlier partitions, looked up by position in one
    array literal."""
    if not pid_totals:
        return F.lit(0).cast("bigint")
    totals = dict(pid_totals)
    offsets, running = [], 0
    for pid in range(max(totals) + 1):
        offsets.append(running)
        running += totals.get(pid, 0)
    return F.element_at(F.lit(offsets).cast("array<bigint>"), pid_col + 1)


def ordered_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx", start: int = 0,
                  partitions: int | None = None) -> DataFrame:
    """Consecutive numbers ``start, start+1, ...`` following ``order``.

    ``order`` must be a total order (unique keys) for a deterministic
    result. The sorted rows are checkpointed (to the session's checkpoint
    folder) so the numbering survives a lost executor unchanged.
    """
    n = partitions or _partitions(df)
    cols = _cols(order)
    s = (
        df.repartitionByRange(n, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    s = s.checkpoint(eager=True)
    totals = [(r[0], r[1]) for r in s.groupBy("_pid").count().collect()]
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return s.withColumn(name, _offset_expr(totals, F.col("_pid")) + local + F.lit(start)).drop("_pid", "_mid")


def avg_rank(df: DataFrame, col: str, ascending: bool = True, name: str | None = None) -> DataFrame:
    """Average rank of ``col`` over the whole frame (ties get the mean of
    their positions, nulls stay unranked), as pandas ``rank()`` does.

    Distinct values are counted first (partial aggregation folds a hot
    value), ranked with range partitioning, and joined back: broadcast when
    the distinct table is small, else a shuffle join that AQE splits when
    one value holds many rows.
    """
    name = name or f"{col}_rank"
    v = F.col(col)
    key = v.asc() if ascending else v.desc()
    vc = df.where(v.isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_cnt"))
    n = _partitions(df)
    s = (
        vc.repartitionByRange(n, key)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn(
            "_run",
            F.sum("_cnt").over(
                Window.partitionBy("_pid").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
            ),
        )
    ).checkpoint(eager=True)
    totals = [(r[0], r[1]) for r in s.groupBy("_pid").agg(F.sum("_cnt")).collect()]
    before = _offset_expr(totals, F.col("_pid")) + F.col("_run") - F.col("_cnt")
    ranks = s.select(col, (before + (F.col("_cnt") + F.lit(1)) / F.lit(2.0)).alias(name))
    out = df.join(checked_broadcast(ranks), on=df[col].eqNullSafe(ranks[col]), how="left").drop(ranks[col])
    return out


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], k: int,
                    salt_buckets: int = 0, name: str = "rn") -> DataFrame:
    """First ``k`` rows per group with a 1-based ordinal ``name``.

    With ``salt_buckets > 0`` the choice runs in two phases: first ``k`` per
    (group, salt), then first ``k`` of those per group, so a group holding a
    third of all rows is spread over many tasks before the final pick.
    """
    cols = _cols(order)
    if salt_buckets > 0:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets)))
        w1 = Window.partitionBy(*group, "_salt").orderBy(*cols)
        df = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    w = Window.partitionBy(*group).orderBy(*cols)
    return df.withColumn(name, F.row_number().over(w).cast("bigint")).where(F.col(name) <= k)
