"""Chat logs collapsed to their maximal conversations, and rendered.

A log that writes every state of a growing conversation holds each as a
conversation of its own. Here every conversation gets a rolling hash of its
first k turns for every k; one whose hash of all turns is another's hash of
a proper prefix is dropped by an anti-join, equal ones become one. Only
DataFrame operations are used.

A conversation may hold a large part of all rows: turns are put in order by
range partitioning, so a long conversation runs over several partitions,
and what the earlier ones add is carried over in a table of at most a few
rows a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Store

# Turns rendered into one row; a longer conversation has several segments, one row each.
SEGMENT_TURNS = 1000


def _carried(parts: DataFrame, value: str, fold, name: str) -> DataFrame:
    """Fold of ``value`` over the earlier partitions of each conversation
    that lies in several of them (conv, pid, name)."""
    spans = parts.groupBy("conv").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("conv").alias("_span"))
    several = parts.join(spans, F.col("conv").eqNullSafe(F.col("_span")), "left_semi")
    earlier = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    return several.select(
        F.col("conv").alias("_conv"), F.col("pid").alias("_pid"),
        F.coalesce(fold(value).over(earlier), F.lit(0)).alias(name),
    )


def _with_carried(df: DataFrame, carried: DataFrame, names: list[str]) -> DataFrame:
    on = df["conv"].eqNullSafe(carried["_conv"]) & (df["pid"] == carried["_pid"])
    out = df.join(carried, on, "left").drop("_conv", "_pid")
    for n in names:
        out = out.withColumn(n, F.coalesce(n, F.lit(0)))
    return out


def ordered_turns(store: Store, turns: DataFrame) -> DataFrame:
    """``turns`` (conv, turn, role, text) with pid, idx: the range partition
    and the place in it, and digest, the hash of role and text."""
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["conv", "turn", "role", "text"]
    s = turns.withColumn("digest", F.sha2(F.to_json(F.struct("role", "text")), 256))
    return store.put(
        s.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        .withColumn("pid", F.spark_partition_id()).withColumn("idx", F.monotonically_increasing_id())
    )


def prefix_hashes(store: Store, s: DataFrame) -> DataFrame:
    """(conv, pid, idx, pos, x, y): number of each turn in its conversation,
    from 1, and the rolling hash (two 64-bit words) of the turns up to it.

    The hash is the exclusive or of hashes of (number, turn), so partitions
    can be hashed on their own and put together afterwards.
    """
    narrow = s.select("conv", "pid", "idx", "digest")
    before = store.put(_carried(
        narrow.groupBy("conv", "pid").agg(F.count(F.lit(1)).alias("rows")), "rows", F.sum, "before"))
    local = Window.partitionBy("conv", "pid").orderBy("idx")
    rolling = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    y = store.put(
        _with_carried(narrow, before, ["before"])
        .withColumn("pos", F.row_number().over(local) + F.col("before"))
        .withColumn("tx", F.xxhash64("pos", "digest"))
        .withColumn("ty", F.xxhash64(F.lit("second"), "digest", "pos"))
        .withColumn("x", F.bit_xor("tx").over(rolling)).withColumn("y", F.bit_xor("ty").over(rolling))
    )
    total = y.groupBy("conv", "pid").agg(F.bit_xor("tx").alias("x"), F.bit_xor("ty").alias("y"))
    for name in ("x", "y"):
        carried = _carried(total.select("conv", "pid", name), name, F.bit_xor, f"{name}0")
        y = _with_carried(y, carried, [f"{name}0"]).withColumn(name, F.col(name).bitwiseXOR(F.col(f"{name}0")))
    return store.put(y.select("conv", "pid", "idx", "pos", "x", "y"))


def _piece(role: Column, text: Column) -> Column:
    """One turn; markers inside it are broken up, so it can't pose as a turn."""
    def plain(c):
        return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))

    return F.concat(F.lit("<|im_start|>"), plain(role), F.lit("\n"), plain(text), F.lit("<|im_end|>\n"))


def collapse(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """Maximal conversations, rendered.

    Returns conv_id, segment (0 but for conversations of more than
    ``segment_turns`` turns, which have one row per so many), n_turns,
    n_copies (conversations equal to it, itself included; the smallest
    conv_id stands for them) and text, one row per conversation that is no
    prefix of a longer one.

    Turns go by their number, ties by role, then by text (null first, else by
    their bytes); only their order counts, not the numbers. Repeated rows
    are turns of their own. Turns with a null conv_id are one conversation.
    Null roles and texts are rendered as empty but differ from empty ones.
    An empty table gives an empty result; other columns are not read.
    """
    store = Store(turns.sparkSession, "chat")
    s = ordered_turns(store, turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    ))
    y = prefix_hashes(store, s)
    last = y.groupBy("conv").agg(F.max(F.struct("pos", "x", "y")).alias("l")).select("conv", "l.*")
    whole = last.groupBy("pos", "x", "y").agg(F.count(F.lit(1)).alias("n_copies"), F.min("conv").alias("keep"))
    # a prefix that more conversations have than end with it goes on in another
    prefixes = y.groupBy("pos", "x", "y").agg(F.count(F.lit(1)).alias("having"))
    w, p = whole.alias("w"), prefixes.alias("p")
    longer = (
        (F.col("w.pos") == F.col("p.pos")) & (F.col("w.x") == F.col("p.x")) & (F.col("w.y") == F.col("p.y"))
        & (F.col("p.having") > F.col("w.n_copies"))
    )
    kept = store.put(
        w.join(p, longer, "left_anti").select(
            F.col("w.keep").alias("_keep"), F.col("w.pos").cast("bigint").alias("n_turns"), "n_copies")
    )
    own = s.join(kept, s["conv"].eqNullSafe(kept["_keep"]))
    # only conversations of several segments need their turns' numbers
    long = (
        y.join(kept.where(F.col("n_turns") > segment_turns), y["conv"].eqNullSafe(F.col("_keep")), "left_semi")
        .select(F.col("pid").alias("_p"), F.col("idx").alias("_i"),
                F.expr(f"(pos - 1) div {segment_turns}").cast("bigint").alias("segment"))
    )
    parts = own.join(long, (own["pid"] == long["_p"]) & (own["idx"] == long["_i"]), "left").withColumn(
        "segment", F.coalesce("segment", F.lit(0).cast("bigint")))
    in_order = F.array_sort(F.collect_list(F.struct("pid", "idx", _piece(F.col("role"), F.col("text")).alias("piece"))))
    return parts.groupBy("conv", "segment", "n_turns", "n_copies").agg(
        F.array_join(F.transform(in_order, lambda t: t["piece"]), "").alias("text")
    ).select(F.col("conv").alias("conv_id"), "segment", "n_turns", "n_copies", "text")


CHAT_SQL = f"""
WITH c AS (
  SELECT conv_id, count(*) AS n,
         list({{'r': role, 't': text}} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS l,
         list('<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10)
              || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10)
              ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pieces
  FROM conversations GROUP BY conv_id
), d AS (
  SELECT min(conv_id) AS conv_id, l, any_value(n) AS n, any_value(pieces) AS pieces, count(*) AS n_copies FROM c GROUP BY l
), kept AS (
  SELECT conv_id, n, n_copies, pieces, unnest(generate_series(0, (n - 1) // {SEGMENT_TURNS})) AS segment FROM d a
  WHERE NOT EXISTS (SELECT 1 FROM d b WHERE b.n > a.n AND b.l[1] = a.l[1] AND b.l[1:a.n] = a.l)
)
SELECT conv_id, CAST(segment AS BIGINT) AS segment, n AS n_turns, n_copies,
       array_to_string(pieces[segment * {SEGMENT_TURNS} + 1:(segment + 1) * {SEGMENT_TURNS}], '') AS text
FROM kept
"""
