"""Mixing sources to target weights by capped water-filling.

Sources, in order of their code points (null last), weigh 1, 2, 3, ... in
turn. Each source's target is its weight's part of all words, clamped at
``max_epochs`` times its own size; what clamped sources leave over goes to
the others in proportion to their weights until no target is above its cap.
A document is repeated whole floor(target / size of its source) times; the
fractional repetition goes to documents in the order of a seeded hash until
the source's words are used up, the last one taken in part.
"""

from __future__ import annotations

import itertools
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textquarry.operators.keys import ordered_index

from .common import Store, fresh

# Words: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
SEED = "mix-1"
# Hex digits of the hash that number a part of a source's hash order; one task orders one part.
PART_DIGITS = 3


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def weights(sizes: DataFrame, pattern: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``sizes`` (source, source_size) with the weight of each source."""
    # UTF-8 bytes order strings by code point, as Spark compares them
    numbered = ordered_index(sizes, [F.col("source").asc_nulls_last()], "_n")
    weight = F.element_at(F.array(*[F.lit(w) for w in pattern]), (F.col("_n") % len(pattern) + 1).cast("int"))
    return numbered.withColumn("weight", weight.cast("bigint")).drop("_n")


def water_fill(store: Store, weighted: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight) with ``target``: clamp and reshare until feasible.

    Each round is one aggregate over the sources; only its two sums reach
    the driver. A clamped source stays clamped, as the level only rises.
    """
    s = store.put(weighted)
    cap = F.col("source_size") * max_epochs
    total = s.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = (0, 1)
    while True:
        # clamped: target at this level (share / weight) would be above the cap
        over = F.lit(level[0]) * F.col("weight") / F.lit(level[1]) > cap
        clamped, free = s.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(over, 0).otherwise(F.col("weight"))), F.lit(0)),
        ).first()
        if not free or (total - clamped, free) == level:
            break
        level = (total - clamped, free)
    share = (F.lit(float(level[0])) / F.lit(float(level[1]))) * F.col("weight")
    return s.withColumn("target", F.least(share, cap.cast("double")))


def _order(doc_id: Column, size: Column, seed: str) -> Column:
    """Place of a document in its source's seeded order (a string)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.concat(h, F.lpad(size.cast("string"), 20, "0"))


def plan(rows: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row a source of ``rows`` (doc_id, source, size): source,
    source_size, target, whole (repetitions of every document), cut, partial.

    Documents before ``cut`` in the source's order are taken once more, those
    at the cut ``partial`` words of it. Only the part of the hash order in
    which the extra words run out is ordered document by document.
    """
    store = Store(rows.sparkSession, "mixing")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = store.put(
        water_fill(store, weights(sizes), max_epochs)
        .withColumn("_want", F.floor("target").cast("bigint"))
        .withColumn("whole", F.when(F.col("source_size") > 0, F.expr("_want div source_size")).otherwise(F.lit(0)))
        .withColumn("whole", F.col("whole").cast("bigint"))
        .withColumn("extra", F.col("_want") - F.col("whole") * F.col("source_size"))
        .select(F.col("source").alias("_s"), "source_size", "target", "whole", "extra")
    )
    x = (
        rows.withColumn("_key", _order(F.col("doc_id"), F.col("size"), seed))
        .withColumn("_part", F.substring("_key", 1, PART_DIGITS))
    )
    # words of a source before each part of its order: one row a part
    sums = x.groupBy("source", "_part").agg(F.sum("size").alias("_sum")).withColumn(
        "_before", F.sum("_sum").over(Window.partitionBy("source").orderBy("_part")) - F.col("_sum"))
    edges = store.put(
        sums.join(targets, sums["source"].eqNullSafe(targets["_s"]))
        .where("_before < extra and extra <= _before + _sum")
        .select(F.col("_s").alias("_es"), F.col("_part").alias("_ep"), (F.col("extra") - F.col("_before")).alias("_need"))
    )
    keys = (
        x.join(edges, x["source"].eqNullSafe(edges["_es"]) & (x["_part"] == edges["_ep"]))
        .groupBy("_es", "_key").agg(
            F.first("_need").alias("_need"), F.first("size").alias("_size"), F.count(F.lit(1)).alias("_rows"))
    )
    run = F.sum(F.col("_size") * F.col("_rows")).over(Window.partitionBy("_es").orderBy("_key"))
    cuts = (
        keys.withColumn("_run", run - F.col("_size") * F.col("_rows"))
        .where("_run < _need and _need <= _run + _size * _rows")
        .select("_es", F.col("_key").alias("cut"), F.expr("(_need - _run) div _rows").alias("partial"))
    )
    return store.put(
        targets.join(cuts, targets["_s"].eqNullSafe(cuts["_es"]), "left")
        .select(F.col("_s").alias("source"), "source_size", "target", "whole",
                F.coalesce("cut", F.lit("")).alias("cut"),
                F.coalesce("partial", F.lit(0)).cast("bigint").alias("partial"))
    )


def taken(plan_row: str, doc_id: Column, size: Column, seed: str = SEED) -> tuple[Column, Column]:
    """(whole repetitions, words of the fractional one) of a document under its source's plan."""
    key, cut = _order(doc_id, size, seed), F.col(f"{plan_row}.cut")
    more = F.when(key < cut, size).when(key == cut, F.col(f"{plan_row}.partial")).otherwise(F.lit(0).cast("bigint"))
    return F.col(f"{plan_row}.whole"), more


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """How many words the mix takes of every document.

    Returns one row per row of ``docs``: doc_id, source, size, source_size,
    target (of its source), taken (words, repeats counted; at most
    ``max_epochs`` times its size). The taken words of a source add up to
    its target rounded down. Only whole repetitions and one partial document
    a source are used; the same rows and seed give the same mix.

    A null text has size 0; a null source is a source of its own, ordered
    last. Repeated rows and rows with a null id each count; rows equal in id
    and size have one place in the order, and if the words run out there
    each takes an equal part (the sum then falls short by less than a word a
    row). A source without words has target 0; an empty table gives an empty
    result. Other columns are not read.
    """
    rows = Store(docs.sparkSession, "mixing-rows").put(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col).cast("string")).alias("size"),
    ))
    p = plan(rows, max_epochs, seed).select(F.col("source").alias("_s"), F.struct("*").alias("p"))
    whole, more = taken("p", F.col("doc_id"), F.col("size"), seed)
    return rows.join(p, rows["source"].eqNullSafe(p["_s"])).select(
        "doc_id", rows["source"], "size", "p.source_size", "p.target", (whole * F.col("size") + more).alias("taken"),
    )


def _first_words(text: pd.Series, count: pd.Series) -> pd.Series:
    """The text up to the end of its ``count``-th word; null for null."""
    def head(t, n):
        end = next(itertools.islice(re.finditer(WORD, t), int(n) - 1, None)).end()
        return t[:end]

    return pd.Series([None if t is None else head(t, n) for t, n in zip(text, count)], dtype=object)


def materialise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: a row of ``docs`` for every repetition that is taken.

    Adds size, source_size, target, epoch (number of the repetition, from 1)
    and taken (words of this repetition); the partial document of a source
    keeps its first ``taken`` words. If docs has a column of such a name,
    the new one gets an underscore in front. The texts aren't shuffled: they
    meet their source's plan by a join on the source. The cases of ``mix``
    hold here as well; a document of no words is never taken.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"))
    p = plan(Store(docs.sparkSession, "mixing-rows").put(rows), max_epochs, seed)
    p = p.select(F.col("source").alias("_s"), F.struct("*").alias("p"))
    names = {c: fresh(docs.columns, c) for c in ("size", "source_size", "target", "epoch", "taken")}
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("doc_id"),
                    F.col(source_col).alias("source"), word_count(text).alias("size"))
    whole, more = taken("p", F.col("doc_id"), F.col("size"), seed)
    each = (
        d.join(p, d["source"].eqNullSafe(p["_s"])).withColumn("whole", whole).withColumn("more", more)
        .withColumn("times", (F.col("whole") + (F.col("more") > 0).cast("bigint")).cast("int"))
        .where("size > 0 and times > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .withColumn("taken", F.when(F.col("epoch") <= F.col("whole"), F.col("size")).otherwise(F.col("more")))
    )
    # only the partial documents, one a source, go through Python
    part = F.when(F.col("taken") < F.col("size"), F.col(f"row.`{text_col}`").cast("string"))
    cut = F.coalesce(F.pandas_udf(_first_words, StringType())(part, F.col("taken")), F.col(f"row.`{text_col}`"))
    return each.select(
        *[(cut if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns],
        F.col("size").alias(names["size"]), F.col("p.source_size").alias(names["source_size"]),
        F.col("p.target").alias(names["target"]), F.col("epoch").alias(names["epoch"]),
        F.col("taken").alias(names["taken"]),
    )


MIX_SQL = """
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight FROM s
), o AS (  -- in the order in which a rising level clamps the sources
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
         sum(3 * source_size) OVER q - 3 * source_size AS cap_before,
         sum(weight) OVER () - (sum(weight) OVER q - weight) AS weight_left
  FROM w WINDOW q AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), l AS (
  SELECT max(CAST(total - cap_before AS DOUBLE) / CAST(weight_left AS DOUBLE)) AS level FROM o
), t AS (
  SELECT source, source_size, least(level * weight, CAST(cap AS DOUBLE)) AS target FROM o, l
), x AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.source, CAST(floor(t.target) AS BIGINT) AS want,
         md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')) AS h
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), y AS (
  SELECT *, CASE WHEN source_size > 0 THEN want // source_size ELSE 0 END AS whole,
         sum(size) OVER (PARTITION BY source ORDER BY h, size ROWS UNBOUNDED PRECEDING) AS run
  FROM x
)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, want - whole * source_size - (run - size))) AS BIGINT) AS taken
FROM y
"""
