"""Term features as long sparse tables ``(doc_num, term, value)``.

The dense features x documents matrix of a single-machine build becomes
a long table with one row per non-zero cell. The vocabulary is capped
(default 4096 terms), which bounds every table broadcast from it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokenize
from .joins import checked_broadcast
from .keys import ordered_index

FEATURE_CAP = 4096
# Documents whose tokens a task counts at a time.
DOCUMENTS = 512
# Cells of a matrix that a task sorts by document.
CELLS = 1 << 18


def clean_text(df: DataFrame, fields: Mapping[str, str], stopwords, all_col: str = "all_text_list",
               singular: bool = False) -> DataFrame:
    """Tokenize each source column into ``<out>_list`` (array) and ``<out>``
    (space-joined), plus the concatenation of all lists."""
    out = df
    lists = []
    for src, dst in fields.items():
        out = out.withColumn(f"{dst}_list", tokenize(src, stopwords, singular))
        out = out.withColumn(dst, F.array_join(F.col(f"{dst}_list"), " "))
        lists.append(F.col(f"{dst}_list"))
    return out.withColumn(all_col, F.concat(*lists))


def _counted(doc: str):
    """mapInArrow: ``(doc_num, term, tf)`` of rows ``(doc, tokens)``, a few documents at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, DOCUMENTS):
                b = whole.slice(at, DOCUMENTS)
                lists = b.column("tokens")
                coded = pc.list_flatten(lists).dictionary_encode()
                row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
                known = code >= 0
                size = max(len(coded.dictionary), 1)
                cell, n = np.unique(row[known] * size + code[known], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(doc).take(pa.array(cell // size)), coded.dictionary.take(pa.array(cell % size)),
                     pa.array(n, pa.int64())], ["doc_num", "term", "tf"])

    return run


def term_counts(df: DataFrame, tokens: str = "tokens", doc: str = "doc_num") -> DataFrame:
    """``(doc_num, term, tf)``: occurrences of each token per document.

    A row's tokens are counted where the row is, so a task holds the counts of
    a few documents and nothing is shuffled. Only the keys that several rows
    share (or null, if several rows have none) are summed by an aggregation.
    """
    kind = df.schema[doc].dataType.simpleString()

    def counted(rows: DataFrame) -> DataFrame:
        pairs = rows.select(F.col(doc), F.col(tokens).alias("tokens"))
        return pairs.mapInArrow(_counted(doc), f"doc_num {kind}, term string, tf bigint")

    shared = df.groupBy(F.col(doc).alias("_key")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_key")
    if shared.isEmpty():
        return counted(df)
    shared = checked_broadcast(shared.checkpoint(eager=True))
    same = F.col(doc).eqNullSafe(F.col("_key"))
    summed = counted(df.join(shared, same, "left_semi")).groupBy("doc_num", "term").agg(F.sum("tf").alias("tf"))
    return counted(df.join(shared, same, "left_anti")).union(summed)


def vocabulary(tf: DataFrame, n: int = FEATURE_CAP) -> DataFrame:
    """Top ``n`` terms by corpus frequency (term ascending breaks ties):
    ``(term, term_id, corpus_tf, df)``; ``term_id`` is 0-based alphabetical.

    ``orderBy().limit(n)`` keeps ``n`` rows per task (TakeOrderedAndProject);
    the id window then runs over at most ``n`` rows.
    """
    per_term = tf.groupBy("term").agg(
        F.sum("tf").cast("bigint").alias("corpus_tf"), F.count(F.lit(1)).cast("bigint").alias("df")
    )
    top = per_term.orderBy(F.col("corpus_tf").desc(), F.col("term").asc()).limit(n)
    return top.withColumn("term_id", (F.row_number().over(Window.orderBy("term")) - 1).cast("bigint"))


def count_matrix(tf: DataFrame, vocab: DataFrame, cap: int = FEATURE_CAP) -> DataFrame:
    """Counts restricted to the vocabulary (broadcast: at most ``cap`` rows)."""
    v = checked_broadcast(vocab.select("term"))
    return tf.join(v, "term").select("doc_num", "term", F.col("tf").cast("double").alias("value"))


def clip_matrix(x: DataFrame) -> DataFrame:
    """Presence matrix: every stored count clipped to 1."""
    return x.withColumn("value", F.least(F.col("value"), F.lit(1.0)))


def tfidf_matrix(tf: DataFrame, vocab: DataFrame, n_docs: int, cap: int = FEATURE_CAP) -> DataFrame:
    """Smoothed TF-IDF, ``tf * (ln((1+n)/(1+df)) + 1)``, rows L2-normalised.

    ``n_docs`` counts every document of the corpus, including those that
    hold no vocabulary term. The row norm is a window over ``doc_num``, dealt
    to as many tasks as the matrix has cells for (the ``df`` of its terms), so
    that what a task sorts does not grow with the corpus.
    """
    cells = vocab.agg(F.sum("df")).first()[0] or 0
    idf = vocab.select(
        "term", (F.log((F.lit(1.0) + F.lit(n_docs)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf")
    )
    raw = tf.join(checked_broadcast(idf), "term").select(
        "doc_num", "term", (F.col("tf") * F.col("idf")).alias("raw")
    )
    raw = raw.repartition(max(1, -(-cells // CELLS)), "doc_num")
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc_num")))
    return raw.select("doc_num", "term", (F.col("raw") / norm).alias("value"))


def bag_of_words(tf: DataFrame, vocab: DataFrame, cap: int = FEATURE_CAP) -> DataFrame:
    """``(doc_num, term_id, tf)`` over the vocabulary."""
    v = checked_broadcast(vocab.select("term", "term_id"))
    return tf.join(v, "term").select("doc_num", "term_id", "tf")


def label_encode(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Replace each string column by the 0-based index of its value among
    the sorted distinct values (nulls stay null).

    The distinct values are numbered with range partitioning, so a column
    of full texts (millions of distinct values) never meets a single-task
    window; the code table is joined back, broadcast when small.
    """
    out = df
    for c in cols:
        codes = ordered_index(df.select(c).where(F.col(c).isNotNull()).distinct(), [c], name="_code")
        codes = codes.select(F.col(c).alias("_val"), "_code")
        out = out.join(checked_broadcast(codes), out[c] == codes["_val"], "left")
        out = out.withColumn(c + suffix, F.col("_code").cast("bigint")).drop("_val", "_code")
    return out


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """``(x - mean) / population std``; a constant column becomes 0.

    The means and deviations are one aggregate row read on the driver.
    """
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    stats = df.agg(*aggs).first()
    out = df
    for c in cols:
        m, s = stats[f"m_{c}"], stats[f"s_{c}"]
        scaled = F.coalesce(F.try_divide(F.col(c).cast("double") - F.lit(m), F.lit(s)), F.lit(0.0))
        if not s:
            scaled = F.when(F.col(c).isNull(), None).otherwise(F.lit(0.0))
        out = out.withColumn(c + suffix, scaled)
    return out
