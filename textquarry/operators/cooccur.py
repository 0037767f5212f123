"""Term vectors from windowed co-occurrence.

Counts of terms within a few words of each other, their positive pointwise
mutual information, and the leading singular vectors of that matrix as a
``(term, dim, value)`` table, the shape ``related.term_similarity`` takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import factor
from .joins import checked_broadcast

WINDOW = 5
DIMENSIONS = 50
# Documents whose pairs a task makes at a time, and pairs that it sums together.
DOCUMENTS = 256
PAIRS = 1 << 21


def _pair_counts(terms, window: int):
    """mapInArrow: ``(a, b, n)`` of the places ``a <= b`` in ``terms`` of all pairs of known
    tokens within the window of a document. Pairs are summed a few millions at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms.value, pa.string())

        def summed(codes: list[np.ndarray]) -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(codes), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair // len(known)), pa.array(pair % len(known)), pa.array(n)],
                                              ["a", "b", "n"])

        codes, held = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, DOCUMENTS):
                tokens = whole.column("tokens").slice(at, DOCUMENTS)
                doc = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False)
                place = pc.fill_null(pc.index_in(pc.list_flatten(tokens), known), -1).to_numpy().astype(np.int64)
                for step in range(1, min(window, len(doc) - 1) + 1):
                    x, y = place[:-step], place[step:]
                    near = (doc[:-step] == doc[step:]) & (x >= 0) & (y >= 0)
                    x, y = x[near], y[near]
                    codes.append(np.minimum(x, y) * len(known) + np.maximum(x, y))
                    held += len(x)
                    if held > PAIRS:
                        yield summed(codes)
                        codes, held = [], 0
        if held:
            yield summed(codes)

    return run


def cooccurrence(docs: DataFrame, vocab: DataFrame, window: int = WINDOW, tokens: str = "tokens") -> DataFrame:
    """``(term, context, n)``: how often ``context`` stands within ``window`` tokens
    before or after ``term``, both of the vocabulary. Symmetric.

    The pairs of a document are counted where the document is, by the terms' places
    in the broadcast vocabulary (bounded by its cap); sums of pairs are shuffled.
    Documents without tokens hold no pair.
    """
    spark = docs.sparkSession
    terms = sorted(r[0] for r in vocab.select("term").distinct().collect() if r[0] is not None)
    held = spark.sparkContext.broadcast(terms)
    t = F.col(tokens)
    one_way = (
        docs.where(t.isNotNull()).select(t.alias("tokens")).mapInArrow(_pair_counts(held, window), "a long, b long, n long")
        .groupBy("a", "b").agg(F.sum("n").alias("n"))
    )
    both = one_way.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"), "n")
    both = both.groupBy("p.a", "p.b").agg(F.sum("n").cast("bigint").alias("n"))
    names = spark.createDataFrame(list(enumerate(terms)), "id long, name string")
    for side, name in (("a", "term"), ("b", "context")):
        both = both.join(checked_broadcast(names.select(F.col("id").alias(side), F.col("name").alias(name))), side)
    return both.select("term", "context", "n")


def positive_pmi(counts: DataFrame) -> DataFrame:
    """``(term, context, pmi)`` where ``ln(n(t,c) N / (n(t) n(c)))`` is above zero.

    The sums of a term are one row each of at most a vocabulary.
    """
    sums = counts.groupBy("term").agg(F.sum("n").alias("s"))
    left = checked_broadcast(sums.select("term", F.col("s").alias("st")))
    right = checked_broadcast(sums.select(F.col("term").alias("context"), F.col("s").alias("sc")))
    total = sums.agg(F.coalesce(F.sum("s"), F.lit(0))).first()[0]
    pmi = F.log(F.col("n") * F.lit(float(total)) / (F.col("st").cast("double") * F.col("sc")))
    return (
        counts.join(left, "term").join(right, "context").select("term", "context", pmi.alias("pmi")).where("pmi > 0")
    )


def term_vectors(pmi: DataFrame, vocab: DataFrame, size: int, dimensions: int = DIMENSIONS) -> DataFrame:
    """``(term, dim, value)``: rows of ``U sqrt(S)`` of the PMI matrix's leading
    singular vectors. Terms without a context have no rows, as zero vectors;
    ``size`` bounds the term ids."""
    # the matrix is symmetric: its rows are the terms, its columns the contexts
    x = pmi.select(F.col("term").alias("doc_num"), F.col("context").alias("term"), F.col("pmi").alias("value"))
    rows = factor.write_rows(factor.sparse_rows(x, vocab, x.select("doc_num").distinct()), size)
    found = factor.components(rows, size, k=dimensions, centre=False)
    spark = pmi.sparkSession
    if found is None or not found.loadings.shape[1]:
        return spark.createDataFrame([], "term string, dim bigint, value double")
    n = rows.count()
    root = np.sqrt(np.sqrt(found.variances * max(n - 1, 1)))  # the square root of a singular value
    scaled = factor.Components(found.loadings / root, found.variances, found.shares, found.mean)
    each = factor.project(rows, scaled).select("doc_num", F.posexplode("pc").alias("dim", "value"))
    return each.select(F.col("doc_num").alias("term"), F.col("dim").cast("bigint"), "value")
