"""Documents related to target words.

``vectors`` is any long table ``(term, dim, value)``. The default built by
the queries is each term's column of the count matrix over all corpus
terms (``dim`` = document), i.e. document co-occurrence; a trained
``Word2VecModel.getVectors()`` table exploded to that shape works too.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import FEATURE_CAP
from .joins import checked_broadcast
from .keys import top_k_per_group

# Scores are compared after rounding to this many digits, so a ranking does
# not depend on the order in which a sum was accumulated.
SCORE_DIGITS = 9


def vectors_from_counts(tf: DataFrame) -> DataFrame:
    """``(term, dim, value)`` from ``(doc_num, term, tf)``."""
    return tf.select("term", F.col("doc_num").alias("dim"), F.col("tf").cast("double").alias("value"))


def check_targets(vectors: DataFrame, targets: DataFrame) -> None:
    """Raise ``ValueError`` when a target word has no vector (small list)."""
    present = vectors.join(checked_broadcast(targets.select(F.col("target_word").alias("term"))), "term", "left_semi")
    present = present.select(F.col("term").alias("target_word")).distinct()
    missing = targets.join(present, "target_word", "left_anti")
    bad = [r[0] for r in missing.limit(20).collect()]
    if bad:
        raise ValueError(f"target words without a vector: {bad}")


def term_similarity(vectors: DataFrame, targets: DataFrame, token_list: DataFrame,
                    cap: int = FEATURE_CAP) -> DataFrame:
    """``(target_word, term, score)``: cosine between each token of
    ``token_list`` (``term``) and each target word (``target_word``);
    NULL when the token shares no dimension with the target.

    The target vectors become one row per dimension with a column for each
    target, met by the token vectors in a join on ``dim``; one aggregation then
    takes the norms and all products. The target list is short, the token list
    at most one vocabulary and broadcast.
    """
    words = sorted(r[0] for r in targets.select("target_word").distinct().collect())
    if not words:
        return token_list.sparkSession.createDataFrame([], "target_word string, term string, score double")
    tokens = token_list.select("term").distinct()
    tvec = vectors.join(checked_broadcast(targets.select(F.col("target_word").alias("term"))), "term").select(
        F.col("term").alias("target_word"), "dim", F.col("value").alias("tval")
    )
    wide = tvec.groupBy("dim").agg(
        *[F.sum(F.when(F.col("target_word") == w, F.col("tval"))).alias(f"_t{i}") for i, w in enumerate(words)]
    )
    # Norms only for the tokens and the targets, not for every corpus term.
    sums = (
        vectors.join(checked_broadcast(tokens), "term")
        .join(wide, "dim", "left")
        .groupBy("term")
        .agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("nrm"),
             *[F.sum(F.col("value") * F.col(f"_t{i}")).alias(f"_d{i}") for i in range(len(words))])
    )
    tnorm = tvec.groupBy("target_word").agg(F.sqrt(F.sum(F.col("tval") * F.col("tval"))).alias("tnrm"))
    each = F.explode(F.array(*[F.struct(F.lit(w).alias("target_word"), F.col(f"_d{i}").alias("dot")) for i, w in enumerate(words)]))
    return (
        tokens.join(sums, "term", "left")
        .select("term", "nrm", each.alias("_e"))
        .select("term", "nrm", "_e.target_word", "_e.dot")
        .join(F.broadcast(tnorm), "target_word", "left")
        .select("target_word", "term", F.try_divide(F.col("dot"), F.col("nrm") * F.col("tnrm")).alias("score"))
    )


def top_terms(scores: DataFrame, top_feature: int = 20) -> DataFrame:
    """First ``top_feature`` tokens per target: score descending with NULL
    last, then term; then NULL scores become 0."""
    ranked = top_k_per_group(
        scores.withColumn("_s", F.round("score", SCORE_DIGITS)),
        ["target_word"],
        [F.col("_s").desc_nulls_last(), F.col("term").asc()],
        top_feature,
    ).drop("_s")
    return ranked.withColumn("score", F.coalesce(F.col("score"), F.lit(0.0)))


def related_documents(x: DataFrame, scores: DataFrame, docs: DataFrame, top_feature: int = 20,
                      top_document: int = 100, order: str = "most", salt_buckets: int = 64) -> DataFrame:
    """``(target_word, doc_num, doc_score, rank)``: per target word the
    ``top_document`` documents by the summed values of its ``top_feature``
    best tokens (documents without them score 0).

    ``order='most'`` ranks the most related first; ``'as_coded'`` takes
    the lowest scores first. Every document competes for every target, so
    the per-target pick runs in two phases over salted buckets: no task
    ever sorts a whole target's documents.
    """
    # At most targets x top_feature rows; written once because the driver
    # reads the target list from it and the join below reuses it.
    kept = top_terms(scores, top_feature).select("target_word", "term").checkpoint(eager=True)
    per_target = {r[0]: r[1] for r in kept.groupBy("target_word").count().collect()}
    words = sorted(per_target)
    if any(v < top_feature for v in per_target.values()):
        warnings.warn(
            f"top_feature ({top_feature}) is not smaller than the token list; no feature filtering is done",
            stacklevel=2,
        )
    sums = (
        x.join(checked_broadcast(kept), "term")
        .groupBy("target_word", "doc_num")
        .agg(F.sum("value").alias("s"))
    )
    alldocs = docs.select("doc_num", F.explode(F.array(*[F.lit(w) for w in sorted(words)])).alias("target_word"))
    filled = alldocs.join(sums, ["target_word", "doc_num"], "left").select(
        "target_word", "doc_num", F.coalesce(F.col("s"), F.lit(0.0)).alias("doc_score")
    )
    key = F.col("doc_score").desc() if order == "most" else F.col("doc_score").asc()
    if order not in ("most", "as_coded"):
        raise ValueError(f"unknown order {order!r}")
    return top_k_per_group(filled, ["target_word"], [key, F.col("doc_num").asc()], top_document,
                           salt_buckets=salt_buckets, name="rank")


def interested_documents(related: DataFrame, docs: DataFrame, attrs: Sequence[str] = (),
                         distinct: bool = False) -> DataFrame:
    """Document rows gathered for every target word (UNION ALL of the
    per-target lists; a document related to two targets appears twice
    unless ``distinct``)."""
    out = related.select("target_word", "doc_num").join(docs.select("doc_num", *attrs), "doc_num")
    return out.select("doc_num", *attrs).distinct() if distinct else out


def vocab_coverage(token_list: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row: tokens without a vector, all tokens, and the share missing."""
    has = vectors.select("term").distinct().withColumn("_has", F.lit(1))
    j = token_list.select("term").distinct().join(has, "term", "left")
    return j.agg(
        F.count_if(F.col("_has").isNull()).cast("bigint").alias("missing"),
        F.count(F.lit(1)).cast("bigint").alias("tokens"),
    ).withColumn("missing_share", F.col("missing") / F.col("tokens"))
