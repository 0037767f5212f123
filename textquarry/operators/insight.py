"""Topic labelling of related documents, with grouped summaries.

For each topic (a word) the documents related to it are scored against
each of the topic's candidate labels; the best label and its softmax
score are kept, keyed by ``(doc_num, topic)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .counts import group_summary, histogram
from .joins import checked_broadcast
from .related import related_documents, term_similarity, top_terms


def topics_frame(spark, rows) -> DataFrame:
    """A small literal topic table ``(topic, labels array<string>)``."""
    return spark.createDataFrame(rows, "topic string, labels array<string>")


def label_vectors(scores: DataFrame, top_feature: int = 20) -> DataFrame:
    """``(label, term, w)``: the label's ``top_feature`` most similar tokens by
    ``scores`` (the label as ``target_word``), weights L2-normalised (the
    default scorer's label vector)."""
    top = top_terms(scores, top_feature)
    top = top.select(F.col("target_word").alias("label"), "term", "score").checkpoint(eager=True)
    norm = top.groupBy("label").agg(F.sqrt(F.sum(F.col("score") * F.col("score"))).alias("nrm"))
    return top.join(norm, "label").select(
        "label", "term", F.coalesce(F.try_divide(F.col("score"), F.col("nrm")), F.lit(0.0)).alias("w")
    )


def label_documents(x_tfidf: DataFrame, x_count: DataFrame, docs: DataFrame, topics: DataFrame,
                    vectors: DataFrame, token_list: DataFrame, top_feature: int = 20,
                    top_document: int = 100, scorer=None) -> DataFrame:
    """``(doc_num, topic, label, score)``.

    Documents: the ``top_document`` most related to the topic word.
    Default scorer: ``raw = sum_t tfidf(d, t) * w_label(t)``; ``score`` is the
    softmax of ``raw`` over the topic's labels; the best label wins, an
    earlier label on a tie. ``scorer`` may instead be a function
    ``(pairs) -> pairs + raw`` over ``(doc_num, topic, label_pos, label)``,
    e.g. a ``pandas_udf`` model applied to the document text.
    """
    lab = topics.select("topic", F.posexplode("labels").alias("label_pos", "label"))
    targets = topics.select(F.col("topic").alias("target_word")).distinct()
    labels = lab.select(F.col("label").alias("target_word")).distinct()
    words = targets if scorer is not None else targets.union(labels).distinct()
    # A row per word and token, written once: topics and labels take their terms from it.
    scores = term_similarity(vectors, words, token_list).checkpoint(eager=True)
    of = lambda some: scores.join(F.broadcast(some), "target_word", "left_semi")
    rel = related_documents(x_count, of(targets), docs, top_feature, top_document).select(
        F.col("target_word").alias("topic"), "doc_num").checkpoint(eager=True)
    pairs = rel.join(checked_broadcast(lab), "topic")
    if scorer is None:
        lv = label_vectors(of(labels), top_feature)
        # At most topics x top_document ids, as a list: Spark takes such a filter (not a join)
        # below the window of the TF-IDF norm, so only the documents scored are normed.
        wanted = sorted(r[0] for r in rel.select("doc_num").where("doc_num IS NOT NULL").distinct().collect())
        raw = (
            x_tfidf.where(F.col("doc_num").isin(wanted))
            .join(checked_broadcast(lv), "term")
            .groupBy("doc_num", "label")
            .agg(F.sum(F.col("value") * F.col("w")).alias("raw"))
        )
        scored = pairs.join(raw, ["doc_num", "label"], "left").withColumn(
            "raw", F.coalesce(F.col("raw"), F.lit(0.0))
        )
    else:
        scored = scorer(pairs)
    best = scored.groupBy("doc_num", "topic").agg(
        F.max("raw").alias("_m"),
        F.max_by(F.struct("label", "raw"), F.struct(F.col("raw"), -F.col("label_pos"))).alias("_best"),
        F.collect_list("raw").alias("_raws"),
    )
    z = F.aggregate("_raws", F.lit(0.0), lambda acc, r: acc + F.exp(r - F.col("_m")))
    return best.select(
        "doc_num", "topic", F.col("_best.label").alias("label"),
        (F.exp(F.col("_best.raw") - F.col("_m")) / z).alias("score"),
    )


def topic_summary(insight: DataFrame) -> DataFrame:
    """Count of documents, mean and median score per (topic, label)."""
    return group_summary(insight, ["topic", "label"], "doc_num", "score")


def score_histogram(insight: DataFrame, bins: int = 10) -> DataFrame:
    return histogram(insight, "score", ["topic", "label"], 0.0, 1.0, bins)
