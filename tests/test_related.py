import pytest
from pyspark.sql import functions as F

from textquarry.operators import joins, related


def corpus(spark):
    tf = spark.createDataFrame(
        [(0, "virus", 3), (0, "cell", 1), (1, "virus", 1), (1, "host", 2), (2, "cell", 4), (3, "other", 1)],
        "doc_num long, term string, tf long",
    )
    docs = spark.createDataFrame([(i,) for i in range(5)], "doc_num long")
    vocab = spark.createDataFrame([("virus",), ("cell",), ("host",), ("other",)], "term string")
    x = tf.select("doc_num", "term", F.col("tf").cast("double").alias("value"))
    return tf, docs, vocab, x


def test_unknown_target_raises(spark):
    tf, _, _, _ = corpus(spark)
    vec = related.vectors_from_counts(tf)
    targets = spark.createDataFrame([("virus",), ("vaccine",)], "target_word string")
    with pytest.raises(ValueError, match="vaccine"):
        related.check_targets(vec, targets)


def test_related_documents_orders(spark):
    tf, docs, vocab, x = corpus(spark)
    vec = related.vectors_from_counts(tf)
    targets = spark.createDataFrame([("virus",)], "target_word string")
    scores = related.term_similarity(vec, targets, vocab)
    s = {r.term: r.score for r in scores.collect()}
    assert abs(s["virus"] - 1.0) < 1e-12 and s["other"] is None
    # Kept terms: virus (1.0) and host (0.32 > cell 0.23); sums per document 3, 3, 0, 0, 0.
    most = related.related_documents(x, scores, docs, top_feature=2, top_document=3).orderBy("rank").collect()
    assert [r.doc_num for r in most] == [0, 1, 2]          # ties by doc_num
    least = related.related_documents(x, scores, docs, top_feature=2, top_document=3, order="as_coded")
    assert [r.doc_num for r in least.orderBy("rank").collect()] == [2, 3, 4]
    with pytest.warns(UserWarning):
        related.related_documents(x, scores, docs, top_feature=10, top_document=3)


def test_first_match_join_hot_key(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    rows = [(1, i, f"r{i}") for i in range(5000, 0, -1)] + [(2, 7, "only")]
    right = spark.createDataFrame(rows, "rk long, ord long, payload string")
    got = {r.k: (r.ord, r.payload) for r in joins.first_match_join(left, right, "k", "rk", ["ord"]).collect()}
    assert got == {1: (1, "r1"), 2: (7, "only")}
