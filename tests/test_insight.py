from pyspark.sql import functions as F

from textquarry.operators import features, insight, related


def test_similarities_are_taken_once_and_only_scored_documents_are_normed(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, (["a"] * (i % 5 + 1)) + ["b", "d"] * (i % 3) + ["c", "e"] * (i % 2)) for i in range(40)],
        "doc_num long, tokens array<string>")
    tf = features.term_counts(docs).checkpoint()
    vocab = features.vocabulary(tf).checkpoint()
    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x

    x_tfidf = features.tfidf_matrix(tf, vocab, 40)
    tally = F.udf(seen, "double")
    # counted below the window, as the TF-IDF norm's input is
    monkeypatch.setattr(features, "checked_broadcast", lambda df: df)
    marked = features.tfidf_matrix(tf.withColumn("tf", tally(F.col("tf").cast("double"))), vocab, 40)
    calls, whole = [], insight.term_similarity
    monkeypatch.setattr(insight, "term_similarity", lambda *a: calls.append(a) or whole(*a))
    topics = insight.topics_frame(spark, [("a", ["b", "c"]), ("d", ["e", "b"])])
    args = (features.count_matrix(tf, vocab), docs, topics, related.vectors_from_counts(tf), vocab, 2, 3)
    got = sorted(map(tuple, insight.label_documents(x_tfidf, *args).collect()))
    assert len(got) == 6 and len(calls) == 1
    assert sorted(map(tuple, insight.label_documents(marked, *args).collect())) == got
    ids = {r[0] for r in got}
    assert 0 < read.value == tf.where(F.col("doc_num").isin(ids)).count() < tf.count()
