import pytest
from pyspark.sql import functions as F

from textquarry.operators import features


@pytest.fixture(scope="module")
def tokens(spark):
    rows = [(1, ["b", "a", "b", None, ""]), (2, []), (3, None), (4, ["a"] * 700 + ["c"])]
    rows += [(i, ["a", f"t{i % 7}"]) for i in range(10, 700)]
    return spark.createDataFrame(rows, "doc_num long, tokens array<string>").repartition(3)


def plainly(df):
    e = df.select("doc_num", F.explode("tokens").alias("term")).where("term IS NOT NULL")
    return sorted(map(tuple, e.groupBy("doc_num", "term").count().collect()), key=repr)


def test_counts_are_taken_where_the_document_is(tokens):
    tf = features.term_counts(tokens)
    assert tf.dtypes == [("doc_num", "bigint"), ("term", "string"), ("tf", "bigint")]
    assert sorted(map(tuple, tf.collect()), key=repr) == plainly(tokens)
    plan = tf._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan  # a task's memory does not grow with the corpus


def test_counts_of_repeated_and_null_keys_are_summed(spark, tokens):
    more = spark.createDataFrame([(1, ["b", "z"]), (None, ["a"]), (None, ["a", "b"]), (9, ["k"]), (9, None)],
                                 "doc_num long, tokens array<string>")
    both = tokens.union(more)
    got = sorted(map(tuple, features.term_counts(both).collect()), key=repr)
    assert got == plainly(both) and (1, "b", 3) in got and (None, "a", 2) in got


def test_tasks_of_the_norm_follow_the_cells(spark, tokens, monkeypatch):
    monkeypatch.setattr(features, "CELLS", 50)
    tf = features.term_counts(tokens)
    vocab = features.vocabulary(tf)
    x = features.tfidf_matrix(tf, vocab, 694)
    cells = tf.count()
    assert x.rdd.getNumPartitions() == -(-cells // 50)
    norms = x.groupBy("doc_num").agg(F.sum(F.col("value") * F.col("value")).alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in norms)
