"""Broadcast only below a size in bytes."""

from pyspark.sql import functions as F

from textquarry.operators import features, joins


def test_side_bytes_measures_strings(spark):
    df = spark.range(1000).select(F.repeat(F.lit("x"), 500).alias("s")).checkpoint()
    assert 500_000 <= joins.side_bytes(df, 1) <= 600_000


def test_large_vocabulary_is_not_broadcast(spark):
    vocab = spark.range(3_000_000).select(
        F.concat(F.lit("term"), F.col("id").cast("string")).alias("term"), F.col("id").alias("term_id"))
    tf = vocab.select(F.lit(1).alias("doc_num"), "term", F.lit(1).alias("tf"))
    assert "broadcast" not in features.count_matrix(tf, vocab)._jdf.queryExecution().optimizedPlan().toString().lower()
    small = vocab.limit(4096)
    assert "broadcast" in features.count_matrix(tf, small)._jdf.queryExecution().optimizedPlan().toString().lower()
