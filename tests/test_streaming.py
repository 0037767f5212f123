import os

from textquarry.streaming.word_count_stream import document_stream, start_counts, streaming_word_count


def test_streaming_word_count_matches_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    os.makedirs(src)
    a = spark.createDataFrame([(1, "a b a", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    b = spark.createDataFrame([(2, "b c", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    a.write.parquet(os.path.join(src, "p1"))
    q = start_counts(streaming_word_count(document_stream(spark, src + "/*")), str(tmp_path / "ckpt"), "wc_test")
    try:
        q.processAllAvailable()
        b.write.parquet(os.path.join(src, "p2"))
        q.processAllAvailable()
        got = {r.word: r["count"] for r in spark.sql("SELECT * FROM wc_test").collect()}
    finally:
        q.stop()
    assert got == {"a": 2, "b": 2, "c": 1}
