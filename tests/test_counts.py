from pyspark.sql import functions as F

from textquarry.operators import counts
from textquarry.operators.keys import avg_rank, ordered_index, top_k_per_group


def test_word_count_and_stop(spark):
    df = spark.createDataFrame([("The cat the, THE dog",), ("cat",)], "text string")
    wc = {r["word"]: r["count"] for r in counts.word_count(df, "text").collect()}
    assert wc == {"the": 2, "cat": 2, "the,": 1, "dog": 1}
    st = {r["word"] for r in counts.word_count(df, "text", stopwords=["the"]).collect()}
    assert st == {"cat", "the,", "dog"}
    norm = {r["word"]: r["count"] for r in counts.word_count_normalized(counts.word_count(df, "text")).collect()}
    assert norm["the"] == 3


def test_top_words_ordinal(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 5), ("d", 1)], "word string, count long")
    rows = counts.top_words(df, 3).orderBy("rank").collect()
    assert [(r.word, r.rank) for r in rows] == [("c", 1), ("a", 2), ("b", 3)]


def test_avg_rank_matches_pandas(spark):
    vals = [3.0, 1.0, 3.0, None, 2.0, 1.0, 1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = {r.id: r.r for r in avg_rank(df, "v", ascending=False, name="r").collect()}
    assert [got[i] for i in range(7)] == [1.5, 5.0, 1.5, None, 3.0, 5.0, 5.0]


def test_ordered_index_consecutive(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    rows = ordered_index(df, ["k"], name="i").collect()
    assert sorted((r.k, r.i) for r in rows) == [(k, k) for k in range(1000)]


def test_top_k_per_group_salted(spark):
    df = spark.range(0, 5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    out = top_k_per_group(df, ["g"], [F.col("v").desc()], 3, salt_buckets=16).collect()
    got = sorted((r.g, r.v, r.rn) for r in out)
    assert got == [(0, 4994, 3), (0, 4996, 2), (0, 4998, 1), (1, 4995, 3), (1, 4997, 2), (1, 4999, 1)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.999,), (1.0,), (-0.1,), (None,)], "s double")
    got = sorted((r.bucket, r["count"]) for r in counts.histogram(df, "s").collect() if r.bucket is not None)
    assert got == [(0, 1), (1, 2), (10, 1), (11, 1)]


def test_text_source_by_position(spark):
    df = spark.createDataFrame([("a b", "x", "c")], "t1 string, t2 string, t3 string")
    got = sorted(r.text for r in counts.text_source(df, [0, 2]).collect())
    assert got == ["a b", "c"]


def test_avg_rank_many_ties_across_partitions(spark):
    import random

    rnd = random.Random(11)
    vals = [rnd.randint(0, 60) / 4.0 for _ in range(5000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = {r.id: r.r for r in avg_rank(df, "v", ascending=True, name="r").collect()}
    order = sorted(vals)
    first = {}
    for pos, v in enumerate(order, start=1):
        first.setdefault(v, pos)
    count = {v: order.count(v) for v in set(order)}
    for i, v in enumerate(vals):
        assert got[i] == first[v] + (count[v] - 1) / 2.0


def test_exact_median_against_sorting(spark):
    import random
    import statistics

    r = random.Random(2)
    groups = {
        "one": [4.5], "two": [1.0, 2.0], "equal": [3.0] * 50, "odd": [r.gauss(0, 1) for _ in range(1001)],
        "wide": [r.uniform(-1, 1) * 10.0 ** r.randint(-300, 300) for _ in range(500)], "huge": [-1.7e308, 1.7e308, 5.0],
        "skew": [1.0] * 700 + [1.0 + i * 1e-15 for i in range(800)], None: [2.0, 8.0, 4.0, 6.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None), ("one", float("nan")), ("none", None)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    for buckets in (64, 1024):
        got = {x.g: x["m"] for x in counts.exact_median(df, ["g"], "v", "m", buckets).collect()}
        assert got == {**{g: statistics.median(vs) for g, vs in groups.items()}, "none": None}
    assert counts.exact_median(df.limit(0), ["g"], "v").collect() == []


def test_group_summary_keeps_every_group(spark):
    df = spark.createDataFrame([("a", "x", 1, 2.0), ("a", "x", 2, 4.0), ("a", None, 3, 5.0), ("b", "y", None, None)],
                               "t string, l string, doc_num long, score double")
    got = {(r.t, r.l): tuple(r)[2:] for r in counts.group_summary(df, ["t", "l"], "doc_num", "score").collect()}
    assert got == {("a", "x"): (2, 3.0, 3.0), ("a", None): (1, 5.0, 5.0), ("b", "y"): (0, None, None)}
