"""Topic models and topic coherence.

``fit_topics`` fits ``pyspark.ml.clustering.LDA`` (online variational
Bayes, learned document concentration) on term-count vectors built by
``CountVectorizer``. ``topic_coherence`` computes the c_v measure
(Roeder et al. 2015) with boolean sliding windows, as DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import checked_broadcast

EPS = 1e-12


def fit_topics(docs: DataFrame, tokens: str = "tokens", k: int = 4, max_iter: int = 10, seed: int = 42,
               vocab_size: int | None = None):
    """Fit LDA; returns ``(lda_model, count_vectorizer_model, vectors)``.

    All terms count, unless ``vocab_size`` asks for the most frequent only. Each of
    the ``max_iter`` passes reads all documents, from vectors stored once."""
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizer

    if vocab_size is None:
        vocab_size = max(1, docs.select(F.explode(tokens).alias("term")).agg(F.count_distinct("term")).first()[0])
    cv = CountVectorizer(inputCol=tokens, outputCol="features", vocabSize=vocab_size, minDF=1.0).fit(docs)
    vec = cv.transform(docs).checkpoint(eager=True)
    lda = LDA(k=k, maxIter=max_iter, seed=seed, optimizer="online", optimizeDocConcentration=True, subsamplingRate=1.0,
              featuresCol="features").fit(vec)
    return lda, cv, vec


def topic_words(lda, cv, n: int = 10) -> DataFrame:
    """``(topic, rank, term, weight)``: each topic's ``n`` heaviest terms."""
    described = lda.describeTopics(n)
    used = sorted({i for r in described.select("termIndices").collect() for i in r[0]})  # n a topic at most
    terms = cv.vocabulary
    vocab = described.sparkSession.createDataFrame([(i, terms[i]) for i in used], "term_index int, term string")
    t = described.select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("pos", "tw")
    )
    t = t.select(
        F.col("topic").cast("bigint"), (F.col("pos") + 1).cast("bigint").alias("rank"),
        F.col("tw.termIndices").alias("term_index"), F.col("tw.termWeights").alias("weight"),
    )
    return t.join(checked_broadcast(vocab), "term_index").drop("term_index")


def _occurrences(docs: DataFrame, words: DataFrame, tokens: str, window: int) -> DataFrame:
    """``(doc_num, term, lo, hi)``: each occurrence of a topic word with the
    range of window starts that cover it (a document shorter than the
    window is one window, start 0)."""
    occ = docs.select("doc_num", F.size(tokens).alias("len"), F.posexplode(tokens).alias("pos", "term"))
    occ = occ.join(checked_broadcast(words.select("term").distinct()), "term")
    last_start = F.greatest(F.col("len") - F.lit(window), F.lit(0))
    return occ.select(
        "doc_num", "term",
        F.greatest(F.col("pos") - F.lit(window - 1), F.lit(0)).alias("lo"),
        F.least(F.col("pos"), last_start).alias("hi"),
    )


def _union_length(intervals: DataFrame, keys) -> DataFrame:
    """Per ``keys`` (document included): the number of window starts in the
    union of the ``[lo, hi]`` ranges, by one ordered pass (each range adds
    what lies beyond the furthest end seen so far)."""
    w = Window.partitionBy(*keys).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    prev = F.max("hi").over(w)
    add = F.greatest(F.col("hi") - F.greatest(F.col("lo"), F.coalesce(prev + 1, F.col("lo"))) + 1, F.lit(0))
    return intervals.select(*keys, add.alias("a")).groupBy(*keys).agg(F.sum("a").alias("u"))


def n_windows(docs: DataFrame, tokens: str = "tokens", window: int = 110) -> int:
    return docs.agg(F.sum(F.greatest(F.size(tokens) - F.lit(window) + F.lit(1), F.lit(1)))).first()[0] or 0


def topic_coherence(topics: DataFrame, docs: DataFrame, tokens: str = "tokens", window: int = 110,
                    top_n: int = 20) -> DataFrame:
    """c_v coherence: ``(topic, coherence)`` per topic plus a row with
    ``topic = -1`` holding the mean over topics.

    ``topics`` is ``(topic, rank, term)``; the first ``top_n`` terms count.
    Boolean sliding windows of ``window`` tokens: p(w) is the share of
    windows holding w, p(w, v) of windows holding both.
    NPMI(w, v) = ln((p(w,v)+eps) / (p(w) p(v))) / -ln(p(w,v)+eps); each
    word's vector is its NPMI to every topic word; a word's score is the
    cosine of its vector with the topic's summed vector; a topic's
    coherence is the mean score of its words.

    Window counts come from interval arithmetic, not from listing windows:
    the windows holding w in a document are the union of the start ranges
    of its occurrences, and |U_w ∩ U_v| = |U_w| + |U_v| - |U_w ∪ U_v|, the
    last measured over both words' occurrences together. Work is linear in
    the occurrences times the topic size.
    """
    tw = topics.where(F.col("rank") <= top_n).select("topic", "term").distinct()
    occ = _occurrences(docs, tw, tokens, window).checkpoint(eager=True)
    n = float(n_windows(docs, tokens, window))
    single_cnt = _union_length(occ, ["doc_num", "term"]).groupBy("term").agg(F.sum("u").alias("sw"))
    single = single_cnt.select("term", (F.col("sw") / F.lit(n)).alias("p"), "sw")
    pairs = tw.select("topic", F.col("term").alias("w")).join(tw.select("topic", F.col("term").alias("v")), "topic")
    # a pair's windows are those of the pair turned round, so each is counted one way only
    distinct_pairs = checked_broadcast(pairs.where(F.col("w") < F.col("v")))
    both = (
        occ.join(distinct_pairs, occ["term"] == distinct_pairs["w"]).select("doc_num", "topic", "w", "v", "lo", "hi")
        .unionByName(
            occ.join(distinct_pairs, occ["term"] == distinct_pairs["v"]).select("doc_num", "topic", "w", "v", "lo", "hi")
        )
    )
    union_cnt = _union_length(both, ["doc_num", "topic", "w", "v"]).groupBy("topic", "w", "v").agg(F.sum("u").alias("swv"))
    union_cnt = union_cnt.select("swv", "topic", F.explode(F.array(
        F.struct("w", "v"), F.struct(F.col("v").alias("w"), F.col("w").alias("v")))).alias("p")).select("topic", "p.w", "p.v", "swv")
    sw = single.select(F.col("term").alias("w"), F.col("p").alias("pw"), F.col("sw").alias("cw"))
    sv = single.select(F.col("term").alias("v"), F.col("p").alias("pv"), F.col("sw").alias("cv"))
    j = pairs.join(union_cnt, ["topic", "w", "v"], "left").join(sw, "w", "left").join(sv, "v", "left")
    cw, cv = F.coalesce(F.col("cw"), F.lit(0)), F.coalesce(F.col("cv"), F.lit(0))
    inter = F.when(F.col("w") == F.col("v"), cw).otherwise(cw + cv - F.coalesce(F.col("swv"), cw + cv))
    pwv = inter / F.lit(n) + F.lit(EPS)
    npmi = F.coalesce(
        F.try_divide(F.log(F.try_divide(pwv, F.col("pw") * F.col("pv"))), -F.log(pwv)), F.lit(0.0)
    )
    m = j.select("topic", "w", "v", npmi.alias("npmi"))
    tsum = m.groupBy("topic", "v").agg(F.sum("npmi").alias("s"))
    jj = m.join(tsum, ["topic", "v"])
    cos = jj.groupBy("topic", "w").agg(
        F.sum(F.col("npmi") * F.col("s")).alias("dot"),
        F.sqrt(F.sum(F.col("npmi") * F.col("npmi"))).alias("n1"),
        F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("n2"),
    ).select("topic", F.coalesce(F.try_divide(F.col("dot"), F.col("n1") * F.col("n2")), F.lit(0.0)).alias("c"))
    per_topic = cos.groupBy("topic").agg(F.avg("c").alias("coherence"))
    overall = per_topic.agg(F.avg("coherence").alias("coherence")).select(F.lit(-1).cast("bigint").alias("topic"), "coherence")
    return per_topic.select(F.col("topic").cast("bigint"), "coherence").unionByName(overall)
