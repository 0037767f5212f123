import math
import random

from textquarry.operators import topics

EPS = 1e-12


def brute_cv(docs, topic_words, window):
    wins = []
    for toks in docs:
        if len(toks) <= window:
            wins.append(set(toks))
        else:
            for s in range(len(toks) - window + 1):
                wins.append(set(toks[s:s + window]))
    n = len(wins)

    def p(*ws):
        return sum(1 for w in wins if all(x in w for x in ws)) / n

    out = {}
    for t, words in topic_words.items():
        def npmi(w, v):
            pwv = p(w, v) + EPS
            pw, pv = p(w), p(v)
            if pw == 0 or pv == 0:
                return 0.0
            return math.log(pwv / (pw * pv)) / -math.log(pwv)
        vec = {w: [npmi(w, v) for v in words] for w in words}
        tot = [sum(vec[w][i] for w in words) for i in range(len(words))]
        scores = []
        for w in words:
            dot = sum(a * b for a, b in zip(vec[w], tot))
            n1 = math.sqrt(sum(a * a for a in vec[w]))
            n2 = math.sqrt(sum(b * b for b in tot))
            scores.append(dot / (n1 * n2) if n1 * n2 else 0.0)
        out[t] = sum(scores) / len(scores)
    out[-1] = sum(out.values()) / len(topic_words)
    return out


def test_coherence_matches_brute_force(spark):
    rnd = random.Random(5)
    vocab = ["a", "b", "c", "d", "e", "f", "g"]
    docs = [[rnd.choice(vocab) for _ in range(rnd.randint(1, 12))] for _ in range(25)]
    tw = {0: ["a", "b", "c"], 1: ["d", "e", "a"]}
    ddf = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc_num long, tokens array<string>")
    tdf = spark.createDataFrame([(t, r + 1, w) for t, ws in tw.items() for r, w in enumerate(ws)],
                                "topic long, rank long, term string")
    got = {r.topic: r.coherence for r in topics.topic_coherence(tdf, ddf, "tokens", 3, 3).collect()}
    want = brute_cv(docs, tw, 3)
    for t in want:
        assert abs(got[t] - want[t]) < 1e-9


def test_no_term_is_dropped(spark):
    n = (1 << 18) + 100
    docs = spark.range(4).selectExpr("id AS doc_num", f"transform(sequence(id, {n - 1}, 4), x -> concat('t', x)) AS tokens")
    lda, cv, vec = topics.fit_topics(docs, "tokens", k=2, max_iter=1)
    assert len(cv.vocabulary) == n == lda.vocabSize()
    assert sum(r.features.values.sum() for r in vec.collect()) == n
    words = topics.topic_words(lda, cv, 5).collect()
    assert len(words) == 10 and {r.term for r in words} <= set(cv.vocabulary)


def test_every_pass_reads_all_documents(spark):
    """Two vocabularies that never meet become two topics, and the model's passes use the whole corpus."""
    import random

    from textquarry.operators import topics

    r = random.Random(4)
    words = [[f"{side}{i}" for i in range(8)] for side in ("a", "b")]
    rows = [(i, [r.choice(words[i % 2]) for _ in range(30)]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_num long, tokens array<string>")
    lda, cv, vec = topics.fit_topics(docs, k=2, max_iter=10)
    assert lda.getOrDefault("subsamplingRate") == 1.0 and vec.count() == 60
    found = {}
    for w in topics.topic_words(lda, cv, 8).collect():
        found.setdefault(w.topic, set()).add(w.term)
    assert sorted(map(sorted, found.values())) == [sorted(words[0]), sorted(words[1])]


def test_pairs_are_counted_one_way(spark, monkeypatch):
    from textquarry.operators import topics as T

    seen, whole = [], T._union_length
    monkeypatch.setattr(T, "_union_length", lambda x, keys: seen.append(x) or whole(x, keys))
    docs = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["b", "a"]), (3, ["c"])], "doc_num long, tokens array<string>")
    tw = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (0, 3, "c")], "topic long, rank int, term string")
    assert T.topic_coherence(tw, docs, "tokens", 2, 3).count() == 2
    assert all(r.w < r.v for r in seen[1].collect())
