import math
from collections import Counter

import numpy as np

from textquarry.operators import cooccur, related


def corpus(spark):
    rng = np.random.default_rng(6)
    docs = [(i, [f"w{j}" for j in rng.integers(0, 12, rng.integers(0, 40))]) for i in range(30)]
    docs += [(100, []), (101, None), (102, ["w1"]), (103, ["w1", "w2"])]
    df = spark.createDataFrame(docs, "doc_num long, tokens array<string>")
    vocab = spark.createDataFrame([(f"w{j}", j) for j in range(10)], "term string, term_id long")
    return docs, df, vocab


def counted(docs, window, known):
    n = Counter()
    for _, t in docs:
        for i, a in enumerate(t or []):
            for b in (t or [])[i + 1: i + 1 + window]:
                if a in known and b in known:
                    n[a, b] += 1
                    n[b, a] += 1
    return n


def test_counts_and_pmi(spark):
    docs, df, vocab = corpus(spark)
    known = {f"w{j}" for j in range(10)}
    for window in (1, 5, 60):
        co = cooccur.cooccurrence(df, vocab, window)
        want = counted(docs, window, known)
        assert {(r.term, r.context): r.n for r in co.collect()} == dict(want)
    total, sums = sum(want.values()), Counter()
    for (a, _), n in want.items():
        sums[a] += n
    pmi = {p: math.log(n * total / (sums[p[0]] * sums[p[1]])) for p, n in want.items()}
    got = {(r.term, r.context): r.pmi for r in cooccur.positive_pmi(co).collect()}
    assert set(got) == {p for p, x in pmi.items() if x > 0}
    assert all(abs(got[p] - pmi[p]) < 1e-12 for p in got)


def test_vectors_factorise_the_matrix(spark):
    _, df, vocab = corpus(spark)
    pmi = cooccur.positive_pmi(cooccur.cooccurrence(df, vocab, 2)).checkpoint()
    m = np.zeros((10, 10))
    for r in pmi.collect():
        m[int(r.term[1:]), int(r.context[1:])] = r.pmi
    u, s, _ = np.linalg.svd(m)
    vec = np.zeros((10, 3))
    out = cooccur.term_vectors(pmi, vocab, 10, dimensions=3)
    for r in out.collect():
        vec[int(r.term[1:]), r.dim] = r.value
    assert np.allclose(vec @ vec.T, (u[:, :3] * s[:3]) @ u[:, :3].T, atol=1e-7)
    target = spark.createDataFrame([("w1",)], "target_word string")
    score = {r.term: r.score for r in related.term_similarity(out, target, vocab).collect()}
    assert abs(score["w1"] - 1) < 1e-9
    assert all(abs(score[f"w{j}"] - vec[j] @ vec[1] / np.linalg.norm(vec[j]) / np.linalg.norm(vec[1])) < 1e-9 for j in range(10))


def test_no_tokens(spark):
    _, df, vocab = corpus(spark)
    co = cooccur.cooccurrence(df.where("doc_num in (100, 101, 102)"), vocab)
    assert co.collect() == []
    pmi = cooccur.positive_pmi(co)
    assert pmi.collect() == [] and cooccur.term_vectors(pmi, vocab, 10).collect() == []


def test_pairs_are_summed_before_they_are_shuffled(spark, monkeypatch):
    _, df, vocab = corpus(spark)
    plan = cooccur.cooccurrence(df, vocab, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "arrays_zip" not in plan
    monkeypatch.setattr(cooccur, "PAIRS", 7)  # sums of few pairs at a time come to the same counts
    monkeypatch.setattr(cooccur, "DOCUMENTS", 3)
    few = spark.createDataFrame([(0, ["a", None, "b", "a", "x"]), (1, ["b", "a"])], "doc_num long, tokens array<string>")
    known = spark.createDataFrame([("a", 0), ("b", 1)], "term string, term_id long")
    got = {(r.term, r.context): r.n for r in cooccur.cooccurrence(few, known, 5).collect()}
    assert got == {("a", "b"): 3, ("b", "a"): 3, ("a", "a"): 2}
