import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from textquarry.operators import minhash, similarity, simhash

# 5 documents x 6 terms: doc 1 equals doc 0, doc 2 is disjoint from doc 0,
# doc 3 holds no vocabulary term, doc 4 has tied counts.
DENSE = np.array([
    [2, 1, 0, 0, 3, 0],
    [2, 1, 0, 0, 3, 0],
    [0, 0, 4, 1, 0, 0],
    [0, 0, 0, 0, 0, 0],
    [1, 1, 1, 1, 1, 1],
], dtype=float)
TERMS = ["t0", "t1", "t2", "t3", "t4", "t5"]


def long_matrix(spark, m):
    rows = [(d, TERMS[t], float(m[d, t])) for d in range(m.shape[0]) for t in range(m.shape[1]) if m[d, t] != 0]
    x = spark.createDataFrame(rows, "doc_num long, term string, value double")
    docs = spark.createDataFrame([(d,) for d in range(m.shape[0])], "doc_num long")
    return x, docs


def test_document_similarity_against_numpy(spark):
    x, docs = long_matrix(spark, DENSE)
    got = {r.doc_num: r for r in similarity.document_similarity(x, docs, 0).collect()}
    t = DENSE[0]
    for d in range(5):
        v = DENSE[d]
        assert abs(got[d].doc_l1_norm - np.abs(v - t).sum()) < 1e-9
        assert abs(got[d].doc_l2_norm - np.linalg.norm(v - t)) < 1e-9
        nv = np.linalg.norm(v)
        cos = 0.0 if nv == 0 else v @ t / (nv * np.linalg.norm(t))
        assert abs(got[d].doc_cosine_similarity - cos) < 1e-9


def test_minhash_empty_doc_and_self(spark):
    x, docs = long_matrix(spark, np.clip(DENSE, 0, 1))
    vocab = spark.createDataFrame([(t,) for t in TERMS], "term string")
    ranks = minhash.rank_arrays(minhash.permutations(vocab, 20))
    perms = minhash.permutations(vocab, 20).collect()
    # every permutation is a bijection onto 1..N
    for p in range(20):
        assert sorted(r["rank"] for r in perms if r.perm == p) == list(range(1, 7))
    sig = {r.doc_num: list(r.sig) for r in minhash.minhash_signature(x, docs, ranks, 20).collect()}
    assert sig[3] == [1] * 20
    assert sig[0] == sig[1]
    sim = {r.doc_num: r for r in minhash.minhash_similarity(
        minhash.minhash_signature(x, docs, ranks, 20), x, docs, 0).collect()}
    assert sim[1].sig_jaccard_similarity == 1.0 and sim[1].doc_jaccard_similarity == 1.0
    assert sim[2].doc_jaccard_similarity == 0.0


def python_bits(term, hashing):
    if hashing == "md5":
        v = int.from_bytes(hashlib.md5(term.encode()).digest(), byteorder="little")
        width = 128
    else:
        v = int(hashlib.sha1(term.encode()).hexdigest(), 16)
        width = 160
    return [int(c) for c in f"{v:0b}".zfill(width)]


def test_hash_bits_match_hashlib(spark):
    words = ["virus", "cell", "alpha", "zeta", "x"]
    df = spark.createDataFrame([(w,) for w in words], "term string")
    for h in ("md5", "sha1"):
        got = {r.term: list(r.b) for r in df.select("term", simhash.hash_bits(F.col("term"), h).alias("b")).collect()}
        for w in words:
            assert got[w] == python_bits(w, h)


def test_simhash_alternating_for_empty(spark):
    x, docs = long_matrix(spark, DENSE)
    vocab = spark.createDataFrame([(t,) for t in TERMS], "term string")
    fp = {r.doc_num: list(r.fp) for r in simhash.simhash(x, docs, vocab, "md5").collect()}
    assert fp[3] == [i % 2 for i in range(128)]
    ham = {r.doc_num: r.sig_hamming_distance for r in simhash.hamming_to_target(
        simhash.simhash(x, docs, vocab, "md5"), 0).collect()}
    assert ham[0] == 0 and ham[1] == 0


def test_hash_name_checked():
    import pytest

    with pytest.raises(ValueError):
        simhash.check_hash("sha256")


def t_pvalue(r: float | None, n: int) -> float | None:
    """Two-sided p-value of a Pearson correlation (t test, n-2 degrees).

    With t = sqrt(d) tan(a) the tail of Student's t is the integral of
    cos(x)**(d-1) from a to pi/2, times a constant. It is taken by
    Gauss-Legendre quadrature, over the stretch where the integrand is not
    negligible, with twice the nodes until the value stands.
    """
    if r is None or n < 3 or math.isnan(r):
        return None
    if abs(r) >= 1.0:
        return 0.0
    d = n - 2
    start = math.atan(abs(r) / math.sqrt(1.0 - r * r))
    # the integrand falls at least like exp(-(d-1) x**2 / 2) and exp(-(d-1) tan(start) x)
    power = max(d - 1, 1)
    end = min(math.pi / 2, start + min(12.0 / math.sqrt(power), 60.0 / (power * max(math.tan(start), 1e-12))))
    if d < 1_000_000:
        constant = math.lgamma((d + 1) / 2) - math.lgamma(d / 2)
    else:  # the difference of two large numbers, by its series
        constant = 0.5 * math.log(d / 2) - 1 / (4 * d)
    constant += (d - 1) * math.log(math.cos(start)) - 0.5 * math.log(math.pi)
    before, nodes = None, 32
    while True:
        x, w = np.polynomial.legendre.leggauss(nodes)
        step = (x + 1) * (end - start) / 2
        # cos(start + step) / cos(start) - 1, without cancellation
        fall = -2 * np.sin(start + step / 2) * np.sin(step / 2) / math.cos(start)
        height = np.exp((d - 1) * np.log1p(fall))
        value = float(w @ height) * (end - start) / 2
        if before is not None and abs(value - before) <= 1e-11 * value:
            return min(1.0, 2.0 * math.exp(constant) * value)
        if nodes > 1024:
            raise ArithmeticError(f"p-value of r={r}, n={n} did not settle")
        before, nodes = value, 2 * nodes


def test_pvalue_known_values():
    # r = 0.5, n = 10: t = 1.633, two-sided p = 0.1411
    assert abs(t_pvalue(0.5, 10) - 0.14111) < 1e-4
    assert t_pvalue(None, 10) is None
    assert t_pvalue(1.0, 10) == 0.0
    assert abs(t_pvalue(0.0, 50) - 1.0) < 1e-12
    # one and two degrees have closed forms
    assert abs(t_pvalue(0.6, 3) - (1 - 2 / np.pi * np.arcsin(0.6))) < 1e-12
    assert abs(t_pvalue(-0.3, 4) - 0.7) < 1e-12
    # many degrees: the normal limit
    import math

    for n in (10**4, 10**9):
        z = 2.0
        r = z / math.sqrt(n - 2 + z * z)
        assert abs(t_pvalue(r, n) - math.erfc(z / math.sqrt(2))) < 5e-5


def test_choose_hash():
    assert simhash.choose_hash(0.1, 0.2) == "md5"
    assert simhash.choose_hash(0.2, 0.2) == "sha1"
    assert simhash.choose_hash(None, 0.2) == "sha1"


def test_pvalue_columns_against_quadrature(spark):
    cases = [(r, n) for r in (0.0, 1e-6, -0.01, 0.05, 0.3, -0.6, 0.9, 0.999, 1 - 1e-9) for n in (3, 4, 5, 10, 57, 620, 100_000)]
    df = spark.createDataFrame([*cases, (1.0, 9), (-1.0, 9), (None, 9), (0.5, 2)], "correlation double, n long")
    got = {(x.correlation, x.n): x for x in similarity.with_pvalue(df).collect()}
    for r, n in cases:
        want, x = t_pvalue(r, n), got[r, n]
        assert abs(x.pvalue - want) <= 1e-9 * want + 1e-300
        if want > 1e-290:
            assert abs(x.log10_pvalue - math.log10(want)) < 1e-8
    assert got[1.0, 9].pvalue == got[-1.0, 9].pvalue == 0.0
    assert got[None, 9].pvalue is None and got[0.5, 2].pvalue is None
    small = spark.createDataFrame([(0.99, 100_000)], "correlation double, n long")
    assert similarity.with_pvalue(small).first().log10_pvalue < -80_000


def test_minhash_sweep_of_many_documents(spark):
    """Signatures by plain minima over more documents than a block holds, some
    without a known term; the sweep's measures with and without given exact ones."""
    rng = np.random.default_rng(4)
    dense = (rng.random((150, 6)) < 0.4).astype(float)
    dense[[3, 64, 149]] = 0
    x, docs = long_matrix(spark, dense)
    vocab = spark.createDataFrame([(t,) for t in TERMS[:5]], "term string")  # one term is in no permutation
    perms = {(r.term, r.perm): r["rank"] for r in minhash.permutations(vocab, 8).collect()}
    want = {}
    for d in range(150):
        held = [t for t, v in zip(TERMS[:5], dense[d]) if v]
        want[d] = [min(perms[t, p] for t in held) if held else 1 for p in range(8)]
    ranks = minhash.rank_arrays(minhash.permutations(vocab, 8))
    one = docs.coalesce(1)
    for table_bytes in (1 << 20, 0):
        got = {r.doc_num: list(r.sig) for r in minhash.minhash_signature(
            x.coalesce(1), one, ranks, 8, table_bytes=table_bytes).collect()}
        assert got == want
    exact = similarity.document_similarity(x, docs, 0, jaccard=True)
    given = minhash.minhash_sweep(x, docs, vocab, 0, (4, 8), exact=exact).collect()
    alone = minhash.minhash_sweep(x, docs, vocab, 0, (4, 8)).collect()
    assert len(given) == len(alone) == 300
    key = lambda r: (r.doc_num, r.num_perm, r.sig_cosine_similarity, r.sig_jaccard_similarity, r.doc_jaccard_similarity)
    assert sorted(map(key, given)) == sorted(map(key, alone))
    for r in given:
        a, b = set(want[r.doc_num][: r.num_perm]), set(want[0][: r.num_perm])
        assert abs(r.sig_jaccard_similarity - len(a & b) / len(a | b)) < 1e-12
        union = np.maximum(dense[r.doc_num], dense[0]).sum()
        assert abs(r.doc_jaccard_similarity - np.minimum(dense[r.doc_num], dense[0]).sum() / union) < 1e-12


def test_simhash_of_many_documents(spark):
    """Bits by plain sums over more documents than a block holds, some without a term."""
    rng = np.random.default_rng(6)
    dense = np.where(rng.random((150, 6)) < 0.5, rng.random((150, 6)), 0.0)
    dense[[0, 70, 149]] = 0
    x, docs = long_matrix(spark, dense)
    vocab = spark.createDataFrame([(t,) for t in TERMS[:5]], "term string")  # one term doesn't count
    for h in ("md5", "sha1"):
        signs = np.array([np.array(python_bits(t, h)) * 2 - 1 for t in TERMS[:5]])
        sums = dense[:, :5] @ signs
        want = np.where(sums > 1e-9, 1, np.where(sums < -1e-9, 0, np.arange(signs.shape[1]) % 2))
        got = {r.doc_num: list(r.fp) for r in simhash.simhash(x.coalesce(1), docs, vocab, h).collect()}
        assert got == {d: list(want[d]) for d in range(150)}


def test_sweep_measures_are_those_of_the_columns(spark):
    from pyspark.sql import functions as F

    from textquarry.operators import minhash

    rows = [(n, [(n * 7 + i * (n % 3 + 1)) % 11 + 1 for i in range(8)]) for n in range(30)]
    sig = spark.createDataFrame(rows, "doc_num long, sig array<int>")
    tsig = rows[4][1]
    for estimator in ("set", "positional"):
        got = sig.mapInArrow(minhash._measured(tsig, (3, 8), estimator),
                             "doc_num long, cosine array<double>, jaccard array<double>").collect()
        for i, n in enumerate((3, 8)):
            cos, jac = minhash.signature_measures(F.slice("sig", 1, n), tsig[:n], estimator)
            want = {r.doc_num: (r.c, r.j) for r in sig.select("doc_num", cos.alias("c"), jac.alias("j")).collect()}
            assert all(abs(r.cosine[i] - want[r.doc_num][0]) < 1e-12 and abs(r.jaccard[i] - want[r.doc_num][1]) < 1e-12
                       for r in got) and len(got) == 30
