import numpy as np
import pytest
from pyspark.sql import functions as F

from textquarry.operators import factor


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(4)
    dense = rng.random((60, 25)) * (rng.random((60, 25)) < 0.3)
    dense[:, 3] *= 6
    dense[7] = 0  # a document without terms
    return dense


@pytest.fixture(scope="module")
def rows(spark, matrix):
    cells = [(i, f"t{j:02d}", float(v)) for (i, j), v in np.ndenumerate(matrix) if v]
    x = spark.createDataFrame(cells, "doc_num long, term string, value double").repartition(5)
    vocab = spark.createDataFrame([(f"t{j:02d}", j) for j in range(25)], "term string, term_id long")
    docs = spark.createDataFrame([(i,) for i in range(60)], "doc_num long")
    return factor.write_rows(factor.sparse_rows(x, vocab, docs), 25)


def test_sparse_rows_hold_the_matrix(rows, matrix):
    got = {r.doc_num: r for r in rows.collect()}
    assert sorted(got) == list(range(60))
    for i, r in got.items():
        assert np.array_equal(r.features.toArray(), matrix[i])
        assert r.ids == np.flatnonzero(matrix[i]).tolist()
        assert r.features.indices.tolist() == r.ids


def test_components_equal_a_dense_decomposition(rows, matrix):
    c = factor.components(rows, 25, k=3)
    centred = matrix - matrix.mean(axis=0)
    u, s, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(c.variances, s[:3] ** 2 / 59)
    assert np.allclose(c.shares, s[:3] ** 2 / (s**2).sum())
    assert np.allclose(np.abs((c.loadings * vt[:3].T).sum(axis=0)), 1)
    assert (c.loadings[np.abs(c.loadings).argmax(axis=0), range(3)] > 0).all()
    got = {r.doc_num: r.pc for r in factor.project(rows, c).collect()}
    assert np.allclose([got[i] for i in range(60)], centred @ c.loadings)


@pytest.mark.parametrize("share", [0.5, 0.95, 1.0])
def test_share_of_variance(rows, matrix, share, monkeypatch):
    monkeypatch.setattr(factor, "BLOCK", 4)
    monkeypatch.setattr(factor, "EXTRA", 3)
    c = factor.components(rows, 25, var_share=share)
    s = np.linalg.svd(matrix - matrix.mean(axis=0), compute_uv=False) ** 2
    need = int(np.argmax(np.cumsum(s) / s.sum() >= share - 1e-12)) + 1
    assert len(c.shares) == need
    assert np.allclose(c.shares, s[:need] / s.sum())
    assert np.allclose(c.loadings.T @ c.loadings, np.eye(need), atol=1e-9)


def test_no_rows_and_no_variance(spark, rows):
    assert factor.components(rows.limit(0), 25) is None
    flat = rows.where("doc_num = 3").union(rows.where("doc_num = 3"))
    c = factor.components(flat, 25)
    assert c.loadings.shape == (25, 0)
    assert factor.project(flat, c).select(F.size("pc")).distinct().collect()[0][0] == 0


def test_one_sum_a_pass_reaches_the_driver(spark, matrix, rows, monkeypatch):
    sizes, kind = [], type(rows)
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: sizes.append(got := collect(self)) or got)
    total = factor._summed(rows.repartition(20), 25, lambda d: d.sum(axis=0), 4)
    assert np.allclose(total, matrix.sum(axis=0)) and [len(s) for s in sizes] == [1]
