import numpy as np
import pytest

from textquarry.llm import whitening
from textquarry.llm.queries import op11_whitening

SMALL = "/root/testdata/sf0.001"

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"]


def definition(vectors: dict, k: int = 8):
    """Deviations, eigenvalue parts and whitened values by numpy's dense solver."""
    ids = list(vectors)
    x = np.array([[int(np.floor(1024.0 * float(c))) + 100000 for c in vectors[i]] for i in ids], dtype=object)
    n, s = len(ids), x.sum(axis=0)
    dev = {i: int(sum((n * a - b) ** 2 for a, b in zip(row, s))) for i, row in zip(ids, x)}
    c = np.array([[float(a - b // n) - float(b % n) / n for a, b in zip(row, s)] for row in x])
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, dev, e / np.trace(c.T @ c / n), {i: w for i, w in zip(ids, c @ u / np.sqrt(np.maximum(e, 1e-300)))}


def check(rows, vectors, k=8, close=1e-9):
    n, dev, explained, white = definition(vectors, k)
    got = {(r.vec_id, r.component): r for r in rows}
    parts = sorted({r.component for r in rows})
    assert len(got) == len(rows) == len(vectors) * len(parts) and parts == list(range(1, len(parts) + 1))
    for c in parts:
        sign = np.sign(sum(got[i, c].whitened * white[i][c - 1] for i in vectors))
        for i in vectors:
            r = got[i, c]
            assert (r.n, r.deviation) == (n, dev[i] if dev[i] < 2**63 else None)
            assert abs(sign * r.whitened - white[i][c - 1]) < close
            assert abs(r.explained / explained[c - 1] - 1) < 1e-10
            assert r.identity_error <= 1e-9
    return parts


def frame(spark, rows, schema="vec_id long, embedding array<double>"):
    return spark.createDataFrame(rows, schema)


def test_query_against_dense_solver(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    df = op11_whitening(spark, SMALL)
    assert df.columns == COLUMNS
    assert len(check(df.collect(), vectors)) == 8


def test_widens_to_the_space_where_eigenvalues_crowd():
    rng = np.random.default_rng(5)
    u = np.linalg.qr(rng.standard_normal((60, 60)))[0]
    e = np.concatenate([[50.0], 1.0 + 1e-7 * np.arange(59)[::-1]])
    v = (u * e) @ u.T
    got, q, residual = whitening.leading(lambda x: v @ x, 60, 8, extra=4)
    assert np.allclose(got, e[:8], rtol=1e-13) and residual.max() < 1e-12
    assert np.abs(q.T @ q - np.eye(8)).max() < 1e-13


@pytest.mark.parametrize("spectrum", [np.geomspace(1e9, 1.0, 50), 1.0 + np.arange(50)[::-1] / 10.0])
def test_leading_pairs(spectrum):
    rng = np.random.default_rng(7)
    u = np.linalg.qr(rng.standard_normal((50, 50)))[0]
    v = (u * spectrum) @ u.T
    e, q, residual = whitening.leading(lambda x: v @ x, 50, 8)
    assert np.allclose(e, spectrum[:8], rtol=1e-7) and residual.max() <= 1e-11 * spectrum[0]
    assert np.abs(np.abs((q * u[:, :8]).sum(axis=0)) - 1).max() < 1e-7


def test_drops_and_odd_rows(spark):
    good = {1: [0.1, 2.0, -1.0], 2: [0.5, 0.5, 0.25], 3: [-3.0, 0.0, 1.0], 4: [0.0, 1.5, 2.5], 5: [1e-4, -1e-4, 0.3]}
    bad = [(6, None), (7, [1.0, None, 2.0]), (8, [float("nan"), 0.0, 0.0]), (9, [float("inf"), 0.0, 0.0]),
           (10, []), (11, [1.0]), (12, [1.0, 2.0, 3.0, 4.0])]
    df = frame(spark, [(i, v, "x") for i, v in [*good.items(), *bad]], "vec_id long, embedding array<double>, n string")
    assert check(whitening.whiten(df).collect(), good) == [1, 2, 3]


def test_repeated_rows_null_ids_and_flat_tables(spark):
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 2.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 8 and {r.n for r in got} == {4} and sum(r.vec_id is None for r in got) == 4
    assert whitening.whiten(frame(spark, [(1, [0.5, 0.5])])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [0.5]), (2, [0.5])])).collect() == []
    assert whitening.whiten(frame(spark, [])).collect() == []
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).collect()
    assert {r.component for r in line} == {1}


def test_deviations_beyond_a_long_are_exact_or_null(spark):
    for size in (2**15, 2**17, 2**20):
        v = {i: [float(size * i), -float(size * i * i)] for i in range(4)}
        check(whitening.whiten(frame(spark, list(v.items()))).collect(), v, close=1e-6)
    huge = {1: [1e30, 0.0], 2: [-1e30, 1.0], 3: [0.0, 2.0]}
    got = whitening.whiten(frame(spark, list(huge.items()))).collect()
    assert got and {r.deviation for r in got if r.vec_id < 3} == {None}
