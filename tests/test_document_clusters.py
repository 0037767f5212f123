"""Clusters of the documents themselves: elbow, assignment, keywords, projection."""

import duckdb
import numpy as np
import pytest

from textquarry.plans.catalog import all_queries
from textquarry.plans.cluster_queries import DOC_CLUSTERS, document_rows
from textquarry.plans.corpus import build_corpus, corpus_ctes

SF = "/root/testdata/sf0.001"


def run(spark, name):
    return all_queries()[name].fn(spark, SF)


@pytest.fixture(scope="module")
def dense(spark):
    rows = {r.doc_num: r.features.toArray() for r in document_rows(spark, SF).collect()}
    return list(rows), np.stack(list(rows.values()))


def test_rows_are_the_tfidf_matrix(spark, dense):
    ids, x = dense
    assert sorted(ids) == sorted(r.doc_num for r in build_corpus(spark, SF).docs.select("doc_num").collect())
    assert np.allclose(np.linalg.norm(x, axis=1)[np.abs(x).sum(axis=1) > 0], 1)


def test_assignment_is_to_the_nearest_mean_and_elbow_falls(spark, dense):
    ids, x = dense
    got = {r.doc_num: r.cluster for r in run(spark, "document_clusters").collect()}
    assert set(got) == set(ids) and set(got.values()) <= set(range(DOC_CLUSTERS))
    label = np.array([got[i] for i in ids])
    centres = {c: x[label == c].mean(axis=0) for c in set(label.tolist())}
    near = [min(centres, key=lambda c: ((v - centres[c]) ** 2).sum()) for v in x]
    assert np.mean(label == near) > 0.95
    sse = [r.sse for r in run(spark, "document_elbow").orderBy("k").collect()]
    assert len(sse) == 10 and sse[-1] < sse[0]
    inside = sum(((x[label == c] - m) ** 2).sum() for c, m in centres.items())
    assert inside <= sse[0]


def test_keywords_equal_sql_over_the_written_assignment(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    con.register("assign", run(spark, "document_clusters").toPandas())
    want = con.execute("WITH " + corpus_ctes() + """,
        sizes AS (SELECT cluster, count(*) AS size FROM assign GROUP BY cluster),
        means AS (SELECT cluster, term, sum(value) / any_value(size) AS mean
                  FROM xtfidf JOIN assign USING (doc_num) JOIN sizes USING (cluster) GROUP BY ALL)
        SELECT cluster, term, round(mean, 6), row_number() OVER (PARTITION BY cluster ORDER BY round(mean, 9) DESC, term) AS rank
        FROM means QUALIFY rank <= 10""").fetchall()
    got = [(r.cluster, r.term, r["mean"], r["rank"]) for r in run(spark, "document_keywords").collect()]
    assert [(c, t, round(m, 5), k) for c, t, m, k in sorted(got)] == [(c, t, round(m, 5), k) for c, t, m, k in sorted(want)]


def test_projection_equals_a_dense_decomposition(spark, dense):
    ids, x = dense
    centred = x - x.mean(axis=0)
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    shares = run(spark, "document_components").orderBy("component").collect()
    assert np.allclose([r.variance_share for r in shares], (s**2 / (s**2).sum())[:10])
    pc = {r.doc_num: r for r in run(spark, "document_projection").collect()}
    assert len(pc) == min(300, len(ids))
    got = np.array([pc[i].pc for i in ids if i in pc])
    want = (u * s)[[k for k, i in enumerate(ids) if i in pc], :2]
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)
    label = {r.doc_num: r.cluster for r in run(spark, "document_clusters").collect()}
    assert all(r.cluster == label[i] for i, r in pc.items())
