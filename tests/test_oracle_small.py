"""Every registered query with an oracle agrees with DuckDB at sf0.001."""

import os

import duckdb
import pytest

from textquarry.plans.catalog import all_queries
from textquarry.session import TABLES

SF = "/root/testdata/sf0.001"
FAST = [
    "word_count_stop", "top_words_raw", "text_columns_union", "summary_or_body", "parse_pub_date",
    "year_histogram", "label_target", "first_match_join", "tokenize", "singularize",
    "tfidf_matrix", "doc_similarity_count", "minhash_similarity", "simhash_sha1",
    "related_documents", "label_documents", "frequent_itemsets", "apriori", "association_rules",
    "knn", "dbscan", "label_encode_standardize", "cluster_keywords", "identify_language",
]


def norm(v):
    if isinstance(v, float):
        return round(v, 5)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    q = all_queries()[name]
    df = q.fn(spark, SF)
    s = [tuple(r) for r in df.collect()]
    res = con.execute(q.oracle)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows(df.columns, s) == rows(dcols, res.fetchall())


def test_registry_shapes():
    import __spark_entry__ as e

    qs, orc = e.queries(), e.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 60
