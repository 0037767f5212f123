"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion through Spark's ``noop`` sink (every row is
produced, nothing is collected) after one warm-up query. The corpus term
tables (tokenised English corpus and the all-language one) are built once,
timed as ``corpus_build``, and reused by the corpus queries. Prints one JSON
line with per-query seconds and their sum.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "word_count_stop",
    "top_words_stop",
    "text_columns_union",
    "first_match_join",
    "tokenize",
    "tfidf_matrix",
    "doc_similarity_tfidf",
    "minhash_sweep",
    "simhash_md5",
    "rank_table",
    "related_documents",
    "label_documents",
    "frequent_itemsets",
    "association_rules",
    "knn",
    "dbscan",
    "cluster_keywords",
    "identify_language",
    "apriori",
    "mixed_table_pca",
    "kmeans_assign",
    "embed_documents",
    "fit_topics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from textquarry.plans.catalog import all_queries
    from textquarry.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="textquarry-bench")
    qs = all_queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    qs["word_count_raw"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    # The corpus term tables are materialised once and shared by the corpus
    # queries; their build is timed as its own entry so the total includes it.
    from textquarry.plans.corpus import build_corpus

    t0 = time.time()
    build_corpus(spark, sf_dir)
    build_corpus(spark, sf_dir, lang=None)
    times["corpus_build"] = round(time.time() - t0, 3)
    for name in names:
        t0 = time.time()
        qs[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
