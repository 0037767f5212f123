"""Clustering, encoding and scaling queries.

Nearest neighbours and the learned models use all coordinates of the
``embeddings`` vectors; the grid operators use their projection to a plane.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster, factor, features, linkage
from ..session import read_table
from .catalog import register
from .corpus import build_corpus, corpus_ctes, once_per_corpus

R = 6
EPS = 0.15
MIXED_EPS = 0.25
MIN_PTS = 5
K = 7


def points(spark, sf_dir):
    """``(id, x, y)``: all coordinates of the embeddings projected to a plane
    by fixed cosines and sines (any engine computes the same points)."""
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))

    def axis(wave):
        terms = F.transform("v", lambda x, i: x * wave((i + 1).cast("double")))
        return F.round(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), 9)

    return e.select(F.col("vec_id").alias("id"), axis(F.cos).alias("x"), axis(F.sin).alias("y"))


PTS_SQL = """pts AS (
  SELECT vec_id AS id, round(list_sum(list_transform(embedding, lambda v, i: v::DOUBLE * cos(i::DOUBLE))), 9) AS x,
         round(list_sum(list_transform(embedding, lambda v, i: v::DOUBLE * sin(i::DOUBLE))), 9) AS y
  FROM embeddings
)"""

KNN_SQL = f"""WITH vec AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
nn AS (
  SELECT a.id, b.id AS neighbor_id, list_distance(a.v, b.v) AS distance,
         row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rank
  FROM vec a, vec b QUALIFY rank <= {K}
)"""


def vectors(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))


@register("knn", KNN_SQL + "\nSELECT id, rank::BIGINT AS rank, neighbor_id, round(distance, 6) AS distance FROM nn")
def q_knn(spark, sf_dir):
    nn = cluster.knn_vectors(vectors(spark, sf_dir), K)
    return nn.select("id", F.col("rank").cast("bigint"), "neighbor_id", F.round("distance", R).alias("distance"))


@register(
    "k_distance",
    KNN_SQL
    + """
SELECT id, round(distance, 6) AS distance, (row_number() OVER (ORDER BY round(distance, 9), id) - 1)::BIGINT AS position
FROM nn WHERE rank = 2""",
)
def q_k_distance(spark, sf_dir):
    # rank 2 = nearest other point, the column the k-distance graph plots.
    nn = cluster.knn_vectors(vectors(spark, sf_dir), K).withColumn("distance", F.round("distance", 9))
    d = cluster.k_distance(nn, 2)
    return d.select("id", F.round("distance", R).alias("distance"), F.col("position").cast("bigint"))


@register(
    "dbscan",
    f"""WITH RECURSIVE {PTS_SQL},
nb AS (
  SELECT a.id, b.id AS nid FROM pts a JOIN pts b
    ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS}::DOUBLE * {EPS}::DOUBLE
),
core AS (SELECT id FROM nb GROUP BY id HAVING count(*) >= {MIN_PTS}),
cedge AS (SELECT id, nid FROM nb WHERE id IN (SELECT id FROM core) AND nid IN (SELECT id FROM core)),
reach(id, lab) AS (SELECT id, id FROM core UNION SELECT e.nid, r.lab FROM reach r JOIN cedge e ON e.id = r.id),
comp AS (SELECT id, min(lab) AS lab FROM reach GROUP BY id),
border AS (
  SELECT n.id, min(c.lab) AS lab FROM nb n JOIN comp c ON c.id = n.nid
  WHERE n.id NOT IN (SELECT id FROM core) GROUP BY n.id
),
lab AS (SELECT id, lab, true AS is_core FROM comp UNION ALL SELECT id, lab, false FROM border),
num AS (SELECT lab, dense_rank() OVER (ORDER BY lab) - 1 AS cluster FROM (SELECT DISTINCT lab FROM lab))
SELECT p.id, coalesce(num.cluster, -1)::BIGINT AS cluster, coalesce(l.is_core, false) AS is_core
FROM pts p LEFT JOIN lab l USING (id) LEFT JOIN num USING (lab)""",
)
def q_dbscan(spark, sf_dir):
    return cluster.dbscan(points(spark, sf_dir), EPS, MIN_PTS)


@register(
    "label_encode_standardize",
    """
WITH st AS (
  SELECT avg(p_size::DOUBLE) AS ms, stddev_pop(p_size::DOUBLE) AS ss,
         avg(p_retailprice) AS mr, stddev_pop(p_retailprice) AS sr FROM part
)
SELECT p_partkey,
       (dense_rank() OVER (ORDER BY p_brand) - 1)::BIGINT AS p_brand,
       (dense_rank() OVER (ORDER BY p_type) - 1)::BIGINT AS p_type,
       round(CASE WHEN ss > 0 THEN (p_size - ms) / ss ELSE 0.0 END, 6) AS p_size,
       round(CASE WHEN sr > 0 THEN (p_retailprice - mr) / sr ELSE 0.0 END, 6) AS p_retailprice
FROM part, st""",
)
def q_label_encode_standardize(spark, sf_dir):
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    enc = features.label_encode(p, ["p_brand", "p_type"])
    sc = features.standardize(enc, ["p_size", "p_retailprice"])
    return sc.select("p_partkey", "p_brand", "p_type", F.round("p_size", R).alias("p_size"),
                     F.round("p_retailprice", R).alias("p_retailprice"))


@register(
    "cluster_keywords",
    "WITH " + corpus_ctes(lang=None)
    + """,
sizes AS (SELECT lang AS cluster, count(*) AS size FROM corpus GROUP BY lang),
means AS (
  SELECT c.lang AS cluster, x.term, sum(x.value) / s.size AS mean
  FROM xtfidf x JOIN corpus c USING (doc_num) JOIN sizes s ON s.cluster = c.lang GROUP BY c.lang, x.term, s.size
)
SELECT cluster, term, round(mean, 6) AS mean,
       row_number() OVER (PARTITION BY cluster ORDER BY round(mean, 9) DESC, term)::BIGINT AS rank
FROM means QUALIFY rank <= 10""",
)
def q_cluster_keywords(spark, sf_dir):
    c = build_corpus(spark, sf_dir, lang=None)
    assign = c.docs.select("doc_num", F.col("lang").alias("cluster"))
    k = cluster.cluster_keywords(c.x_tfidf, assign, 10)
    return k.select("cluster", "term", F.round("mean", R).alias("mean"), "rank")


# ------------------------------------------------- learned (no SQL oracle)

def _vectors(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return cluster.with_vector(e.select(F.col("vec_id").alias("id"), "embedding"), "embedding")


@register("pca")
def q_pca(spark, sf_dir):
    proj, _ = cluster.pca(_vectors(spark, sf_dir), "id", k=2)
    return proj


@register("pca_variance")
def q_pca_variance(spark, sf_dir):
    _, explained = cluster.pca(_vectors(spark, sf_dir), "id", k=None, var_share=0.95)
    return explained


@register("kmeans_elbow")
def q_kmeans_elbow(spark, sf_dir):
    return cluster.kmeans_elbow(_vectors(spark, sf_dir), "features", range(2, 21, 2), seed=20)


@register("kmeans_assign")
def q_kmeans_assign(spark, sf_dir):
    return cluster.kmeans_assign(_vectors(spark, sf_dir), "id", "features", k=14, seed=20)


@register("hierarchy")
def q_hierarchy(spark, sf_dir):
    """Every vector's cluster with the cluster's size and centre."""
    assign, sizes = cluster.hierarchy(_vectors(spark, sf_dir), "id", "features", k=8)
    return assign.join(sizes, "cluster")


@register("project_sample")
def q_project_sample(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    proj, _ = cluster.pca(v, "id", k=2)
    labels = cluster.kmeans_assign(v, "id", "features", k=14, seed=20)
    return cluster.project_sample(proj, labels, "id", 300)


def _mixed_table(spark, sf_dir):
    """Documents with their labels, key and list columns dropped, every string
    column label-encoded (full texts included), all columns standardised.
    Documents with a null in any column (those without labels) are dropped
    first. Returns the table with its key, and the columns."""
    from ..operators import filters

    d = read_table(spark, sf_dir, "documents").join(read_table(spark, sf_dir, "labels"), "doc_id", "left")
    d = filters.drop_null_rows(d, d.columns)
    d = d.withColumn("text_list", F.split("text", " "))
    kept = filters.drop_columns(d, ["doc_id"], regex=r"[a-z_]*_list")
    key = d.select("doc_id", *kept.columns)
    strings = [f.name for f in kept.schema.fields if f.dataType.simpleString() == "string"]
    enc = features.label_encode(key, strings)
    cols = [c for c in kept.columns]
    return features.standardize(enc, cols), cols


def _mixed_projection(spark, sf_dir):
    """The mixed table on its two leading components, centred."""
    std, cols = _mixed_table(spark, sf_dir)
    vec = cluster.with_vector(std.select(F.col("doc_id").alias("id"), F.array(*[F.col(c) for c in cols]).alias("v")), "v")
    proj, _ = cluster.pca(vec, "id", k=2)
    return proj


@register("mixed_table_pca")
def q_mixed_table_pca(spark, sf_dir):
    return _mixed_projection(spark, sf_dir)


@register("mixed_table_dbscan")
def q_mixed_table_dbscan(spark, sf_dir):
    """DBSCAN on the mixed-table projection."""
    proj = _mixed_projection(spark, sf_dir).select("id", F.col("pc")[0].alias("x"), F.col("pc")[1].alias("y"))
    return cluster.dbscan(proj, MIXED_EPS, MIN_PTS)


@register("ward_merges")
def q_ward_merges(spark, sf_dir):
    """Ward's merges of the mixed table without its source and without its text."""
    std, cols = _mixed_table(spark, sf_dir)
    std = std.checkpoint(eager=True)
    parts = []
    for left_out in ("source", "text"):
        v = F.array(*[F.col(c).cast("double") for c in cols if c != left_out])
        cf = linkage.clustering_features(std.select(v.alias("v")))
        parts.append(cf.withColumn("subset", F.lit(f"without {left_out}")))
    return linkage.ward_merges(parts[0].unionByName(parts[1]))


# -------------------------------------------- the documents themselves (TF-IDF)

DOC_CLUSTERS = 14


@once_per_corpus
def document_rows(spark, sf_dir, c):
    """TF-IDF rows of the corpus as sparse vectors by term id, written once."""
    return factor.write_rows(factor.sparse_rows(c.x_tfidf, c.vocab, c.docs), features.FEATURE_CAP)


@once_per_corpus
def document_assignment(spark, sf_dir, c):
    """``(doc_num, cluster)``: k-means with 14 clusters on the TF-IDF rows, written
    once, so that keywords, projection and assignment speak of the same fit."""
    rows = document_rows(spark, sf_dir)
    return cluster.kmeans_assign(rows, "doc_num", "features", k=DOC_CLUSTERS, seed=20).checkpoint(eager=True)


@register("document_elbow")
def q_document_elbow(spark, sf_dir):
    return cluster.kmeans_elbow(document_rows(spark, sf_dir), "features", range(2, 21, 2), seed=20)


@register("document_clusters")
def q_document_clusters(spark, sf_dir):
    return document_assignment(spark, sf_dir)


@register("document_keywords")
def q_document_keywords(spark, sf_dir):
    """Top 10 terms of every k-means cluster of the documents, by mean TF-IDF."""
    k = cluster.cluster_keywords(build_corpus(spark, sf_dir).x_tfidf, document_assignment(spark, sf_dir), 10)
    return k.select("cluster", "term", F.round("mean", R).alias("mean"), "rank")


@register("document_components")
def q_document_components(spark, sf_dir):
    """Shares of the variance of the ten leading components of the TF-IDF rows."""
    found = factor.components(document_rows(spark, sf_dir), features.FEATURE_CAP, k=10)
    shares = [] if found is None else [float(s) for s in found.shares]
    rows = [(i, s, sum(shares[: i + 1])) for i, s in enumerate(shares)]
    return spark.createDataFrame(rows, "component long, variance_share double, cumulative double")


@register("document_projection")
def q_document_projection(spark, sf_dir):
    """300 documents on the two leading components, with their clusters."""
    rows = document_rows(spark, sf_dir)
    found = factor.components(rows, features.FEATURE_CAP, k=2)
    labels = document_assignment(spark, sf_dir)
    if found is None:
        return labels.select("doc_num", F.array().cast("array<double>").alias("pc"), "cluster")
    return cluster.project_sample(factor.project(rows, found), labels, "doc_num", 300)
