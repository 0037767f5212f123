"""Hierarchical clustering (Ward) over clustering features.

Points are summarised where they are, as clustering features (count, sum, square
sum), which add up: a feature of every distinct point while these are few,
else of the cells of a k-means partition. Only the features, at most
``limit`` of them, are linked: nearest-neighbour chains merge them into a table
of steps like that of a dendrogram. Equal points are one feature.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LIMIT = 1024
SEED = 42

MERGES = "subset string, step long, left long, right long, height double, size long, scatter double"


def clustering_features(points: DataFrame, vector: str = "v", limit: int = LIMIT, seed: int = SEED) -> DataFrame:
    """``(node, n, s, q)``: at most ``limit`` features of the vectors (arrays of
    doubles of one length): how many, their sum, their sum of squares.

    Nodes are numbered from 0. Null vectors are left out. Sums are partial
    aggregates, so a cell that holds most points is a few rows a task.
    """
    pts = points.where(F.col(vector).isNotNull()).groupBy(F.col(vector).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    pts = pts.checkpoint(eager=True)
    distinct, size = pts.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if distinct > limit:
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        vec = pts.withColumn("features", array_to_vector("v")).withColumn("n", F.col("n").cast("double"))
        fit = KMeans(k=limit, seed=seed, maxIter=5, weightCol="n", predictionCol="cell").fit(vec)
        cells = fit.transform(vec).select("v", F.col("n").cast("bigint").alias("n"), "cell")
    else:
        cells = pts.withColumn("cell", F.col("v"))
    sums = [F.sum(F.col("n") * F.col("v")[i]).alias(f"s{i}") for i in range(size or 0)]
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    features = cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum(F.col("n") * square).alias("q"), *sums)
    s = F.array(*[F.col(f"s{i}") for i in range(size or 0)]).cast("array<double>")
    # at most ``limit`` rows are numbered
    order = F.row_number().over(Window.orderBy(s))
    return features.select((order - 1).cast("long").alias("node"), "n", s.alias("s"), "q")


def _chain(n: np.ndarray, mean: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges (a, b, height) by nearest-neighbour chains; b lives on in a."""
    n, mean, live, out, chain = n.astype(float), mean.copy(), np.ones(len(n), dtype=bool), [], []
    for _ in range(len(n) - 1):
        if not chain:
            chain = [int(np.flatnonzero(live)[0])]
        while True:
            a = chain[-1]
            d = 2 * n[a] * n / (n[a] + n) * ((mean - mean[a]) ** 2).sum(axis=1)
            d[~live] = np.inf
            d[a] = np.inf
            b = int(d.argmin())
            if len(chain) > 1 and d[chain[-2]] <= d[b]:
                b = chain[-2]
                break
            chain.append(b)
        chain = chain[:-2]
        out.append((a, b, float(np.sqrt(d[b]))))
        mean[a] = (n[a] * mean[a] + n[b] * mean[b]) / (n[a] + n[b])
        n[a] += n[b]
        live[b] = False
    return out


def _linked(f: pd.DataFrame) -> pd.DataFrame:
    f = f.sort_values("node").reset_index(drop=True)
    n, s, q = f["n"].to_numpy(), np.stack(f["s"]).astype(float), f["q"].to_numpy(float)
    group = {i: (i, int(n[i]), s[i], q[i]) for i in range(len(n))}  # root of each feature: node, count, sum, squares
    parent, rows = list(range(len(n))), []

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    steps = sorted(_chain(n, s / n[:, None]), key=lambda m: m[2])  # a chain finds them in another order
    for step, (a, b, height) in enumerate(steps):
        a, b = root(a), root(b)
        (x, na, sa, qa), (y, nb, sb, qb) = group[a], group[b]
        size, total, squares = na + nb, sa + sb, qa + qb
        parent[b] = a
        group[a] = (len(n) + step, size, total, squares)
        rows.append((f["subset"].iloc[0], step, min(x, y), max(x, y), height, size,
                     max(0.0, squares - float(total @ total) / size)))
    return pd.DataFrame(rows, columns=["subset", "step", "left", "right", "height", "size", "scatter"])


def ward_merges(features: DataFrame) -> DataFrame:
    """The merges of each subset of features (``subset, node, n, s, q``), lowest
    first: step, left and right (nodes; step t makes node ``features + t``),
    height (the Euclidean distance that Ward's method gives), size (points), scatter
    (sum of squares about the mean of the merged points).

    A subset has at most ``LIMIT`` features, which one task links.
    """
    return features.groupBy("subset").applyInPandas(_linked, MERGES)
