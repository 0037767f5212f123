import numpy as np
from pyspark.sql import functions as F

from textquarry.operators import linkage


def frame(spark, points):
    return spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(points)], "id long, v array<double>").repartition(4)


def brute(points):
    """Heights and sizes by merging the pair whose union adds least scatter, each time among all pairs."""
    clusters = [[p] for p in points]

    def scatter(c):
        m = np.mean(c, axis=0)
        return ((np.array(c) - m) ** 2).sum()

    out = []
    means, n = np.array(points, dtype=float), np.ones(len(points))
    live = list(range(len(points)))
    while len(live) > 1:
        m, k = means[live], n[live]
        add = k[:, None] * k / (k[:, None] + k) * ((m[:, None] - m) ** 2).sum(axis=2)
        np.fill_diagonal(add, np.inf)
        i, j = np.unravel_index(add.argmin(), add.shape)
        a, b = live[min(i, j)], live[max(i, j)]
        clusters[a] += clusters[b]
        means[a], n[a] = np.mean(clusters[a], axis=0), len(clusters[a])
        live.remove(b)
        out.append((np.sqrt(2 * add[i, j]), int(n[a]), scatter(clusters[a])))
    return out


def test_heights_equal_brute_force_on_300_points(spark):
    rng = np.random.default_rng(8)
    points = np.concatenate([rng.normal(c, 0.7, (100, 3)) for c in (0, 4, 9)])
    cf = linkage.clustering_features(frame(spark, points)).withColumn("subset", F.lit("a"))
    rows = linkage.ward_merges(cf).orderBy("step").collect()
    want = brute(points)
    assert len(rows) == 299
    assert np.allclose([r.height for r in rows], sorted(h for h, *_ in want))
    assert sorted(r["size"] for r in rows) == sorted(s for _, s, _ in want)
    assert np.allclose(sorted(r.scatter for r in rows), sorted(x for *_, x in want), atol=1e-8)
    made = [r.left for r in rows] + [r.right for r in rows]
    assert sorted(made) == list(range(598)) and all(max(r.left, r.right) < 300 + r.step for r in rows)


def test_many_points_are_summarised_by_mergeable_features(spark):
    rng = np.random.default_rng(9)
    points = np.concatenate([rng.normal(c, 0.5, (400, 2)) for c in (0, 20)] + [np.tile([50.0, 0.0], (200, 1))])
    cf = linkage.clustering_features(frame(spark, points), limit=40)
    rows = cf.collect()
    assert 3 <= len(rows) <= 40 and sum(r.n for r in rows) == 1000
    assert np.allclose(np.sum([r.s for r in rows], axis=0), points.sum(axis=0))
    assert np.isclose(sum(r.q for r in rows), (points**2).sum())
    top = linkage.ward_merges(cf.withColumn("subset", F.lit("a"))).orderBy(F.desc("step")).limit(2).collect()
    assert top[0]["size"] == 1000 and top[1]["size"] in (800, 600)
    assert np.isclose(top[0].scatter, ((points - points.mean(axis=0)) ** 2).sum())


def test_equal_points_and_tiny_tables(spark):
    cf = linkage.clustering_features(frame(spark, [[1.0, 2.0]] * 5)).withColumn("subset", F.lit("a"))
    assert [(r.node, r.n, r.s, r.q) for r in cf.collect()] == [(0, 5, [5.0, 10.0], 25.0)]
    assert linkage.ward_merges(cf).collect() == []
    none = linkage.clustering_features(frame(spark, [[1.0]]).limit(0)).withColumn("subset", F.lit("a"))
    assert linkage.ward_merges(none).collect() == []
    two = spark.createDataFrame([(1, [0.0]), (2, None), (3, [3.0]), (4, [3.0])], "id long, v array<double>")
    got = linkage.ward_merges(linkage.clustering_features(two).withColumn("subset", F.lit("a"))).collect()
    assert len(got) == 1 and got[0]["size"] == 3 and np.isclose(got[0].height, 3 * np.sqrt(2 * 1 * 2 / 3))
