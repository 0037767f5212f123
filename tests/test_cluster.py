import random

import numpy as np

from textquarry.operators import cluster


def pts(spark, rows):
    return spark.createDataFrame(rows, "id long, x double, y double")


def brute_knn(rows, k):
    out = {}
    for i, x, y in rows:
        d = sorted(((x - a) ** 2 + (y - b) ** 2, j) for j, a, b in rows)
        out[i] = [j for _, j in d[:k]]
    return out


def test_knn_exact_against_brute_force(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.gauss(0, 1) if i % 3 else rnd.gauss(5, 0.05), rnd.gauss(0, 1)) for i in range(300)]
    got = {}
    for r in cluster.knn(pts(spark, rows), 5).collect():
        got.setdefault(r.id, {})[r["rank"]] = r.neighbor_id
    want = brute_knn(rows, 5)
    for i in want:
        assert [got[i][k] for k in range(1, 6)] == want[i]


def test_dbscan_groups_border_noise(spark):
    rows = []
    for i in range(6):
        rows.append((i, 0.0 + 0.01 * i, 0.0))          # dense group A
        rows.append((10 + i, 1.0 + 0.01 * i, 0.0))     # dense group B
    rows.append((20, 0.08, 0.0))                        # border of A: fewer than 5 neighbours
    rows.append((30, 5.0, 5.0))                         # noise
    out = {r.id: (r.cluster, r.is_core) for r in cluster.dbscan(pts(spark, rows), 0.05, 5).collect()}
    assert {out[i][0] for i in range(6)} == {0}
    assert {out[10 + i][0] for i in range(6)} == {1}
    assert out[20] == (0, False)
    assert out[30] == (-1, False)


def test_pca_invariants(spark):
    rnd = np.random.default_rng(0)
    data = rnd.normal(size=(200, 5)) @ np.diag([5, 3, 1, 0.5, 0.1])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(data)], "id long, e array<double>")
    v = cluster.with_vector(df, "e")
    proj, explained = cluster.pca(v, "id", k=2)
    shares = [r.variance_share for r in explained.orderBy("component").collect()]
    assert shares[0] >= shares[1] and sum(shares) <= 1.0 + 1e-9
    coords = np.array([r.pc for r in proj.orderBy("id").collect()])
    assert abs(coords.mean(axis=0)).max() < 1e-6          # centred
    _, ex95 = cluster.pca(v, "id", k=None, var_share=0.95)
    assert ex95.orderBy("component").collect()[-1].cumulative >= 0.95


def test_kmeans_assigns_nearest_centre(spark):
    rows = [(i, [float(i % 2) * 10 + 0.01 * i, 0.0]) for i in range(40)]
    df = cluster.with_vector(spark.createDataFrame(rows, "id long, e array<double>"), "e")
    a = {r.id: r.cluster for r in cluster.kmeans_assign(df, "id", k=2, seed=1).collect()}
    assert len({a[i] for i in range(0, 40, 2)}) == 1 and len({a[i] for i in range(1, 40, 2)}) == 1
    assert a[0] != a[1]


def test_dbscan_hot_cell_of_duplicates(spark):
    # A third of the points share one location: that cell is all core and is
    # never expanded into pairs.
    rows = [(i, 0.5, 0.5) for i in range(1500)]
    rows += [(2000 + i, 3.0 + 0.001 * i, 3.0) for i in range(3000)]
    rows += [(9000, 10.0, 10.0)]
    out = {r.id: (r.cluster, r.is_core) for r in cluster.dbscan(pts(spark, rows), 0.01, 5).collect()}
    assert {out[i] for i in range(1500)} == {(0, True)}
    assert {out[2000 + i][0] for i in range(3000)} == {1}
    assert out[9000] == (-1, False)


def test_knn_with_duplicate_hot_spot(spark):
    rnd = random.Random(3)
    rows = [(i, 1.0, 1.0) for i in range(400)]                       # one hot location
    rows += [(1000 + i, rnd.random() * 4, rnd.random() * 4) for i in range(200)]
    rows += [(5000 + i, 2.0, 2.0) for i in range(3)]                  # a small duplicate group
    got = {}
    for r in cluster.knn(pts(spark, rows), 6).collect():
        got.setdefault(r.id, {})[r["rank"]] = r.neighbor_id
    want = brute_knn(rows, 6)
    for i in want:
        assert [got[i][k] for k in range(1, 7)] == want[i]


def test_knn_dense_region_of_distinct_points(spark):
    rnd = random.Random(9)
    rows = [(i, 0.5 + rnd.random() * 1e-3, 0.5 + rnd.random() * 1e-3) for i in range(600)]  # hot region
    rows += [(1000 + i, rnd.random() * 10, rnd.random() * 10) for i in range(300)]
    got = {}
    for r in cluster.knn(pts(spark, rows), 5).collect():
        got.setdefault(r.id, {})[r["rank"]] = r.neighbor_id
    want = brute_knn(rows, 5)
    for i in want:
        assert [got[i][k] for k in range(1, 6)] == want[i]


def test_knn_vectors_exact_in_many_dimensions(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 12)) * 4
    x = centres[rng.integers(0, 8, 500)] + rng.normal(size=(500, 12)) * 0.3
    x[300:380] = x[0]                                                   # a hot vector
    x[380:500] = x[1] + rng.normal(size=(120, 12)) * 1e-3               # a hot cell
    rows = [(int(i), [float(v) for v in x[i]]) for i in range(500)] + [(900, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    want = {i: [int(j) for j in np.lexsort((np.arange(500), d[i]))[:6]] for i in range(500)}
    for blocks in ({}, {"query_block": 40, "vector_block": 60}):
        got = {}
        for r in cluster.knn_vectors(df, 6, **blocks).collect():
            got.setdefault(r.id, {})[r["rank"]] = r.neighbor_id
        assert {i: [g[k] for k in range(1, 7)] for i, g in got.items()} == want
    assert cluster.knn_vectors(df.limit(0), 3).collect() == []
    assert cluster.knn_vectors(df.where("id < 2"), 7).count() == 4


def test_knn_vectors_of_equal_distances(spark):
    rows = [(int(i) * 7 % 61, [float(j == i % 40) for j in range(40)]) for i in range(61)]  # 40 locations, all equally far apart
    df = spark.createDataFrame(rows, "id long, v array<double>")
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    for blocks in ({}, {"query_block": 7, "vector_block": 11}):
        got = {(r.id, r["rank"]): r.neighbor_id for r in cluster.knn_vectors(df, 5, **blocks).collect()}
        for i, v in rows:
            want = ids[np.lexsort((ids, ((x - np.array(v)) ** 2).sum(axis=1)))[:5]]
            assert [got[i, k] for k in range(1, 6)] == want.tolist()


def test_knn_vectors_sends_no_vector_to_each_block_of_queries():
    # 600,000 unrelated vectors: every block may hold a neighbour of every query
    cells, q = np.repeat(np.arange(60), 10), np.full(600, 1000)
    near, reach = np.zeros((120, 60)), np.ones(60)
    q_run, q_meets, t_run, t_meets = cluster._meetings(cells, q, cells[::5], np.full(120, 5000), near, reach, cluster.RUN_ROWS)
    assert len({*t_run}) <= 20 and max(np.bincount(q_run)) <= 34 and max(np.bincount(t_run)) <= 8
    assert max(map(len, t_meets)) <= 20 and max(map(len, q_meets)) <= 20
    met = {(a, b) for a, m in zip(q_run, q_meets) for b in m}
    assert met == {(a, b) for b, m in zip(t_run, t_meets) for a in m} and len(met) == len({*q_run}) * len({*t_run})
    # cells far from each other meet only their own vectors
    near = np.where(np.eye(60, dtype=bool)[cells[::5]], 0.0, 9.0)
    q_run, q_meets, t_run, t_meets = cluster._meetings(cells, q, cells[::5], np.full(120, 5000), near, reach, 10_000)
    assert all(len(m) == 1 for m in q_meets + t_meets)


def test_k_distance_over_runs_of_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(cluster, "RUN_ROWS", 50)
    x = np.random.default_rng(6).normal(size=(240, 16))
    df = spark.createDataFrame([(i, [float(f) for f in v]) for i, v in enumerate(x)], "id long, v array<double>")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    nearest = np.sort(d, axis=1)[:, 1]
    got = cluster.k_distance(cluster.knn_vectors(df, 4, query_block=16, vector_block=20), 2).orderBy("position").collect()
    assert [r.id for r in got] == np.argsort(nearest, kind="stable").tolist() and [r.position for r in got] == list(range(240))
    assert np.allclose([r.distance for r in got], np.sort(nearest))


def test_mixed_table_dbscan_against_brute_force(spark):
    from textquarry.plans import cluster_queries as Q

    sf = "/root/testdata/sf0.001"
    p = [(r.id, r.pc) for r in Q._mixed_projection(spark, sf).collect()]
    near = {i: [j for j, b in p if (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= Q.MIXED_EPS ** 2] for i, a in p}
    core = {i for i, n in near.items() if len(n) >= Q.MIN_PTS}
    label = {}
    for i in sorted(core):
        todo = [i] if i not in label else []
        while todo:
            j = todo.pop()
            if j not in label:
                label[j] = i
                todo += [n for n in near[j] if n in core]
    out = {r.id: r for r in Q.q_mixed_table_dbscan(spark, sf).collect()}
    assert {i for i, r in out.items() if r.is_core} == core and core
    numbers = {c: k for k, c in enumerate(sorted(set(label.values())))}
    for i, _ in p:
        of = [label[n] for n in near[i] if n in core]
        assert out[i].cluster == (numbers[label[i]] if i in core else numbers[min(of)] if of else -1)


def test_dbscan_two_adjacent_hot_cells(spark):
    """Two thirds of the points lie in neighbouring cells that just touch, or just don't."""
    rng = np.random.default_rng(8)
    eps = 1.0
    for gap, clusters in ((0.999, 1), (1.001, 2)):
        left = np.column_stack([rng.random(700) * 0.5, rng.random(700) * 0.5])
        right = np.column_stack([0.5 + gap + rng.random(700) * 0.5, rng.random(700) * 0.5])
        left[0], right[0] = (0.5, 0.25), (0.5 + gap, 0.25)
        far = np.column_stack([50 + 7 * rng.random(300) * 10, 50 + rng.random(300) * 100])
        rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.vstack([left, right, far]))]
        out = {r.id: r.cluster for r in cluster.dbscan(pts(spark, rows), eps, 5).collect()}
        assert len({out[i] for i in range(1400)}) == clusters and -1 not in {out[i] for i in range(1400)}
