"""Embedding groups against all pairs; recall of the graphs; odd rows."""

import numpy as np
import pytest

from textquarry.llm import embedding_dedup as E

SMALL = "/root/testdata/sf0.01"


def brute(rows, t=0.93):
    """{position: (n_links, component)} of (vec_id, vector, label) by all pairs."""
    def good(v, label):
        return label is not None and v is not None and len(v) and None not in v and np.all(np.isfinite(v)) and np.any(v)

    p = list(range(len(rows)))

    def find(i):
        while p[i] != i:
            i = p[i]
        return i

    links = [0] * len(rows)
    groups = {}
    for i, (_, v, label) in enumerate(rows):
        if good(v, label):
            groups.setdefault((label, len(v)), []).append(i)
    for at in groups.values():
        x = np.array([rows[i][1] for i in at], dtype=np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        s = x @ x.T >= t
        np.fill_diagonal(s, False)
        for a, b in zip(*np.nonzero(s)):
            links[at[a]] += 1
            p[find(at[a])] = find(at[b])
    low = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            low[find(i)] = min(v, low.get(find(i), v))
    return [(links[i], low.get(find(i))) for i in range(len(rows))]


def vectors(seed, n, d=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6 + 1, d))
    return (centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, d)) * rng.choice([0.05, 0.15, 1.0], n)[:, None]).astype(np.float32)


def test_graph_recall_and_widening():
    x = E._unit(vectors(1, 1500).astype(np.float64))
    g = E.Graph(x)
    true = x @ x.T >= 0.93 - 1e-5
    found = sum(len(g.within(x[i], 0.93 - 1e-5, E.BEAM)) for i in range(len(x)))
    assert found >= 0.98 * true.sum()
    # a graph without links finds nothing but by widening the beam to a scan
    g.size[0][:], g.first[:] = 0, 0
    shard = (np.arange(len(x)), np.ones(len(x), dtype=int), x.astype(np.float64), g)
    got, beam = E.search_block((np.arange(100), x[:100].astype(np.float64)), shard, 0.93)
    assert beam >= len(x) and sum(map(len, got)) == (true[:100].sum() - 100)


@pytest.mark.parametrize("shard_rows,block_rows", [(E.SHARD_ROWS, E.BLOCK_ROWS), (50, 37)])
def test_groups_match_all_pairs(spark, shard_rows, block_rows):
    x = vectors(2, 600)
    rows = [(int(i), [float(f) for f in x[i]], int(i % 4)) for i in range(600)]
    rows += [(1000 + k, rows[5][1], 1) for k in range(30)] + [(5, rows[5][1], 1), (None, rows[5][1], 1)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [None] * 16, 1),
             (2005, rows[5][1], None), (2006, [float("inf")] + [1.0] * 15, 1), (2007, rows[5][1][:3], 1), (None, None, None),
             (2008, [1e-30 * f for f in rows[5][1]], 1)]
    df = spark.createDataFrame([(a, b, c, 7, "k", 0) for a, b, c in rows],
                               "vec_id bigint, embedding array<float>, label int, n_links int, key string, dim int")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = E.embedding_groups(df, shard_rows=shard_rows, block_rows=block_rows).collect()
    want = [(i, n, c, True if i is None or c is None else i == c) for (i, _, _), (n, c) in zip(rows, brute(rows))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert E.embedding_groups(df.limit(0)).collect() == []


def test_blocks_share_copies_of_a_shard(spark):
    shards = spark.createDataFrame([("a", 0, b"x"), ("a", 1, b"y"), ("b", 0, b"z")], "group string, shard bigint, index binary")
    blocks = spark.createDataFrame([("a", k, b"q") for k in range(20)] + [("b", 0, b"q")], "group string, block bigint, queries binary")
    parts = spark.createDataFrame([("a", 2, 20), ("b", 1, 1)], "group string, shards bigint, blocks bigint")
    got = E.meetings(shards, blocks, parts).collect()
    copies = [(r.group, r.shard) for r in got if r.block < 0]
    assert {c: copies.count(c) for c in copies} == {("a", 0): 3, ("a", 1): 3, ("b", 0): 1}
    met = [(r.group, r.shard, r.block) for r in got if r.block >= 0]
    assert sorted(met) == sorted([("a", s, k) for s in (0, 1) for k in range(20)] + [("b", 0, 0)])
    whole = {(r.group, r.shard, r.run) for r in got if r.block < 0}
    assert all((r.group, r.shard, r.run) in whole for r in got)


def test_query_matches_oracle(same):
    same("op2_embedding_dedup")
