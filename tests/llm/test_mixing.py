"""Mixing against its oracle, a plain water-filling, and odd rows."""

import collections

from textquarry.llm import mixing as M


def plain_targets(sizes, cap=3):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        level = (total - sum(fixed.values())) / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > cap * sizes[s]]
        if not over:
            return fixed | {s: level * w[s] for s in free}
        fixed |= {s: float(cap * sizes[s]) for s in over}


def test_query_matches_oracle(same):
    same("op7_mixing")


def test_targets_caps_and_sums(spark):
    rows = [(i, "w " * (i % 7), ["b", "a", "é", None, "zz", "tiny"][min(i % 9, 5)]) for i in range(400)]
    rows += [(1000, None, "a"), (None, "x y z", "a"), (None, "x y z", "a"), (5, "again and again", "zz"), (5, "again and again", "zz"),
             (2000, "one\x0btwo\xa0three\x0cfour", "only"), (2001, "", "void"), (2002, None, "nil")]
    df = spark.createDataFrame([(a, b, c, 0, 1.0, "h") for a, b, c in rows],
                               "doc_id bigint, text string, source string, size int, target double, _h string")
    out = M.mix(df).collect()
    assert len(out) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").encode().split())
    want = plain_targets(dict(sizes))
    taken = collections.Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-9
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == int(want[s]) for s in sizes)
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, M.mix(df.repartition(5)).collect()), key=repr)


def test_empty_and_wordless(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert M.mix(df).collect() == []
    df = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id bigint, text string, source string")
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in M.mix(df).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
