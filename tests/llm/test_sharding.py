import zlib
from collections import defaultdict

from textquarry.llm import sharding
from textquarry.llm.queries import op12_sharding

SMALL = "/root/testdata/sf0.001"


def measures(text):
    t = text or ""
    words = [w for w in t.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    return len(t.encode()) + 1, len(words), 1


def check(docs, rows, n_shards=16):
    """Everything the rows must hold for (doc_id, text) pairs; returns shard by text."""
    want = sorted((i if i is not None else -1, measures(t)[0], zlib.crc32((t or "").encode())) for i, t in docs)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in rows) == want
    assert {(r.law, r.grown_shard) for r in rows} <= {("bytes", None)}
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < n_shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def greedy(docs, n_shards):
    """Shard of each text: groups from the largest part of any total down, each
    to the shard with the highest dot product with what it can still take."""
    groups = defaultdict(lambda: [0, 0, 0])
    for _, t in docs:
        groups[t or ""] = [a + b for a, b in zip(groups[t or ""], measures(t))]
    totals = [max(sum(g[d] for g in groups.values()), 1) for d in range(3)]
    parts = {t: [x / y for x, y in zip(g, totals)] for t, g in groups.items()}
    left = [[1 / n_shards] * 3 for _ in range(n_shards)]
    out, ties = {}, defaultdict(list)
    for t, p in sorted(parts.items(), key=lambda x: -max(x[1])):
        dots = [sum(a * b for a, b in zip(p, cap)) for cap in left]
        s = max(range(n_shards), key=lambda i: (dots[i], -i))
        left[s] = [a - b for a, b in zip(left[s], p)]
        out[t] = s
        ties[max(p)].append(t)
    return out, {t for same in ties.values() if len(same) > 1 for t in same}


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    df = op12_sharding(spark, SMALL)
    assert df.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = df.collect()
    check(docs, rows)
    shard = defaultdict(set)
    text = dict(docs)
    for r in rows:
        shard[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in shard.values())
    load = defaultdict(int)
    for r in rows:
        load[r.shard] += r.size
    largest = max(sum(measures(t)[0] for _, t in docs if t == u) for u in {t for _, t in docs})
    even = sum(load.values()) / 16
    assert max(load.values()) <= max(1.1 * even, largest) and min(load.values()) >= 0.9 * even


def test_places_like_the_plain_greedy(spark):
    # sizes all differ, so that no two groups tie
    docs = [(i, "w" * (7 * i % 101 + i) + " x" * (i % 13)) for i in range(1, 90)]
    docs += [(1000 + i, docs[3][1]) for i in range(2)]
    want, ties = greedy(docs, 5)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = sharding.shard_documents(df, n_shards=5).collect()
    check(docs, rows, 5)
    text = dict(docs)
    if not ties:
        assert {r.doc_id: r.shard for r in rows} == {i: want[text[i]] for i, _ in docs}
    else:  # loads are those of the plain greedy whichever of the tied came first
        a, b = defaultdict(int), defaultdict(int)
        for r in rows:
            a[r.shard] += r.size
        for i, t in docs:
            b[want[t]] += measures(t)[0]
        assert max(abs(a[s] - b[s]) for s in range(5)) <= 0.02 * sum(a.values())


def test_hot_group_is_cut_and_all_stays_even(spark):
    docs = [(i, "the same text over and over") for i in range(500)]
    docs += [(1000 + i, f"text {i} " + "ab " * (i % 17)) for i in range(1000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    rows = sharding.shard_documents(df, own_parts=100).collect()
    check(docs, rows)
    load = defaultdict(int)
    for r in rows:
        load[r.shard] += r.size
    even = sum(load.values()) / 16
    assert all(0.97 * even <= load[s] <= 1.03 * even for s in range(16))
    shards = defaultdict(set)
    text = dict(docs)
    for r in rows:
        shards[text[r.doc_id]].add(r.shard)
    assert [t for t, s in shards.items() if len(s) > 1] == ["the same text over and over"]


def test_bundles_hold_small_groups_together(spark):
    docs = [(i, f"text {i % 700} " + "cd " * (i % 7 * 5)) for i in range(1400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = sharding.shard_documents(df, own_parts=5, bundles=64).collect()
    check(docs, rows)
    text, shards = dict(docs), defaultdict(set)
    for r in rows:
        shards[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_odd_rows(spark):
    docs = [(None, "a b"), (None, None), (3, ""), (3, ""), (4, "é ü"), (5, "x " * 40_000)]
    df = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, size int, key string")
    check(docs, sharding.shard_documents(df).collect())
    assert sharding.shard_documents(df.limit(0)).collect() == []
    assert {r.shard for r in sharding.shard_documents(df, n_shards=1).collect()} == {0}
