"""Leaks against a plain Smith-Waterman over every (document, item)."""

import random

import numpy as np

from textquarry.llm import decontaminate as D


def plain_align(a, b):
    """(score, matches) by the textbook table."""
    h = [[(0, 0)] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = (0, 0)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s, m = h[i - 1][j - 1]
            same = a[i - 1] == b[j - 1]
            up, left = h[i - 1][j], h[i][j - 1]
            h[i][j] = max((0, 0), (s + (2 if same else -1), m + same), (up[0] - 1, up[1]), (left[0] - 1, left[1]))
            best = max(best, h[i][j])
    return best


def test_alignment_matches_textbook():
    rnd = random.Random(3)
    for _ in range(60):
        a = [rnd.randint(1, 6) for _ in range(rnd.randint(1, 12))]
        b = [rnd.randint(0, 6) for _ in range(rnd.randint(0, 25))]
        got, _ = D.align(np.array(a, dtype=np.int32), np.array(b, dtype=np.int32))
        assert got == plain_align(a, b)[1]


def words(t):
    return [w for ws in D.words_of(t or "") for w in ws]


def test_leaks_match_brute_force(spark):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(60)] + ["É", "the"]

    def text(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))

    items = [(i, text(rnd.choice([12, 25, 40]))) for i in range(12)] + [(50, "Only Three words"), (51, None), (52, " - "),
                                                                       (0, None)]
    docs = []
    for i in range(60):
        t = text(rnd.randint(0, 120)).split()
        if i % 3:
            src = items[i % 12][1].split()
            for _ in range(rnd.randint(0, max(1, len(src) // 6))):
                k = rnd.randrange(len(src))
                src[k: k + 1] = rnd.choice([["new"], [], [src[k], "more"]])
            at = rnd.randint(0, len(t))
            t[at:at] = src
        docs.append((i, " ".join(t).upper() if i % 2 else ", ".join(t)))
    docs += [(100, "only three, WORDS"), (101, None), (102, ""), (None, items[0][1]), (103, items[1][1] + " x " + items[1][1]),
             (103, items[1][1])]
    d = spark.createDataFrame([(i, t, 1, "s", 0) for i, t in docs], "doc_id bigint, text string, item_id int, score string, passage int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.matched, r.item_words) for r in D.leaks(d, b).collect()}
    want = {}
    for i, t in docs:
        for k, it in items:
            a, w = words(it), words(t)
            n = min(5, len(a))
            run = n + D.SPREAD - 1 if len(a) >= n + D.SPREAD - 1 else len(a)
            sure = any(a[x:x + run] == w[y:y + run] for x in range(len(a) - run + 1) for y in range(len(w) - run + 1)) if a else False
            m = plain_align(a, w)[1] if a else 0
            if sure and m >= 0.8 * len(a):
                want[i, k] = max(want.get((i, k), (0, 0)), (m, len(a)))
    assert set(want) <= set(got)
    for key, v in got.items():
        assert v[0] >= 0.8 * v[1]
        if key in want:
            assert v == want[key]
    assert (100, 50) in got and (None, 0) in got
    # in blocks: the same
    again = {(r.doc_id, r.item_id): (r.matched, r.item_words) for r in D.leaks(d, b, block_chars=300).collect()}
    assert {k: v for k, v in again.items() if k in want} == want
    assert D.leaks(d.limit(0), b).collect() == [] and D.leaks(d, b.limit(0)).collect() == []


def test_seed_size_fits_every_copy():
    assert [D.gram_size(n, 5, 0.8) for n in (1, 4, 5, 6, 7, 8, 12, 16, 20, 39, 100)] == [1, 4, 2, 2, 3, 3, 3, 3, 3, 4, 3]


def test_edited_copies_match_all_pairs(spark):
    """All pairs, no filter: short and long items with as many replaced, missing or extra words as 0.8 allows."""
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(400)]
    items = [(k, " ".join(rnd.choice(vocab) for _ in range(n))) for k, n in enumerate([3, 5, 6, 7, 8, 9, 12, 16, 16, 20, 25, 39, 60])]
    docs, planted = [], set()
    for k, it in items:
        src = it.split()
        for copy in range(20):
            p, lost = list(src), len(src) // 5
            for x in sorted(rnd.sample(range(len(src)), lost), reverse=True):
                p[x: x + 1] = rnd.choice([["new"], ["new"], [], [p[x], "more"]])
            before, after = ([rnd.choice(vocab) for _ in range(rnd.randint(0, 60))] for _ in range(2))
            docs.append((len(docs), " ".join(before + p + after)))
            planted.add((len(docs) - 1, k))
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.matched for r in D.leaks(d, b).collect()}
    want = {}
    for i, t in docs:
        w = t.split()
        for k, it in items:
            a = it.split()
            if sum(x in a for x in w) >= 0.8 * len(a):
                m = plain_align(a, w)[1]
                if m >= 0.8 * len(a):
                    want[i, k] = m
    assert got == want and len(planted & set(want)) > 250


def test_whole_table_finds_every_verbatim_copy(spark):
    sf = "/root/testdata/sf0.001"
    from textquarry.llm.queries import QUERIES

    out = QUERIES["op5_decontaminate"](spark, sf).collect()
    got = {(r.doc_id, r.item_id) for r in out}
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if d.text and i.text and i.text in d.text}
    assert exact and exact <= got
    assert all(0.8 <= r.score <= 1 for r in out)
