"""SimHash groups against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from textquarry.llm import simhash_dedup as S
from textquarry.llm.common import Store


def brute_fp(text, k):
    b = (text or "").encode()
    b = bytes(c + 32 if 65 <= c <= 90 else c for c in b)
    words = b.split()
    sh = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    n = Counter()
    for s in sh:
        h = xxhash.xxh64_intdigest(s, 42)
        for i in range(64):
            n[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * n[i] > len(sh))


def brute_groups(rows, t):
    """component_id per row of (doc_id, fp)."""
    fps = sorted({f for _, f in rows})
    at = {f: i for i, f in enumerate(fps)}
    p = list(range(len(fps)))

    def find(i):
        while p[i] != i:
            i = p[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= t:
                p[find(i)] = find(j)
    low = {}
    for d, f in rows:
        r = find(at[f])
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return [low.get(find(at[f])) for _, f in rows]


def test_fingerprint_matches_definition(monkeypatch):
    texts = [None, "", " \n\t", "One", "a b c", "The the THE the the", "É à b c d\x0be", "x y z w " * 50]
    for t in texts:
        assert S.fingerprint(t.encode() if t is not None else None, 4) == brute_fp(t, 4)
    long = " ".join(random.Random(1).choice("aé b cc dd".split()) + str(i % 37) for i in range(3000))
    want = brute_fp(long, 4)
    assert S.fingerprint(long.encode(), 4) == want
    import textquarry.llm.common as C
    monkeypatch.setattr(S, "word_blocks", lambda b: C.word_blocks(b, 100))
    assert S.fingerprint(long.encode(), 4) == want


@pytest.mark.parametrize("chunks", [2, 3, 4])
def test_links_connect_like_all_pairs(spark, chunks, monkeypatch):
    monkeypatch.setattr(S, "SALT_ROWS", 3)
    rnd = random.Random(chunks)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(40):
        f = rnd.getrandbits(64)
        for _ in range(6):
            fps.add(f)
            for _ in range(rnd.randint(1, 5)):
                f ^= 1 << rnd.randrange(64)
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    got = S.near_links(Store(spark, "t"), df, 4, chunks).collect()
    rows = [(i, f) for i, f in enumerate(fps)]
    want = brute_groups(rows, 4)
    at = {s: i for i, s in enumerate(signed)}
    p = list(range(len(fps)))

    def find(i):
        while p[i] != i:
            i = p[i]
        return i

    for a, b in got:
        p[find(at[a])] = find(at[b])
    low = {}
    for i in range(len(fps)):
        low.setdefault(find(i), i)
    assert [low[find(i)] for i in range(len(fps))] == want


def test_groups_with_nulls_repeats_and_clashing_columns(spark):
    base = " ".join(f"w{i}" for i in range(400))
    near = base.replace("w77 ", "w78x ")
    rows = [(5, base), (3, near), (9, "something else entirely here"), (2, None), (7, ""), (None, base), (9, base),
            (5, base), (None, "only nameless rows say this")]
    df = spark.createDataFrame([(i, t, "f", 1, 2) for i, t in rows],
                               "doc_id bigint, text string, fingerprint string, component_id int, fp int")
    got = sorted(map(tuple, S.simhash_groups(df, shingle=4, max_bits=4).collect()), key=repr)
    fps = [(i, brute_fp(t, 4)) for i, t in rows]
    want = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(fps, brute_groups(fps, 4))), key=repr)
    assert got == want
    assert S.simhash_groups(df.limit(0)).collect() == []


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    fps = [(i, brute_fp(t, 4)) for i, t in rows]
    want = sorted((i, f"{f:016x}", c) for (i, f), c in zip(fps, brute_groups(fps, 4)))
    from textquarry.llm.queries import QUERIES

    got = sorted(map(tuple, QUERIES["op3_simhash_dedup"](spark, "/root/testdata/sf0.001").collect()))
    assert got == want
