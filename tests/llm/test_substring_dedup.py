"""Repeated passages against all pairs of paragraphs, planted passages, odd rows."""

import random

import numpy as np
import pytest

from textquarry.llm import substring_dedup as S

SMALL = "/root/testdata/sf0.001"


def paragraphs(texts):
    """(owner, start, end, content, shingle set) of every paragraph."""
    p, out = S.Paragraphs(5, *S.tune()), []
    for owner, start, end, keys in S._walk(texts, p):
        out += [(int(o), int(s), int(e), p.content(k), frozenset(p.shingles(k).tolist()))
                for k, (o, s, e) in enumerate(zip(owner, start, end))]
    return sorted(out)


def brute(rows):
    """{(row, start): (n_words, component_id, kept, passage_words)} by comparing all pairs."""
    ps = paragraphs([t.encode() if t is not None else None for _, t in rows])
    contents = sorted({c for *_, c, _ in ps})
    sets = {c: s for *_, c, s in ps}
    p = {c: c for c in contents}

    def find(c):
        while p[c] != c:
            c = p[c]
        return c

    for i, a in enumerate(contents):
        for b in contents[:i]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                p[find(a)] = find(b)
    member = {}
    for o, s, e, c, _ in ps:
        member.setdefault(find(c), []).append((rows[o][0] is None, rows[o][0] or 0, o, s, e))
    out = {}
    for m in member.values():
        if len({o if n else ("id", d) for n, d, o, _, _ in m}) > 1:
            first = min(m)
            for n, d, o, s, e in m:
                out[o, s] = [e - s, None if first[0] else first[1], (o, s) == (first[2], first[3]), 0]
    for o in {o for o, _ in out}:
        run = []
        for s in sorted(s for x, s in out if x == o):
            if run and run[-1] + out[o, run[-1]][0] != s:
                run = []
            run.append(s)
            for r in run:
                out[o, r][3] = sum(out[o, x][0] for x in run)
    return {k: tuple(v) for k, v in out.items() if v[3] >= S.MIN_WORDS}


def text(rnd, n, vocab=4000):
    return " ".join(f"w{rnd.randrange(vocab)}" for _ in range(n))


def test_bands():
    b, r = S.tune(0.8, 0.99)
    assert 1 - (1 - 0.8**r) ** b >= 0.99 and (b == 1 or 1 - (1 - 0.8**r) ** (b - 1) < 0.99)


def test_paragraphs_are_cut_by_content(monkeypatch):
    rnd = random.Random(1)
    texts = [text(rnd, n) for n in (0, 3, 5, 80, 3000)] + ["same same " * 300, ""]
    raw = [t.encode() for t in texts]
    whole = paragraphs(raw)
    assert whole == sorted((i, *p[1:]) for i, t in enumerate(raw) for p in paragraphs([t]))
    covered = sorted((o, s, e) for o, s, e, *_ in whole)
    for i, t in enumerate(texts):
        spans = [(s, e) for o, s, e in covered if o == i]
        assert all(0 <= s < e <= len(t.split()) for s, e in spans)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    import textquarry.llm.licenses as L
    monkeypatch.setattr(L, "BLOCK_BYTES", 700)  # long texts go block by block, and are cut alike
    assert paragraphs(raw) == whole


@pytest.mark.parametrize("key_bytes", [S.KEY_BYTES, 0])
def test_clusters_match_all_pairs(spark, monkeypatch, key_bytes):
    monkeypatch.setattr(S, "SALT_ROWS", 4)
    rnd = random.Random(2)
    passage = [text(rnd, 55), text(rnd, 70), text(rnd, 51)]
    rows = []
    for i in range(60):
        t = text(rnd, rnd.randint(0, 150)).split()
        if i % 2:
            p = passage[i % 3].split()
            if i % 5 == 0:
                p[rnd.randrange(len(p))] = f"edit{i}"
            at = rnd.randint(0, len(t))
            t[at:at] = p
        rows.append((i, " ".join(t)))
    rows += [(100, None), (101, ""), (None, passage[0]), (None, passage[0]), (102, passage[1] + " , " + passage[1]), (7, rows[8][1]),
             (200, text(rnd, 30) + " z" * 400), (201, "z " * 300 + text(rnd, 40)), (202, passage[2].upper())]
    df = spark.createDataFrame([(i, t, "r", 1, "c") for i, t in rows], "doc_id bigint, text string, row string, start int, class string")
    got = sorted(map(tuple, S.repeated_passages(df.coalesce(1), key_bytes=key_bytes).collect()), key=repr)
    want = sorted(((rows[o][0], s, *v) for (o, s), v in brute(rows).items()), key=repr)
    flat = lambda rs: [(d, s, n, c, w) for d, s, n, c, k, w in rs]  # noqa: E731  which of equal nameless rows is first is open
    assert flat(got) == flat(want)
    assert [r for r in got if r[0] is not None] == [r for r in want if r[0] is not None]
    hit = {r[0] for r in got}
    assert {i for i in range(60) if i % 2 and i % 5} <= hit
    assert not {i for i in range(60) if i % 2 == 0} - {8} & hit
    assert S.repeated_passages(df.limit(0)).collect() == []


def test_key_filter(spark):
    keys = np.random.default_rng(3).integers(-(2**63), 2**63, 40_000)
    df = spark.createDataFrame([(int(k),) for k in keys], "key bigint")
    sort = S.key_table(df, 8 * len(keys))
    assert sort[0] == 0 and sort[1].tolist() == sorted(keys.view(np.uint64).tolist())
    hashes, bits = S.key_table(df, S.SEGMENT)
    assert hashes and len(bits) == S.SEGMENT
    assert S._in_filter(keys.view(np.uint64).reshape(8, -1), bits, hashes).all()
    others = np.random.default_rng(4).integers(-(2**63), 2**63, 40_000).view(np.uint64)
    assert S._in_filter(others, bits, hashes).mean() < 0.02


def test_lone_paragraphs_are_not_stored_beyond_the_bound(spark, monkeypatch):
    put, stored = S.Store.put, []

    def counting(self, df):
        out = put(self, df)
        if "shingles" in df.columns and "start" in df.columns:
            stored.append(out.count())
        return out

    monkeypatch.setattr(S.Store, "put", counting)
    rnd = random.Random(5)
    passage = text(rnd, 60, 10**9)
    rows = [(i, text(rnd, 150, 10**9) + (" " + passage if i < 2 else "")) for i in range(40)]
    got = S.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string"), key_bytes=0).collect()
    assert {r.doc_id for r in got} == {0, 1} and len(got) <= stored[0] <= 2 * len(got)


def test_whole_table_matches_all_pairs(spark):
    from textquarry.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {(r.doc_id, r.start_word): (r.n_words, r.component_id, r.kept, r.passage_words)
           for r in QUERIES["op4_substring_dedup"](spark, SMALL).collect()}
    want = {(rows[o][0], s): v for (o, s), v in brute(rows).items()}
    assert want and set(got) <= set(want) and len(got) >= 0.98 * len(want)
    same = np.mean([got[k] == want[k] for k in got])
    assert same >= 0.98
