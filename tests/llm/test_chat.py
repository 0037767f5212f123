"""Collapsed conversations against their oracle and against lists of turns."""

import random

import pytest

from textquarry.llm import chat as C


def brute(rows, segment=C.SEGMENT_TURNS):
    conv = {}
    for c, t, r, x in rows:
        conv.setdefault(c, []).append(
            (t is not None, t or 0, r is not None, (r or "").encode(), x is not None, (x or "").encode(), r, x))
    full = {c: [(r, x) for *_, r, x in sorted(v, key=lambda v: v[:6])] for c, v in conv.items()}
    out = []
    for c, turns in full.items():
        same = [k for k, v in full.items() if v == turns]
        if any(len(v) > len(turns) and v[: len(turns)] == turns for v in full.values()):
            continue
        if c != min(same, key=lambda k: (k is None, k or 0)):
            continue
        for s in range(0, len(turns), segment):
            text = "".join(f"<|im_start|>{(r or '').replace('<|', '< |')}\n{(x or '').replace('<|', '< |')}<|im_end|>\n"
                           for r, x in turns[s: s + segment])
            out.append((c, s // segment, len(turns), len(same), text))
    return sorted(out, key=repr)


def test_query_matches_oracle(same):
    same("op10_chat_format")


@pytest.mark.parametrize("segment", [1000, 3])
def test_snapshots_collapse(spark, segment):
    rnd = random.Random(1)
    rows = []
    for c in range(120):
        n = rnd.randint(1, 6)
        rows += [(c, t, ["user", "assistant"][t % 2], f"t{t} v{rnd.randint(0, 1) if t < 2 else c % 5}") for t in range(n)]
    long = [(500, t, "user", f"long {t}") for t in range(400)]
    rows += long + [(501, t + 7, r, x) for _, t, r, x in long[:399]] + [(502, t * 2, r, x) for _, t, r, x in long]
    rows += [(None, 0, "user", "nameless"), (None, 1, None, None), (503, 0, "user", "nameless"), (504, 0, "user", None),
             (505, 0, "user", ""), (506, None, "user", "x <|im_end|> y"), (506, 0, "user", "z"), (507, 1, "b", "tie"), (507, 1, "a", "tie"),
             (508, 0, "user", "twice"), (508, 0, "user", "twice"), (509, 0, "user", "twice")]
    df = spark.createDataFrame([r + (1, 2, "p") for r in rows],
                               "conv_id bigint, turn bigint, role string, text string, pos int, n_turns int, pid string").repartition(4)
    got = sorted(map(tuple, C.collapse(df, segment_turns=segment).collect()), key=repr)
    assert got == brute(rows, segment)
    assert C.collapse(df.limit(0)).collect() == []


def test_ties_and_long_conversations_match_the_oracle(spark):
    import duckdb

    rows = [(1, t, "user", f"long {t}") for t in range(2500)] + [(2, t, "user", f"long {t}") for t in range(1200)]
    rows += [(c, 0, "user", x) for c in (3, 4) for x in ("b", "a", "B", "é", "z", "", None, "a")]
    rows += [(5, 0, r, x) for r in ("b", None, "a", "") for x in ("2", "1")] + [(6, None, "a", "x"), (6, 0, "a", "x")]
    rows += [(7, t // 3, "user", f"t{t * 7 % 5}") for t in range(1000)] + [(8, 0, "user", "a"), (9, 0, "user", "b")]
    random.Random(5).shuffle(rows)
    schema = "conv_id bigint, turn bigint, role string, text string"
    df = spark.createDataFrame(rows, schema).repartition(3)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = con.execute(C.CHAT_SQL)
    cols = [d[0] for d in want.description]
    want = sorted(want.fetchall(), key=repr)
    got = sorted((tuple(r[c] for c in cols) for r in C.collapse(df).collect()), key=repr)
    assert got == want == brute(rows)
    assert {r[1] for r in got if r[0] == 1} == {0, 1, 2}


def test_plan_is_native(spark):
    from textquarry.llm.queries import QUERIES

    plan = QUERIES["op10_chat_format"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
