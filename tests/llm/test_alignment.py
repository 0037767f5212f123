import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from textquarry.llm import alignment
from textquarry.llm.queries import op13_alignment

SMALL = "/root/testdata/sf0.001"

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["a  b", " x", "x ", "x\n\ny z", "don't <|endoftext|> x <s> y </s>", "日本語 テキスト é é́", "a▁b", "　x y", "x\x00y z",
       "fi ﬁ Ａ", "\U0001F600 hi 👩‍👩‍👧 x", "a\tb c", "a \n b", "\x1c a", "a\x85 b", "1 2 333 4444 .. ,, ()", "﻿x y",
       "x\r\ny z", "a  b", "a     b"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def decoded(a, b, text):
    """Tokens as (id, bytes), by the tokenizers' own tables."""
    own = list(range(ord("!"), ord("~") + 1)) + list(range(0xA1, 0xAD)) + list(range(0xAE, 0x100))
    table, more = {chr(x): x for x in own}, 256
    for x in range(256):
        if x not in own:
            table[chr(more)] = x
            more += 1
    ta = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    tb = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
          for i in b.encode(text)]
    return ta, tb


def plain(a, b, text):
    """(n_a, n_b, n_groups, groups, links) of a text by walking over its bytes; None without tokens."""
    if not text:
        return None
    ta, tb = decoded(a, b, text)
    want = (" " + text).encode()
    if b"".join(x for _, x in ta) != want or b"".join(x for _, x in tb) != want:
        return None
    groups, links, i, j, ea, eb, ga, gb = [], Counter(), 0, 0, 0, 0, [], []
    while i < len(ta) or j < len(tb):
        if ea <= eb:
            ea += len(ta[i][1])
            ga.append(str(ta[i][0]))
            i += 1
        else:
            eb += len(tb[j][1])
            gb.append(str(tb[j][0]))
            j += 1
        if ea == eb:
            groups.append(",".join(ga) + "|" + ",".join(gb))
            ga, gb = [], []
    spans = []
    for tokens in (ta, tb):
        at, s = 0, []
        for t, x in tokens:
            s.append((t, at, at + len(x)))
            at += len(x)
        spans.append(s)
    first = 0
    for t, s, e in spans[0]:
        while spans[1][first][2] <= s:
            first += 1
        k = first
        while k < len(spans[1]) and spans[1][k][1] < e:
            links[t, spans[1][k][0]] += 1
            k += 1
    return len(ta), len(tb), len(groups), ";".join(groups), links


def table(a, b, docs):
    """The whole result for a list of (doc_id, text)."""
    each = [(i, plain(a, b, t)) for i, t in docs]
    count = Counter(p for _, x in each if x for p in x[4])
    most = defaultdict(int)
    for (t, _), n in count.items():
        most[t] = max(most[t], n)
    out = []
    for i, x in each:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = x[4]
        out.append((i, *x[:3], sum(links.values()), sum(n for p, n in links.items() if count[p] == most[p[0]]),
                    sum(n * count[p] for p, n in links.items()), hashlib.sha256(x[3].encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query_against_plain_walk(spark, libraries):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    df = op13_alignment(spark, SMALL)
    assert df.columns == COLUMNS
    assert rows_of(df) == table(*libraries, docs)


@pytest.mark.parametrize("pairs", [1 << 20, 40, 0])
def test_odd_texts_whatever_the_table_holds(spark, libraries, pairs):
    r = random.Random(3)
    letters = "ab cd 's.,\n\t é日😀1▁ "
    texts = ODD + ["".join(r.choice(letters) for _ in range(r.randint(1, 14))) for _ in range(300)]
    docs = [*enumerate(texts), (None, "a b"), (7, None), (8, ""), (9, "a b"), (9, "a b")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, row int")
    assert rows_of(alignment.align(df, A, B, table_pairs=pairs)) == table(*libraries, docs)


def test_long_texts_in_blocks(spark, libraries, monkeypatch):
    text = " ".join(f"word{i % 977} don't é{i}" for i in range(30_000)) + "\n" + "x" * 50_000
    docs = [(1, text), (2, text[:1000]), (3, text)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(alignment.align(df, A, B)) == table(*libraries, docs)
    with open(A) as f, open(B, "rb") as g:
        enc = alignment.Encoders(f.read(), g.read())
    known = alignment.Aligned(enc)
    once = alignment._one([enc.words(text)], known)
    monkeypatch.setattr(alignment, "BLOCK", 1000)
    monkeypatch.setattr(alignment, "HELD", 500)
    parts = alignment._one(map(enc.words, enc.blocks(text)), alignment.Aligned(enc))
    assert (once[0] == parts[0]).all() and once[1:] == parts[1:]


def test_pointer_doubling_against_search():
    r = random.Random(9)
    for _ in range(200):
        n = r.randint(1, 40)
        ends = [np.array(sorted({n, *(r.randint(1, n) for _ in range(r.randint(0, n)))})) for _ in range(2)]
        common = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        to = alignment.terminals(*ends)
        for side, at in ((0, 0), (1, len(ends[0]))):
            for k, e in enumerate(ends[side].tolist()):
                stop = next(c for c in common if c >= e)
                assert to[at + k] == int(np.searchsorted(ends[0], stop))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(df, A, B).collect() == []
