"""Token counts against the library on whole texts, by both joins."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textquarry.llm import token_counts as T

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", "  \n\t ", "Hello I'm here!", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|><|startoftext|>", "ΣΑΣ ΟΔΟΣ İstanbul",
       "é e ́x  y z\x1cq", "日本語テキスト 한국어 😀👩‍👩‍👧", "x" * 5000, "don't 'stop' we'll I'd 123 4.5", "a\x00b﻿c",
       "ﬁ Å Å", "word " * 3000]


def library(t):
    return len(Tokenizer.from_file(PATH).encode(t or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("table_bytes", [T.TABLE_BYTES, 0])
def test_odd_texts(spark, table_bytes):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no name")]
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id bigint, text string, n_tokens int, word string")
    got = sorted(map(tuple, T.token_counts(df, PATH, table_bytes=table_bytes).collect()), key=repr)
    want = sorted(((i, len((t or "").encode()), library(t), library(t) > 2048) for i, t in rows), key=repr)
    assert got == want
    assert T.token_counts(df.limit(0), PATH, table_bytes=table_bytes).collect() == []


def test_whole_table(spark):
    from textquarry.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    tok = Tokenizer.from_file(PATH)
    tok.no_truncation()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op9_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    for d in docs:
        n = len(tok.encode(d.text, add_special_tokens=False).ids)
        assert got[d.doc_id] == (len(d.text.encode()), n, n > 2048)


def test_shared_hashes_are_counted_apart(spark, monkeypatch):
    monkeypatch.setattr(T, "_hash", lambda ws: T.np.array([len(w) % 3 for w in ws], dtype=T.np.uint64))
    df = spark.createDataFrame([("a", 1), ("bcd", 2), ("efghij", 2), ("kl", 7), ("mn", 8)], "word string, n bigint")
    from pyspark import cloudpickle

    import textquarry.llm.token_counts as mod
    cloudpickle.register_pickle_by_value(mod)
    try:
        h, n = T._packed(df)
    finally:
        cloudpickle.unregister_pickle_by_value(mod)
    assert dict(zip(h.tolist(), n.tolist())) == {0: 2, 1: 1, 2: -1}
