"""The byte network: folded tables equal the plain convolution; held-out accuracy; odd rows."""

import pickle
import zlib

import numpy as np
from pyspark.sql import functions as F

from textquarry.llm import language_id as L

SMALL = "/root/testdata/sf0.01"


def test_folded_tables_equal_plain_convolution():
    net = L.ByteNet(["a", "b", "c"])
    x = np.random.default_rng(1).integers(0, 256, (5, L.WINDOW)).astype(np.uint8)
    span = max(L.WIDTHS)
    e = net.p["emb"][np.pad(x, ((0, 0), (0, span - 1)))]
    z = np.stack([e[:, i: i + span].reshape(len(x), -1) @ net.p["conv"] for i in range(L.WINDOW)], axis=1)
    top = np.maximum((z + net.p["bias"]).max(axis=1), 0)
    logit = top @ net.p["out"] + net.p["shift"]
    want = np.exp(logit) / np.exp(logit).sum(axis=1, keepdims=True)
    assert np.allclose(L.Applied(net).probabilities(x), want, atol=1e-4)


def test_whole_text_counts():
    net = L.ByteNet(["a", "b"])
    app = L.Applied(net)
    text = bytes(np.random.default_rng(2).integers(32, 127, 300 * L.WINDOW + 17).astype(np.uint8))
    n = -(-len(text) // L.WINDOW)
    p = app.probabilities(L.windows_of(text, range(n)))
    share = np.full(n, L.WINDOW)
    share[-1] = 17
    mean = (p * share[:, None]).sum(axis=0) / len(text)
    [(lang, score)] = app.predict([text])
    assert lang == "ab"[int(mean.argmax())] and abs(score - mean.max()) < 1e-6


def test_held_out_accuracy_and_contract(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    from textquarry.llm.queries import QUERIES

    out = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, SMALL).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert set(out) == set(truth)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    assert all(0 <= r.score <= 1 and r.lang_pred in {"en", "fr", "de", "es", "und"} for r in out.values())
    test = [i for i, r in out.items() if r.held_out]
    assert sum(out[i].lang_pred == truth[i] for i in test) / len(test) >= 0.97


def test_odd_rows(spark):
    texts = [None, "", "123 ++ ²", "a", "é" * 5000, "the cat"]
    df = spark.createDataFrame(
        [(i if i != 3 else None, t, None if i == 2 else "en", 1, 0.0) for i, t in enumerate(texts)] + [(5, "the cat", "en", 1, 0.0)],
        "doc_id bigint, text string, lang string, held_out int, score double")
    out = L.identify(df).collect()
    assert len(out) == 7
    by = [(r.doc_id, r.lang_pred) for r in out]
    assert [b for b in by if b[1] == "und"] == [(0, "und"), (1, "und"), (2, "und")]
    assert all(r.score == 0 for r in out if r.lang_pred == "und")
    nolabel = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(nolabel).collect()} == {"und"}
    assert L.identify(df.limit(0)).collect() == []


def test_model_survives_pickling():
    net = pickle.loads(pickle.dumps(L.ByteNet(["x"])))
    assert L.Applied(net).predict([b"abc"])[0][0] == "x"
