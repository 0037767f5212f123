"""Language identification by a byte convolutional network.

Network: byte embedding, convolutions of several widths, ReLU, max pooling
over a fixed-length window, softmax. It is trained in numpy on the driver
from a bounded sample of labelled rows and applied inside tasks to every
window of every whole text, many windows at a time.

A convolution over embedded bytes depends on at most five bytes, so the
fitted weights are folded into tables over byte pairs once per worker, and
applying the filters is three table look-ups and two additions a byte.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
EMBED = 8
# Bound of the training sample: documents a language, windows a document.
DOCS_PER_LANG = 300
WINDOWS_PER_DOC = 4
EPOCHS = 6
UND = "und"

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    m = _LETTER.search(text) if text else None
    # the class also holds numeric signs that are no letters
    return bool(m) and (m[0].isalpha() or any(map(str.isalpha, text)))


def windows_of(text: bytes, at: range | list[int]) -> np.ndarray:
    """Windows number ``at`` of a text as rows of bytes, padded with zeros."""
    out = np.zeros((len(at), WINDOW), dtype=np.uint8)
    for row, k in enumerate(at):
        part = np.frombuffer(text, dtype=np.uint8, count=-1)[k * WINDOW: (k + 1) * WINDOW]
        out[row, : len(part)] = part
    return out


class ByteNet:
    """The network; ``langs`` are the learned languages, sorted."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        n, span = FILTERS * len(WIDTHS), max(WIDTHS)
        # a filter of width w has no weights beyond its w bytes
        self.mask = np.repeat(
            np.concatenate([np.repeat(np.arange(span)[:, None] < w, FILTERS, axis=1) for w in WIDTHS], axis=1),
            EMBED, axis=0,
        ).astype(np.float32)
        self.p = {
            "emb": rng.normal(0, 0.5, (256, EMBED)),
            "conv": rng.normal(0, 0.3, (span * EMBED, n)) * self.mask,
            "bias": np.zeros(n),
            "out": rng.normal(0, 0.3, (n, len(langs))),
            "shift": np.zeros(len(langs)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 64, seed: int = 11) -> ByteNet:
        """Adam on cross entropy; some windows are cut short, as short texts are."""
        rng = np.random.default_rng(seed)
        span, p = max(WIDTHS), self.p
        mean = {k: np.zeros_like(v) for k, v in p.items()}
        var = {k: np.zeros_like(v) for k, v in p.items()}
        weight = 1 / np.maximum(np.bincount(y, minlength=len(self.langs)), 1)
        weight = weight / weight[y].mean()
        step, steps = 0, epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                pick = order[at: at + batch]
                b, yb = np.pad(x[pick], ((0, 0), (0, span - 1))), y[pick]
                short = rng.random(len(b)) < 0.35
                length = np.where(short, rng.integers(3, 80, len(b)), WINDOW)
                b[np.arange(b.shape[1])[None] >= length[:, None]] = 0
                e = p["emb"][b]
                cols = np.lib.stride_tricks.sliding_window_view(e, span, axis=1)  # batch, place, embed, span
                cols = np.ascontiguousarray(cols.transpose(0, 1, 3, 2)).reshape(len(b), WINDOW, -1)
                z = cols @ p["conv"] + p["bias"]
                place = z.argmax(axis=1)
                top = np.take_along_axis(z, place[:, None], axis=1)[:, 0]
                feat = np.maximum(top, 0)
                logit = feat @ p["out"] + p["shift"]
                prob = np.exp(logit - logit.max(axis=1, keepdims=True))
                prob /= prob.sum(axis=1, keepdims=True)
                d = prob
                d[np.arange(len(b)), yb] -= 1
                d *= weight[yb][:, None] / len(b)
                df = (d @ p["out"].T) * (top > 0)
                seen = np.take_along_axis(cols, place[:, :, None], axis=1)  # batch, filter, span*embed
                back = (df[:, :, None] * p["conv"].T[None]).reshape(len(b), -1, span, EMBED)
                at_byte = np.take_along_axis(b, (place[:, :, None] + np.arange(span)).reshape(len(b), -1), axis=1)
                g_emb = np.zeros_like(p["emb"])
                np.add.at(g_emb, at_byte.ravel(), back.reshape(-1, EMBED))
                grad = {
                    "out": feat.T @ d, "shift": d.sum(axis=0), "bias": df.sum(axis=0),
                    "conv": np.einsum("bf,bfk->kf", df, seen) * self.mask, "emb": g_emb,
                }
                step += 1
                rate = 0.01 * (1 - 0.9 * step / steps)
                for k, g in grad.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    var[k] = 0.99 * var[k] + 0.01 * g * g
                    p[k] -= (rate * mean[k] / (1 - 0.9**step) / (np.sqrt(var[k] / (1 - 0.99**step)) + 1e-8)).astype(
                        np.float32
                    )
        return self


class Applied:
    """A fitted network with its filters folded into byte-pair tables."""

    def __init__(self, net: ByteNet):
        p, n = net.p, FILTERS * len(WIDTHS)
        self.net = net
        span = max(WIDTHS)
        each = [p["emb"] @ p["conv"][i * EMBED: (i + 1) * EMBED] for i in range(span)]  # 256 x filters, by offset
        pair = np.arange(1 << 16)
        first, second = pair & 255, pair >> 8  # little-endian pairs
        self.low = (each[0][first] + each[1][second] + p["bias"]).astype(np.float32)
        self.w3, self.w5 = FILTERS, 3 * FILTERS  # filters that reach the third, fifth byte
        self.mid = np.ascontiguousarray((each[2][first] + each[3][second])[:, self.w3:], dtype=np.float32)
        self.far = np.ascontiguousarray(each[4][:, self.w5:], dtype=np.float32)
        self.n = n

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Softmax of every window (rows of WINDOW bytes)."""
        out = np.empty((len(x), self.n), dtype=np.float32)
        for at in range(0, len(x), 32):
            b = np.pad(x[at: at + 32], ((0, 0), (0, 5)))
            wide = b.astype(np.uint16)
            pair = wide[:, :-1] | (wide[:, 1:] << 8)
            z = self.low.take(pair[:, :WINDOW].ravel(), axis=0, mode="clip")
            z[:, self.w3:] += self.mid.take(pair[:, 2: 2 + WINDOW].ravel(), axis=0, mode="clip")
            z[:, self.w5:] += self.far.take(b[:, 4: 4 + WINDOW].ravel(), axis=0, mode="clip")
            out[at: at + 32] = z.reshape(len(b), WINDOW, self.n).max(axis=1)
        logit = np.maximum(out, 0) @ self.net.p["out"] + self.net.p["shift"]
        prob = np.exp(logit - logit.max(axis=1, keepdims=True))
        return prob / prob.sum(axis=1, keepdims=True)

    def predict(self, texts: list[bytes]) -> list[tuple[str, float]]:
        """(language, score) of whole texts: their windows' probabilities, averaged by length."""
        total = np.zeros((len(texts), len(self.net.langs)))
        held, owner, share = [], [], []

        def flush():
            if held:
                np.add.at(total, owner, self.probabilities(np.concatenate(held)) * np.array(share)[:, None])
                held.clear(), owner.clear(), share.clear()

        for i, t in enumerate(texts):
            count = -(-len(t) // WINDOW)
            for at in range(0, count, 512):
                ks = range(at, min(at + 512, count))
                held.append(windows_of(t, ks))
                owner += [i] * len(ks)
                share += [min(WINDOW, len(t) - k * WINDOW) / len(t) for k in ks]
                if len(owner) >= 512:
                    flush()
        flush()
        best = total.argmax(axis=1)
        return [(self.net.langs[k], float(min(1.0, total[i, k]))) for i, k in enumerate(best)]


@functools.lru_cache(maxsize=2)
def _applied(model: bytes) -> Applied:
    return Applied(pickle.loads(model))


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_lang: int,
                    windows_per_doc: int) -> tuple[np.ndarray, list[str]]:
    """Windows and languages of at most ``docs_per_lang`` documents a language
    (on average; twice as many in all at the very most), chosen by a hash of
    the id; their windows spread over the whole text."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).alias("lang")
    ).where("lang is not null and t is not null")
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return np.zeros((0, WINDOW), dtype=np.uint8), []
    hashed = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30))
    share = F.lit(0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, F.lit(int(min(1.0, docs_per_lang / n) * (1 << 30)))).otherwise(share)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in small_batches(whole):
                parts = []
                for t in text_bytes(b, "t"):
                    count = max(1, -(-len(t) // WINDOW))
                    step = max(1, count // windows_per_doc)
                    parts.append(windows_of(t, list(range(0, count, step))[:windows_per_doc]).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [b.column("h"), b.column("lang"), pa.array(parts, pa.binary())], ["h", "lang", "part"]
                )

    got = (
        rows.withColumn("h", hashed).where(F.col("h") < share).select("h", "t", "lang")
        .mapInArrow(cut, "h bigint, lang string, part binary")
        .orderBy("h", "lang", "part").limit(2 * docs_per_lang * len(counts)).collect()
    )
    x = np.concatenate([np.frombuffer(bytes(r["part"]), dtype=np.uint8).reshape(-1, WINDOW) for r in got])
    return x, [r["lang"] for r in got for _ in range(len(r["part"]) // WINDOW)]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          docs_per_lang: int = DOCS_PER_LANG, windows_per_doc: int = WINDOWS_PER_DOC) -> bytes | None:
    """A fitted network (pickled) from the labelled rows of ``docs``; None if there are none.

    The sample is bounded by ``docs_per_lang`` and ``windows_per_doc``; rows
    with a null text or language are never learned from.
    """
    x, y = training_sample(docs, id_col, text_col, lang_col, docs_per_lang, windows_per_doc)
    if not len(x):
        return None
    langs = sorted(set(y))
    code = {lang: k for k, lang in enumerate(langs)}
    net = ByteNet(langs).fit(x, np.array([code[lang] for lang in y]))
    return pickle.dumps(net)


def predict(text: Column, model: bytes | None) -> Column:
    """struct<lang, score> of a text column; ``und`` and 0 for a null text, a
    text without letters, or without a model."""

    @F.pandas_udf("lang string, score double")
    def apply(texts: pd.Series) -> pd.DataFrame:
        lang, score = np.full(len(texts), UND, dtype=object), np.zeros(len(texts))
        if model is not None:
            net = _applied(model)
            for at in range(0, len(texts), 512):
                part = texts.iloc[at: at + 512].tolist()
                sure = [i for i, t in enumerate(part) if has_letter(t)]
                for i, (name, s) in zip(sure, net.predict([part[i].encode() for i in sure])):
                    lang[at + i], score[at + i] = name, s
        return pd.DataFrame({"lang": lang, "score": score})

    return apply.asNondeterministic()(text)  # evaluated once, never copied into a filter


def held_out(id_col: str) -> Column:
    """True for the quarter of documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that may be learned from (a null id is not)."""
    return docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Language of every document.

    Returns one row per row of ``docs``: doc_id, held_out, lang_pred, score.
    The network is trained on the rows that are not held out and have a
    language; only the text is an input of a prediction. Null texts and
    texts without a letter are ``und`` with score 0; so is everything if no
    row has a language. Repeated rows each get a row; a null doc_id is
    neither held out nor learned from; other columns are not read.
    """
    model = train(learnable(docs, id_col), id_col, text_col, lang_col)
    return docs.select(
        F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
        predict(F.col(text_col).cast("string"), model).alias("_p"),
    ).select("doc_id", "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))
