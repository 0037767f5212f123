"""Token counts of documents without materialising token ids.

The pre-token is a run of text without ASCII white space: the tokenizer
never joins across white space, so a text has as many tokens as its
pre-tokens have together. The pieces of each distinct pre-token of the
corpus are counted once, with the tokenizer's own library, and joined to the
pre-token frequencies of every document.

The table of counts is joined inside the tasks while its size, which is
checked, stays below a bound; beyond it the frequencies are shuffled to the
table instead.
"""

from __future__ import annotations

import functools
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Store, small_batches, text_bytes, word_blocks

# Bytes of the table of counts (12 a pre-token) that may pass the driver and go to
# every task; the driver needs about five times as much while it is put together.
TABLE_BYTES = 72 << 20
# Pre-tokens longer than this (in bytes) are rare; each batch counts its own.
LONG = 200
# Distinct pre-tokens a task holds before it passes them on.
HELD = 400_000


@functools.lru_cache(maxsize=2)
def _tokenizer(model: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses the cores
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(model)
    t.no_padding()
    t.no_truncation()
    return t


def pieces(model: str, words: list[str]) -> np.ndarray:
    """Number of tokens of each word, without added special tokens."""
    t, out = _tokenizer(model), np.zeros(len(words), dtype=np.int64)
    for at in range(0, len(words), 4096):
        out[at: at + 4096] = [len(e) for e in t.encode_batch(words[at: at + 4096], add_special_tokens=False)]
    return out


def _hash(words: list[bytes]) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w) for w in words), dtype=np.uint64, count=len(words))


def pre_tokens(texts: DataFrame) -> DataFrame:
    """The distinct pre-tokens (word) of column t."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(words):
            return pa.RecordBatch.from_arrays([pa.array(sorted(words), pa.binary()).cast(pa.string())], ["word"])

        held: set[bytes] = set()
        for whole in batches:
            for b in small_batches(whole):
                for t in text_bytes(b, "t"):
                    for words in word_blocks(t or b""):
                        held.update(words)
                if len(held) > HELD:
                    yield out(w for w in held if len(w) <= LONG)
                    held.clear()
        yield out(w for w in held if len(w) <= LONG)

    return texts.mapInArrow(run, "word string").distinct()


def count_pieces(words: DataFrame, model: str) -> DataFrame:
    """(word, n): tokens of every distinct word, each counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = pieces(model, b.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("word"), pa.array(n)], ["word", "n"])

    return words.mapInArrow(run, "word string, n bigint")


def _packed(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The table as sorted 64-bit hashes and counts; a hash that several
    words with different counts share gets -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = _hash(b.column("word").cast(pa.binary()).to_pylist())
            n = b.column("n").to_numpy().astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([h.tobytes()]), pa.array([n.tobytes()])], ["h", "n"])

    rows = counted.mapInArrow(run, "h binary, n binary").collect()
    h = np.concatenate([np.zeros(0, dtype=np.uint64), *(np.frombuffer(r["h"], dtype=np.uint64) for r in rows)])
    n = np.concatenate([np.zeros(0, dtype=np.int32), *(np.frombuffer(r["n"], dtype=np.int32) for r in rows)])
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    first = np.append(True, h[1:] != h[:-1])[: len(h)]
    at = np.flatnonzero(first)
    if len(at) < len(h):
        low, high = np.minimum.reduceat(n, at), np.maximum.reduceat(n, at)
        h, n = h[at], np.where(low == high, low, -1).astype(np.int32)
    return h, n


def _looked_up(docs: DataFrame, model: str, table) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = table.value
        for whole in batches:
            for b in small_batches(whole, 2048):
                number: dict[bytes, int] = {}
                sums, held, owner = np.zeros(b.num_rows, dtype=np.int64), [], []
                for i, t in enumerate(text_bytes(b, "t")):
                    for words in word_blocks(t or b""):
                        if words:
                            held.append(np.fromiter((number.setdefault(w, len(number)) for w in words),
                                                    dtype=np.int32, count=len(words)))
                            owner.append(i)
                distinct = list(number)
                n = np.full(len(distinct), -1, dtype=np.int64)
                if len(hashes) and distinct:
                    h = _hash(distinct)
                    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                    n = np.where(hashes[at] == h, counts[at], -1).astype(np.int64)
                    n[[i for i, w in enumerate(distinct) if len(w) > LONG]] = -1
                own = np.flatnonzero(n < 0)  # long ones and those whose hash says nothing
                if len(own):
                    n[own] = pieces(model, [distinct[i].decode() for i in own])
                for i, ids in zip(owner, held):
                    sums[i] += n[ids].sum()
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("n_bytes"), pa.array(sums)], ["doc_id", "n_bytes", "n_tokens"]
                )

    return docs.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")


def _joined(docs: DataFrame, counted: DataFrame, model: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())]))
        for whole in batches:
            for b in small_batches(whole):
                own, freq = [], []
                for t in text_bytes(b, "t"):
                    c: Counter[bytes] = Counter()
                    for words in word_blocks(t or b""):
                        c.update(words)
                    long = [w for w in c if len(w) > LONG]
                    own.append(int(sum(n * c[w] for w, n in zip(long, pieces(model, [w.decode() for w in long])))))
                    freq.append([{"word": w.decode(), "times": n} for w, n in c.items() if len(w) <= LONG])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("n_bytes"), pa.array(own, pa.int64()), pa.array(freq, kind)],
                    ["doc_id", "n_bytes", "own", "freq"],
                )

    rows = docs.mapInArrow(
        run, "doc_id bigint, n_bytes bigint, own bigint, freq array<struct<word:string,times:bigint>>"
    ).withColumn("row", F.monotonically_increasing_id())
    each = rows.select("row", "doc_id", "n_bytes", "own", F.explode_outer("freq").alias("f"))
    each = each.select("row", "doc_id", "n_bytes", "own", F.col("f.word").alias("word"), F.col("f.times").alias("times"))
    return (
        each.join(counted, "word", "left").groupBy("row", "doc_id", "n_bytes", "own")
        .agg(F.coalesce(F.sum(F.col("times") * F.col("n")), F.lit(0)).alias("sum"))
        .select("doc_id", "n_bytes", (F.col("sum") + F.col("own")).alias("n_tokens"))
    )


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Tokens of every document under a ``tokenizers`` JSON file.

    Returns one row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens
    (without added special tokens; special strings in a text count as the
    library takes them), over_limit (n_tokens > ``limit``). A null text
    counts as empty; repeated rows and null ids each get a row; an empty
    table gives an empty result; other columns are not read. The file is
    read on the driver and travels with the tasks.

    Holds for tokenizers that split at white space and drop it, as those of
    the word-end kind do.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()
    store = Store(docs.sparkSession, "tokens")
    t = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), t.alias("t"))
    counted = store.put(count_pieces(pre_tokens(src.select("t")), model))
    sized = src.withColumn("n_bytes", F.coalesce(F.octet_length("t").cast("bigint"), F.lit(0).cast("bigint")))
    if counted.count() * 12 <= table_bytes:
        out = _looked_up(sized, model, docs.sparkSession.sparkContext.broadcast(_packed(counted)))
    else:
        out = _joined(sized, counted, model)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
