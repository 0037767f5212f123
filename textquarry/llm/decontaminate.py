"""Benchmark decontamination: n-gram seeds that no copy can avoid, then Smith-Waterman.

A copy that keeps the share of an item's words asked for has lost at most
``lost`` of them, so the ``kept`` ones stand in at most ``lost + 1`` runs and
one of these has ``kept // (lost + 1)`` words or more. Word n-grams of that
size (at most ``NGRAM``) are the seeds of the item, all of them. One pass over
the documents finds the places of the seeds; where the words an alignment may
reach from there (its score stays above zero) hold enough words of the item,
they are aligned with it word by word by Smith-Waterman, so edited and
paraphrased copies score by what they kept.

The items are looked up inside the tasks, in blocks of bounded size: a
larger benchmark takes more passes over the documents, not more memory.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, Store, small_batches

NGRAM = 5
THRESHOLD = 0.8
# An item's run of NGRAM + SPREAD - 1 words holds a seed, whatever else the copy lost.
SPREAD = 3
# (place, item) pairs of a text looked at together.
PAIRS = 1 << 20
# Characters of benchmark text looked up in one pass over the documents.
BLOCK_CHARS = 16_000_000

_WORD = re.compile(r"\w+")
_MATCH, _MISS, _GAP = 2, -1, -1
_UNIT = 1 << 24  # a score point; the matched words are counted below it


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-cased words of a text, in blocks cut at white space."""
    pos = 0
    while pos < len(text):
        end = min(pos + BLOCK_BYTES, len(text))
        while end < len(text) and not text[end].isspace():
            end += 1
        yield _WORD.findall(text[pos:end].lower())
        pos = end


def need(length: int, threshold: float) -> int:
    """Words of an item that a copy must keep."""
    return math.ceil(threshold * length - 1e-9)


def gram_size(length: int, n: int, threshold: float) -> int:
    """Size of an item's seeds: a run so long is left in every copy, as the
    words kept stand in at most one run more than words are lost."""
    kept = need(length, threshold)
    return max(1, min(n, kept // (length - kept + 1)))


class Items:
    """A block of test items: word numbers, n-gram hashes and where they occur."""

    def __init__(self, rows: list[tuple], n: int, threshold: float):
        self.vocab: dict[str, int] = {}
        self.keys, self.words = [], []
        for key, text in rows:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for ws in words_of(text or "") for w in ws]
            if ids:
                self.keys.append(key)
                self.words.append(np.array(ids, dtype=np.int32))
        self.length = np.array([len(w) for w in self.words], dtype=np.int64)
        self.need = np.array([need(len(w), threshold) for w in self.words], dtype=np.int64)
        self.size = np.array([gram_size(len(w), n, threshold) for w in self.words], dtype=np.int64)
        self.unique = [np.unique(w, return_counts=True) for w in self.words]
        self.sizes = sorted(set(self.size.tolist()))
        rng = np.random.default_rng(5)
        self.mix = rng.integers(1, 1 << 63, len(self.vocab) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.odd = rng.integers(1, 1 << 63, n + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        item, pos, gram = [], [], []
        for i, w in enumerate(self.words):
            g = self.grams(w, int(self.size[i]))
            item.append(np.full(len(g), i))
            pos.append(np.arange(len(g)))
            gram.append(g)
        empty = [np.zeros(0, dtype=np.int64)]
        item, pos = np.concatenate(item or empty), np.concatenate(pos or empty)
        gram = np.concatenate(gram or [np.zeros(0, dtype=np.uint64)])
        order = np.argsort(gram, kind="stable")
        self.sorted, first = np.unique(gram[order], return_index=True)
        self.item, self.first = item[order], np.append(first, len(order))
        # An alignment's score stays above zero before and behind an n-gram: a
        # matched word (2) pays for at most two extra ones.
        off, size = pos[order], self.size[self.item]
        self.left = 3 * off
        self.right = size + 3 * (self.length[self.item] - off - size)

    def grams(self, ids: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n words from every place on."""
        count = len(ids) - n + 1
        h = np.zeros(max(0, count), dtype=np.uint64)
        if count > 0:
            m = self.mix[ids]
            for k in range(n):
                h += m[k: k + count] * self.odd[k]
                h ^= h >> np.uint64(29)
        return h

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, n-gram's number) of the n-grams of the items in a text."""
        place, number = [], []
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        for n in self.sizes:
            if len(ids) < n:
                continue
            at = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(at):
                continue
            h = np.zeros(len(at), dtype=np.uint64)
            for k in range(n):
                h += self.mix[ids[at + k]] * self.odd[k]
                h ^= h >> np.uint64(29)
            found = np.searchsorted(self.sorted, h)
            found[found == len(self.sorted)] = 0
            ok = self.sorted[found] == h
            place.append(at[ok])
            number.append(found[ok])
        if not place:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        p, g = np.concatenate(place), np.concatenate(number)
        order = np.argsort(p, kind="stable")
        return p[order], g[order]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(matched words, end in text) of the best local alignment: a match
    scores 2, a replaced, missing or extra word -1. Score and matches are
    carried in one number, so memory is one row whatever the lengths."""
    j = np.arange(len(text) + 1, dtype=np.int64)
    row = np.zeros(len(text) + 1, dtype=np.int64)
    best, end = 0, 0
    for w in item:
        step = np.where(text == w, _MATCH * _UNIT + 1, _MISS * _UNIT)
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + step, row[1:] + _GAP * _UNIT)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new - j * (_GAP * _UNIT)) + j * (_GAP * _UNIT)
        top = int(new.argmax())
        if new[top] > best:
            best, end = int(new[top]), top
        row = new
    return best % _UNIT, end


def _merged(lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, int]]:
    """The union of ranges as ranges in order."""
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    cut = np.flatnonzero(np.append(True, lo[1:] > reach[:-1]))
    return zip(lo[cut].tolist(), reach[np.append(cut[1:], len(lo)) - 1].tolist())


def _passages(items: Items, w: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item, start, end) of the passages of a text that hold a seed of an
    item and, around it, as many of the item's words as a copy must keep."""
    place, gram = items.hits(w)
    if not len(place):
        return
    known = np.concatenate([[0], np.cumsum(w > 0)])
    count = items.first[gram + 1] - items.first[gram]
    done = np.cumsum(count)
    a = 0
    while a < len(place):
        z = max(a + 1, int(np.searchsorted(done, done[a] - count[a] + PAIRS, "right")))
        n = count[a:z]
        at = np.repeat(items.first[gram[a:z]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        p, item = np.repeat(place[a:z], n), items.item[at]
        a = z
        lo, hi = np.maximum(p - items.left[at], 0), np.minimum(p + items.right[at], len(w))
        ok = known[hi] - known[lo] >= items.need[item]
        item, lo, hi = item[ok], lo[ok], hi[ok]
        order = np.argsort(item, kind="stable")
        item, lo, hi = item[order], lo[order], hi[order]
        edge = np.append(np.flatnonzero(np.append(True, item[1:] != item[:-1])), len(item)) if len(item) else [0]
        for x, y in zip(edge[:-1], edge[1:]):
            i = int(item[x])
            words, times = items.unique[i]
            low, high = lo[x:y], hi[x:y]
            for s, e in _merged(low, high):
                part = w[s:e]
                at = np.minimum(np.searchsorted(words, part), len(words) - 1)
                own = words[at] == part
                if np.minimum(np.bincount(at[own], minlength=len(words)), times).sum() < items.need[i]:
                    continue
                held = np.concatenate([[0], np.cumsum(own)])
                mine = (low >= s) & (high <= e)
                mine[mine] = held[high[mine] - s] - held[low[mine] - s] >= items.need[i]
                if mine.any():
                    for b, f in _merged(low[mine], high[mine]):
                        yield i, b, f


def _aligned(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = items.vocab.get
        for whole in batches:
            for b in small_batches(whole):
                docs, keys, matched, length, last = [], [], [], [], []
                for doc, text in zip(b.column("doc_id").to_pylist(), b.column("t").to_pylist()):
                    if not text:
                        continue
                    blocks = [
                        np.fromiter(map(get, ws, repeat(0)), dtype=np.int32, count=len(ws)) for ws in words_of(text)
                    ]
                    w = blocks[0] if len(blocks) == 1 else np.concatenate(blocks)
                    for i, start, stop in _passages(items, w):
                        item, part = items.words[i], w[start:stop]
                        got, end = verbatim(item, part) or align(item, part)
                        if got >= items.need[i]:
                            docs.append(doc)
                            keys.append(items.keys[i])
                            matched.append(got)
                            length.append(len(item))
                            last.append(start + end - 1)
                if docs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs, pa.int64()), pa.array(keys, pa.int64()), pa.array(matched, pa.int64()),
                         pa.array(length, pa.int64()), pa.array(last, pa.int64())],
                        ["doc_id", "item_id", "matched", "item_words", "last_word"],
                    )

    return run


def verbatim(item: np.ndarray, text: np.ndarray) -> tuple[int, int] | None:
    """(matched words, end in text) of the first whole copy: nothing aligns better."""
    raw, want, at = text.tobytes(), item.tobytes(), -1
    while (at := raw.find(want, at + 1)) >= 0:
        if at % 4 == 0:
            return len(item), at // 4 + len(item)
    return None


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", n: int = NGRAM, threshold: float = THRESHOLD,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents that hold a test item, verbatim or edited.

    Returns one row per (doc_id, item_id) whose best alignment keeps at
    least ``threshold`` of the item's words: doc_id, item_id, item_words,
    matched, score (matched / item_words), last_word (where the alignment
    ends, in words from 0; the first such place). Case and punctuation don't
    count. Every copy that keeps so many words and is edited (words replaced,
    missing or put in) in no more places than it may lose words is found, at
    0.8 in a fifth as many places as the item has words; with words put in at
    yet more places a copy is found if a run of ``gram_size`` words is left.

    Null, empty and word-less items and texts match nothing. Repeated rows add nothing: rows
    that share an id count as one document (or item). Leaks of rows with a
    null id are returned with that null. An empty table on either side gives
    an empty result. Other columns are not read.
    """
    store = Store(docs.sparkSession, "leaks")
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    bench = benchmark.select(F.col(item_col).cast("bigint").alias("k"), F.col(item_text_col).cast("string").alias("t"))
    chars = bench.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(chars / block_chars))
    out = None
    for k in range(blocks):
        rows = bench.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == k).orderBy("k", "t").collect()
        items = Items([tuple(r) for r in rows], n, threshold)
        part = store.put(src.mapInArrow(
            _aligned(items), "doc_id bigint, item_id bigint, matched bigint, item_words bigint, last_word bigint"
        ))
        out = part if out is None else out.unionByName(part)
    best = out.groupBy("doc_id", "item_id").agg(
        F.max(F.struct(F.col("matched") / F.col("item_words"), "matched", "item_words", -F.col("last_word"))).alias("b")
    )
    return best.select(
        "doc_id", "item_id", F.col("b.item_words").alias("item_words"), F.col("b.matched").alias("matched"),
        (F.col("b.matched") / F.col("b.item_words")).alias("score"), (-F.col("b.col4")).alias("last_word"),
    )
