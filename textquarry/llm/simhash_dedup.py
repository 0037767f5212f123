"""SimHash near-duplicates by anchor-point covering.

Fingerprints (64 bits) within ``max_bits`` of each other are linked, and the
documents of a connected component form one group. No pair outside an
anchor's surroundings is ever compared:

* The 64 bits are cut into ``chunks`` chunks. Two fingerprints with at most
  t differing bits differ in at most t // chunks bits of some chunk.
* In each chunk the anchors are the words of a covering code: a perfect
  Hamming code of 2**r - 1 bits beside free bits, so every chunk value has
  exactly one anchor, its home, within the covering radius 1.
* A fingerprint is replicated to every anchor within covering radius plus
  chunk threshold. If x and y differ in at most t' bits of a chunk, y lies
  within 1 + t' of x's home, so the two meet there; comparing each anchor's
  home fingerprints with everything replicated to it misses no link.

Equal fingerprints are one row from the start. An anchor whose home holds
many fingerprints is salted: its home rows are split, the rows replicated to
it are copied to every part. Each task passes on at most one link per
fingerprint of an anchor (a spanning star), never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Store, components, small_batches, stars, text_bytes, whole_runs, with_component, word_blocks

SEED = 42
# Home fingerprints of an anchor that one task compares.
SALT_ROWS = 20_000
# Distinct fingerprints from which two long chunks are better than three short ones.
TWO_CHUNKS_FROM = 50_000_000
# Pairs compared at a time.
PAIRS = 1 << 20


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64-bit SimHash of a text (UTF-8): A-Z lower-cased, words without ASCII
    white space, ``shingle``-word shingles with repeats, XXH64 with seed 42;
    a bit is set if it is set in over half of the hashes. A text of fewer
    words is one shingle; a text without words (or null) has 0."""
    ones, n, tail = np.zeros(64, dtype=np.int64), 0, []
    for words in word_blocks((text or b"").lower()):
        words = tail + words
        count = len(words) - shingle + 1
        if count > 0:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            h = xxhash.xxh64_intdigest
            hashes = np.array(
                [h(joined[s:e], SEED) for s, e in zip(starts[:count].tolist(), ends[shingle - 1:].tolist())],
                dtype=np.uint64,
            )
            for at in range(0, count, 1 << 14):
                part = hashes[at: at + (1 << 14)]
                ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                    axis=0, dtype=np.int64
                )
            n += count
            tail = words[count:]
        else:
            tail = words
    if n == 0 and tail:
        n = 1
        whole = np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], dtype=np.uint64)
        ones = np.unpackbits(whole.view(np.uint8), bitorder="little").astype(np.int64)
    bits = (2 * ones > n).astype(np.uint8) if n else np.zeros(64, dtype=np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in small_batches(whole):
                fps = np.array([fingerprint(t, shingle) for t in text_bytes(b, "t")], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return src.mapInArrow(run, "doc_id bigint, fp bigint")


class CoveringCode:
    """The anchors of one chunk of ``bits`` bits: Hamming code words of
    2**r - 1 bits (r as large as fits) beside free bits; covering radius 1."""

    def __init__(self, bits: int, radius: int):
        r = (bits + 1).bit_length() - 1
        self.length = (1 << r) - 1
        # syndrome of a word: exclusive or of the numbers 1..length of its set bits
        half = np.arange(1 << 16)
        low, high = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)
        for i in range(16):
            on = (half >> i) & 1
            low ^= on * (i + 1 if i < self.length else 0)
            high ^= on * (i + 17 if i + 16 < self.length else 0)
        self.low, self.high = low, high
        masks, layer = [0], [0]
        for _ in range(radius):
            layer = sorted({m | (1 << i) for m in layer for i in range(bits) if not m >> i & 1})
            masks += layer
        self.masks = np.array(masks, dtype=np.int64)

    def syndrome(self, values: np.ndarray) -> np.ndarray:
        return self.low[values & 0xFFFF] ^ self.high[(values >> 16) & 0xFFFF]

    def anchors(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, is home) of all anchors near each value."""
        s = self.syndrome(values)
        # value ^ mask is a code word exactly if both have the same syndrome
        by_mask = self.syndrome(self.masks)
        order = np.argsort(by_mask, kind="stable")
        bounds = np.searchsorted(by_mask[order], np.arange(self.length + 2))
        n = bounds[s + 1] - bounds[s]
        row = np.repeat(np.arange(len(values)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[s], n)
        mask = self.masks[order][at]
        anchor = values[row] ^ mask
        home_mask = np.where(s == 0, 0, 1 << np.maximum(s - 1, 0))
        return row, anchor, mask == home_mask[row]


def _cuts(chunks: int) -> list[tuple[int, int]]:
    """(shift, bits) of the chunks of 64 bits."""
    at = [64 * i // chunks for i in range(chunks + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


def replicas(fps: DataFrame, max_bits: int, chunks: int) -> DataFrame:
    """(anchor, fp, home): every fingerprint at every anchor near it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = [(c, shift, bits, CoveringCode(bits, 1 + max_bits // chunks))
                 for c, (shift, bits) in enumerate(_cuts(chunks))]
        for whole in batches:
            for b in small_batches(whole, 4096 if chunks > 2 else 512):
                fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                for c, shift, bits, code in codes:
                    value = ((fp >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64)
                    row, anchor, home = code.anchors(value)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor | (c << 33)), pa.array(fp[row].view(np.int64)), pa.array(home)],
                        ["anchor", "fp", "home"],
                    )

    return fps.mapInArrow(run, "anchor bigint, fp bigint, home boolean")


def _compare(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["anchor", "part"]):
            anchor, part = t["anchor"].to_numpy(), t["part"].to_numpy()
            fp, home = t["fp"].to_numpy().view(np.uint64), t["home"].to_numpy()
            new = np.ones(len(anchor), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(anchor)))
            group = np.cumsum(new) - 1
            h = np.flatnonzero(home & (size[group] > 1))
            n = size[group[h]]
            first, total = 0, np.cumsum(n)
            while first < len(h):
                done = total[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(total, done + PAIRS, side="right")))
                hs, ns = h[first:last], n[first:last]
                first = last
                src, dst = [], []
                # one home row can face a long run: cut the run as well
                for lo in range(0, int(ns.max()), PAIRS):
                    m = np.clip(ns - lo, 0, PAIRS)
                    i = np.repeat(hs, m)
                    j = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(start[group[hs]] + lo, m)
                    near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
                    src.append(fp[i[near]])
                    dst.append(fp[j[near]])
                a, b = np.concatenate(src), np.concatenate(dst)
                a, b = stars(a.view(np.int64), b.view(np.int64))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])

    return run


def near_links(store: Store, fps: DataFrame, max_bits: int, chunks: int | None = None) -> DataFrame:
    """Links (src, dst) that connect the distinct fingerprints ``fps`` (fp)
    exactly as all pairs within ``max_bits`` would."""
    if chunks is None:
        chunks = 3 if fps.count() < TWO_CHUNKS_FROM else 2
    r = replicas(fps, max_bits, chunks)
    hot = store.put(
        replicas(fps, 0, chunks).where("home").groupBy("anchor").count().where(F.col("count") > SALT_ROWS)
        .select("anchor", F.ceil(F.col("count") / SALT_ROWS).cast("int").alias("parts"))
    )
    if hot.isEmpty():
        r = r.withColumn("part", F.lit(0))
    else:
        r = (
            r.join(hot, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("home", F.col("home") & (F.pmod(F.xxhash64("fp"), F.col("parts")) == F.col("part")))
            .drop("parts")
        )
    return (
        r.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
        .mapInArrow(_compare(max_bits), "src bigint, dst bigint")
    )


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                   max_bits: int = 3, chunks: int | None = None) -> DataFrame:
    """Near-duplicate groups of documents by SimHash.

    Returns one row per row of ``docs``: doc_id, fingerprint (16 lower-case
    hex digits), component_id (the smallest doc_id reachable by links, itself
    included). Only ``id_col`` and ``text_col`` are read, so other columns
    of any name do no harm.

    Null and word-less texts have fingerprint 0 and link like any other.
    Rows repeated or sharing a doc_id each get a row, with the component of
    their own text. Rows with a null doc_id are returned; they never give
    their id to a group, and a group of such rows only has a null
    component_id. An empty table gives an empty result.
    """
    store = Store(docs.sparkSession, "simhash")
    rows = store.put(fingerprints(docs, id_col, text_col, shingle))
    first = store.put(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    links = near_links(store, first.select("fp"), max_bits, chunks)
    groups = with_component(first, components(store, links), "fp", "group")
    lowest = groups.groupBy("group").agg(F.min("first_id").alias("component_id"))
    ids = groups.join(lowest, "group").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(ids, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
