"""Repeated passages by paragraph MinHash banding.

A passage that documents share often stands in the middle of other text, so
paragraphs are cut by content, not by line ends: a word is a cut if the hash
of it and its successor is the smallest within ``RADIUS`` words on both
sides. Copies of a passage are cut alike wherever they stand; 50 words hold
several whole paragraphs (13 words each on average).

1. Every paragraph's MinHash over its word shingles gives the keys of its
   bands, as few bands as reach the recall asked for at the threshold. A
   first pass counts the keys of the whole corpus.
2. Keys of one paragraph only are of no use. A second pass stores the
   paragraphs that hold a key of several. If these keys are too many to go to
   every task, a filter of bounded size goes there; it lets all of them
   through and a few others, which find no partner later.
3. Paragraphs of equal words become one class. Classes that share a key are
   joined there and verified by the exact Jaccard similarity of their
   shingles; a key with many classes is split over several tasks, and each
   task passes on a spanning star only.
4. Components of classes are clusters; all but the first place of each
   cluster can be removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Store, components, small_batches, stars, text_bytes, whole_runs, with_component
from .licenses import words_of

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.99
RADIUS = 6
# Passages (runs of repeated paragraphs) of fewer words are not reported.
MIN_WORDS = 16
# Classes of one key that a task compares with all others of the key.
SALT_ROWS = 2_000
# Bytes of shared keys (8 each), or of a filter of them, that may pass the driver and go to every task.
KEY_BYTES = 64 << 20
# Bytes of the filter that are made by one group of keys; most bits that a key sets there.
SEGMENT = 1 << 16
MOST_HASHES = 8

_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD],
                dtype=np.uint64)


def tune(threshold: float = THRESHOLD, recall: float = RECALL, most_rows: int = 8) -> tuple[int, int]:
    """(bands, rows): the fewest bands by which a pair at the threshold shares
    a band with the probability asked for; then as many rows as still do."""
    best = None
    for rows in range(1, most_rows + 1):
        bands = 1
        while 1 - (1 - threshold**rows) ** bands < recall:
            bands += 1
        if best is None or bands <= best[0]:
            best = (bands, rows)
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[4]
    return x ^ (x >> np.uint64(29))


def _odd(k: int) -> np.uint64:
    return np.uint64((int(_ODD[k % 5]) * (2 * k + 1)) & 0xFFFFFFFFFFFFFFFF)


class Paragraphs:
    """The paragraphs of some texts: owner, start and end (words of the
    text), keys (one row a band), and what they are made of."""

    def __init__(self, shingle: int, bands: int, rows: int):
        self.shingle, self.bands, self.rows = shingle, bands, rows

    def cut(self, pieces: list[tuple[int, list[bytes], int, int, bool]]):
        """``pieces``: (owner, words, number of the first word, place of the
        open paragraph, is the text's last). Returns per paragraph owner,
        start, end, keys, shingle hashes, words; and each piece's last cut."""
        number: dict[bytes, int] = {}
        ids, begin, at = [], [], RADIUS
        pad = np.full(RADIUS + self.shingle, -1, dtype=np.int64)
        ids.append(pad[:RADIUS])
        for _, words, _, _, _ in pieces:
            begin.append(at)
            ids.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
            ids.append(pad)
            at += len(words) + len(pad)
        ids = np.concatenate(ids)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in number] + [0], dtype=np.uint64)
        h = hashes[ids]
        real = ids >= 0
        pair = _mix(h[:-1] * _ODD[0] + h[1:] * _ODD[1])
        pair = np.append(np.where(real[:-1] & real[1:], pair, _MAX), _MAX)
        low = pair.copy()
        is_cut = real.copy()
        for k in range(1, RADIUS + 1):
            is_cut[k:] &= pair[k:] < low[:-k]
            is_cut[:-k] &= pair[:-k] <= low[k:]
        is_cut &= pair < _MAX
        s, n = self.shingle, len(h) - self.shingle + 1
        sh = np.zeros(n, dtype=np.uint64)
        for k in range(s):
            sh += h[k: k + n] * _odd(k)
        sh = _mix(sh)
        all_cuts = np.flatnonzero(is_cut)
        owner, first, start, end, last_cuts = [], [], [], [], []
        for (own, words, offset, lead, final), b in zip(pieces, begin):
            lo, hi = b + lead, b + len(words)
            c = all_cuts[np.searchsorted(all_cuts, lo, "right"): np.searchsorted(all_cuts, hi)]
            if not final:
                c = c[c < hi - RADIUS - 1]  # later ones don't see all that stands after them yet
            edges = np.concatenate([[lo], c, [hi] if final else []]).astype(np.int64)
            a, z = edges[:-1], edges[1:]
            long = z - a >= s
            owner.append(np.full(long.sum(), own))
            first.append(a[long])
            start.append(a[long] - b + offset)
            end.append(z[long] - b + offset)
            last_cuts.append(int(edges[-1]) - b)
        owner, first = np.concatenate(owner), np.concatenate(first)
        start, end = np.concatenate(start), np.concatenate(end)
        count = end - start - s + 1  # shingles of each
        keys = np.zeros((self.bands, len(first)), dtype=np.uint64)
        if len(first):
            # shingles of all paragraphs, one after the other
            at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            own = sh[at]
            cut_at = np.cumsum(count) - count
            for band in range(self.bands):
                for row in range(self.rows):
                    seed = np.uint64(0x51ED270B * (band * self.rows + row + 1))
                    low = np.minimum.reduceat(_mix((own + seed) * _ODD[2]), cut_at)
                    keys[band] = keys[band] * _ODD[3] + low
                keys[band] = _mix(keys[band] + np.uint64(band))
        self.first, self.ids, self.sh, self.count = first, ids, sh, count
        self.words = list(number)
        return owner, start, end, keys, last_cuts

    def shingles(self, k: int) -> np.ndarray:
        return np.unique(self.sh[self.first[k]: self.first[k] + self.count[k]])

    def content(self, k: int) -> bytes:
        words = self.ids[self.first[k]: self.first[k] + self.count[k] + self.shingle - 1]
        return xxhash.xxh128_digest(b" ".join(self.words[w] for w in words))


def _walk(texts: list[bytes | None], p: Paragraphs) -> Iterator[tuple]:
    """Paragraphs of the texts, the short ones together, the long ones block by block."""
    short = []
    for i, t in enumerate(texts):
        blocks = words_of(t or b"")
        words = next(blocks, [])
        more = next(blocks, None)
        if more is None:
            if words:
                short.append((i, words, 0, 0, True))
            continue
        offset, lead = 0, 0
        while words:
            *found, last = p.cut([(i, words, offset, lead, more is None)])
            yield tuple(found)
            if more is None:
                break
            keep = max(0, last[0] - RADIUS)
            lead, offset = last[0] - keep, offset + keep
            words, more = words[keep:] + more, next(blocks, None)
    if short:
        *found, _ = p.cut(short)
        yield tuple(found)


def _keys(shingle: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Paragraphs(shingle, bands, rows)
        for whole in batches:
            for b in small_batches(whole):
                for _, _, _, keys in _walk(text_bytes(b, "t"), p):
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64))], ["key"])

    return run


def _in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(values.shape, dtype=bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _bits(keys: np.ndarray, segments: int, hashes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(segment, bit in it) of every key, for each of the hashes; a key's bits lie in one segment."""
    segment = ((keys >> np.uint64(40)) % np.uint64(segments)).astype(np.int64)
    step = (keys >> np.uint64(20)) | np.uint64(1)
    for k in range(hashes):
        yield segment, ((keys + step * np.uint64(k)) % np.uint64(8 * SEGMENT)).astype(np.int64)


def _segments(segments: int, hashes: int):
    """mapInArrow over keys, those of a segment in one partition: the segments of the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for b in batches:
            for segment, bit in _bits(b.column("key").to_numpy().view(np.uint64), segments, hashes):
                for s in np.unique(segment).tolist():
                    at = bit[segment == s]
                    np.bitwise_or.at(made.setdefault(s, np.zeros(SEGMENT, np.uint8)), at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        for s, bits in made.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([bits.tobytes()])], ["segment", "bits"])

    return run


def _in_filter(values: np.ndarray, bits: np.ndarray, hashes: int) -> np.ndarray:
    found = np.ones(values.shape, dtype=bool)
    for segment, bit in _bits(values, len(bits) // SEGMENT, hashes):
        found &= (bits[segment * SEGMENT + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1 > 0
    return found


def key_table(shared: DataFrame, key_bytes: int) -> tuple[int, np.ndarray]:
    """(0, the keys sorted) if they hold at most ``key_bytes``, else (number of hashes, filter of the keys):
    at most ``key_bytes`` (a segment at least) and 16 bits a key, every key passes it."""
    n = shared.count()
    if n * 8 <= key_bytes:
        packed = shared.mapInArrow(
            lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.column("key").to_numpy().tobytes()])], ["k"]) for b in bs),
            "k binary").collect()
        keys = np.concatenate([np.zeros(0, dtype=np.uint64), *(np.frombuffer(r["k"], dtype=np.uint64) for r in packed)])
        return 0, np.sort(keys)
    segments = max(1, min(key_bytes, 2 * n) // SEGMENT)
    hashes = max(1, min(MOST_HASHES, round(0.69 * 8 * SEGMENT * segments / n)))
    bits = np.zeros((segments, SEGMENT), dtype=np.uint8)
    dealt = shared.repartition(F.shiftrightunsigned("key", 40) % segments)
    for r in dealt.mapInArrow(_segments(segments, hashes), "segment bigint, bits binary").toLocalIterator():
        bits[r["segment"]] |= np.frombuffer(r["bits"], dtype=np.uint8)
    return hashes, bits.ravel()


def _sharing(shingle: int, bands: int, rows: int, table):
    """Paragraphs that hold a shared key (and those that the table, if a filter, lets through)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Paragraphs(shingle, bands, rows)
        hashes, shared = table.value
        row = TaskContext.get().partitionId() << 33
        for whole in batches:
            for b in small_batches(whole):
                docs = b.column("doc_id").to_pylist()
                for owner, start, end, keys in _walk(text_bytes(b, "t"), p):
                    held = _in_filter(keys, shared, hashes) if hashes else _in_sorted(keys, shared)
                    hit = np.flatnonzero(held.any(axis=0))
                    out = [(p.content(k), docs[owner[k]], row + int(owner[k]), int(start[k]), int(end[k]),
                            keys[:, k].view(np.int64).tolist(), p.shingles(k).tobytes()) for k in hit]
                    if out:
                        kinds = [pa.binary()] + [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                            ["class", "doc_id", "row", "start", "end", "keys", "shingles"],
                        )
                row += b.num_rows

    return run


def _similar(threshold: float):
    """Links between classes of one key whose shingles' Jaccard similarity suffices."""

    def links(sets: list[np.ndarray], home: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        size = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        for i in np.flatnonzero(home):
            lo, hi = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
            n = hi - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            common = np.bincount(owner[at], minlength=len(sets))
            ok = common >= threshold * (size + size[i] - common) - 1e-9
            ok[i] = False
            yield i, np.flatnonzero(ok)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["key", "part"]):
            key, part = t["key"].to_numpy(), t["part"].to_numpy()
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
            start = np.append(np.flatnonzero(new), len(key))
            home, names = t["home"].to_numpy(), t["class"]
            src, dst = [], []
            for a, z in zip(start[:-1], start[1:]):
                if z - a < 2:
                    continue
                sets = [np.frombuffer(x, dtype=np.uint64) for x in t["shingles"].slice(a, z - a).to_pylist()]
                s, d = [], []
                for i, js in links(sets, home[a:z]):
                    s.append(np.full(len(js), i))
                    d.append(js)
                if s:
                    i, j = stars(np.concatenate(s), np.concatenate(d))
                    src += [names[int(a + x)].as_py() for x in i]
                    dst += [names[int(a + x)].as_py() for x in j]
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], ["src", "dst"])

    return run


def class_links(classes: DataFrame, threshold: float) -> DataFrame:
    """Links (src, dst) between similar classes (class, keys, shingles): the
    shingles are sent to the keys of several classes only."""
    each = classes.select(F.explode("keys").alias("key"), "class")
    several = each.groupBy("key").count().where("count > 1")
    parts = several.select("key", F.ceil(F.col("count") / SALT_ROWS).cast("int").alias("parts"))
    rows = (
        each.join(parts, "key").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("home", F.pmod(F.xxhash64("class"), F.col("parts")) == F.col("part")).drop("parts")
        .join(classes.select("class", "shingles"), "class")
    )
    return (
        rows.repartition("key", "part").sortWithinPartitions("key", "part")
        .select("key", "part", "home", "class", "shingles").mapInArrow(_similar(threshold), "src binary, dst binary")
    )


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                      threshold: float = THRESHOLD, recall: float = RECALL, min_words: int = MIN_WORDS,
                      key_bytes: int = KEY_BYTES) -> DataFrame:
    """Paragraphs that documents share.

    Returns one row per place of a repeated paragraph: doc_id, start_word
    and n_words (words from 0: runs of ASCII letters, digits and signs
    beyond ASCII, case ignored), component_id (the smallest doc_id with a
    paragraph of the cluster), kept (the first place of the cluster: all
    others can be removed) and passage_words, the length of the run of
    repeated paragraphs it belongs to; runs of fewer than ``min_words``
    words are left out, and so is what only one document repeats.

    Paragraphs of fewer than ``shingle`` words are not compared; null, empty
    and word-less texts have none. Rows sharing a doc_id are one document;
    each row with a null id is one of its own, and a cluster of such rows
    only has a null component_id. An empty table gives an empty result;
    other columns are not read.
    """
    spark = docs.sparkSession
    store = Store(spark, "passages")
    bands, rows = tune(threshold, recall)
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    shared = store.put(
        src.select("t").mapInArrow(_keys(shingle, bands, rows), "key bigint").groupBy("key").count()
        .where("count > 1").select("key")
    )
    table = spark.sparkContext.broadcast(key_table(shared, key_bytes))
    store.drop(shared)
    places = store.put(src.mapInArrow(
        _sharing(shingle, bands, rows, table),
        "class binary, doc_id bigint, row bigint, start bigint, end bigint, keys array<bigint>, shingles binary"
    ))
    classes = store.put(
        places.groupBy("class").agg(F.first("keys").alias("keys"), F.first("shingles").alias("shingles")))
    found = components(store, class_links(classes, threshold))
    at = places.select("class", "doc_id", "row", "start", "end")
    at = store.put(with_component(at, found, "class", "cluster").drop("class"))
    store.drop(places)
    store.drop(classes)
    who = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row "), F.col("row")))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row", "start")
    clusters = (
        at.withColumn("who", who).groupBy("cluster")
        .agg(F.min("who").alias("a"), F.max("who").alias("b"), F.min(place).alias("first")).where("a <> b")
        .select(F.col("cluster").alias("_c"), "first")
    )
    mine = Window.partitionBy("row").orderBy("start")
    run = Window.partitionBy("row", "run")
    words = F.col("end") - F.col("start")
    return (
        at.join(clusters, at["cluster"] == clusters["_c"])
        .withColumn("gap", (F.col("start") > F.coalesce(F.lag("end").over(mine), F.lit(-1))).cast("int"))
        .withColumn("run", F.sum("gap").over(mine))
        .withColumn("passage_words", F.sum(words).over(run)).where(F.col("passage_words") >= min_words)
        .select("doc_id", F.col("start").alias("start_word"), words.alias("n_words"),
                F.col("first.doc_id").alias("component_id"),
                ((F.col("first.row") == F.col("row")) & (F.col("first.start") == F.col("start"))).alias("kept"),
                "passage_words")
    )
