"""Alignment of two tokenizers on the same texts by pointer jumping.

Both token sequences of a text cover the same bytes. Every token points to
the token of the other side that overlaps it and reaches farthest right; one
that ends together with its partner on the other side is terminal (the A
token of the two). Doubling the pointers, for all tokens of many texts at
once, ends at the terminal token of each connected component, which
labels the group that lies between two common ends.

Words are what is aligned: where a single space stands between characters
that aren't white space both tokenizers begin a new token, so a text is the
sequence of its words and each distinct word of a task is tokenized and aligned
once. A tokenizer for which this does not hold gets whole texts as words.

How many documents link a pair of ids is counted over the corpus. Pairs of
many documents are few: their counts go to every task in a table of a bounded
number of pairs. The others meet their counts in a join, in which no
key can be frequent, as all frequent ones are in the table.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Store, small_batches

# Pairs in the table of counts that goes to every task (17 bytes each).
TABLE_PAIRS = 1 << 20
# Words whose alignment a worker holds, and characters it tokenizes at a time.
HELD = 600_000
CHUNK = 1 << 16
# Characters of a text that are taken into words at a time.
BLOCK = 1 << 20
# Pairs of which a task counts documents before it passes them on.
COUNTED = 1 << 21

_WORD_GAP = re.compile(r"(?<=\S) (?=\S)")
# Where none of these stands, every space between the ends is a gap.
_UNEVEN = ["  ", " \n", "\n ", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>$")


def _byte_level() -> dict[str, int]:
    """The byte behind each letter of a byte-level entry: printable Latin-1
    characters stand for themselves, the others for 256 and up in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoders:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, a_model: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses the cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_model)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        letters = _byte_level()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for piece, i in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in letters for c in piece)
            self.a_bytes[i] = bytes(letters[c] for c in piece) if known else piece.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE_PIECE.match(piece) if self.b.is_byte(i) else None
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        # Words are independent if no piece goes on over the gap of two and A cuts there as well.
        ahead = type(self.a.pre_tokenizer).__name__ == "ByteLevel" and self.a.normalizer is None
        pieces = [*self.a_bytes, *self.b_bytes]
        self.by_word = ahead and not any(_WORD_GAP.search(x.decode("utf-8", "replace")) for x in pieces)

    def a_ids(self, text: str) -> list[int]:
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids  # without offsets

    def words(self, text: str) -> list[str]:
        """The words of a text; no block of ``blocks`` is too long for this."""
        if not self.by_word:
            return [text]
        even = not (text[:1].isspace() or text[-1:].isspace() or any(x in text for x in _UNEVEN))
        return text.split(" ") if even else _WORD_GAP.split(text)

    def blocks(self, text: str) -> Iterator[str]:
        """A text cut between words, so that a very long one never becomes one list."""
        at = 0
        while at < len(text):
            gap = _WORD_GAP.search(text, at + BLOCK) if self.by_word and at + BLOCK < len(text) else None
            end = gap.start() if gap else len(text)
            yield text[at:end]
            at = end + 1


def pointers(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Where each token points, A's tokens first, given the ends of tokens that
    cover the same bytes: the farthest-right token that overlaps it."""
    n = len(a_end)
    over_a, over_b = np.searchsorted(b_end, a_end), np.searchsorted(a_end, b_end)
    ahead = b_end[over_a] > a_end if n else np.zeros(0, dtype=bool)
    return np.concatenate([np.where(ahead, n + over_a, np.arange(n)), over_b])


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """The terminal token of each token's component, by pointer doubling."""
    to = pointers(a_end, b_end)
    while True:
        far = to[to]
        if np.array_equal(far, to):
            return to
        to = far


class Aligned:
    """Alignment of the distinct words that a task has met."""

    def __init__(self, enc: Encoders):
        self.enc = enc
        self.ids = max(len(enc.a_bytes), len(enc.b_bytes))
        self.shown = [f"{i}{c}" for c in ",|;" for i in range(self.ids)]  # an id and what follows it
        self.clear()

    def clear(self):
        self.at: dict[str, int] = {}
        self.text: list[str] = []  # groups of the word, each ended by ;
        self.counts: list[np.ndarray] = []  # rows (n_a, n_b, n_groups, n_links, valid)
        self.pairs: list[np.ndarray] = []
        self._flat = None

    def learn(self, words: Iterable[str]) -> None:
        """Adds the words that aren't known yet."""
        new = set(words).difference(self.at)
        plain = [w for w in new if w and not (w[0].isspace() or w[-1].isspace())] if self.enc.by_word else []
        known = set(plain)
        at = size = 0
        for i, w in enumerate(plain):
            size += len(w) + 1
            if size >= CHUNK or i + 1 == len(plain):
                self._add_chunk(plain[at: i + 1])
                at, size = i + 1, 0
        for w in new:
            if w not in known:
                self._add_chunk([w])
        if new:
            self._flat = None

    def _add_chunk(self, words: list[str]) -> None:
        text = " ".join(words)
        whole = (" " + text).encode()
        a_ids, b_ids = self.enc.a_ids(" " + text), self.enc.b.encode(text)
        a, b = np.array(a_ids, dtype=np.int64), np.array(b_ids, dtype=np.int64)
        a_end, b_end = np.cumsum(self.enc.a_len[a]), np.cumsum(self.enc.b_len[b])
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        same = (
            len(a) and len(b) and a_end[-1] == b_end[-1] == len(whole)
            and b"".join(map(self.enc.a_bytes.__getitem__, a_ids)) == whole
            and b"".join(map(self.enc.b_bytes.__getitem__, b_ids)) == whole
        )
        if same and len(words) > 1:
            same = all((x[np.searchsorted(x, ends)] == ends).all() for x in (a_end, b_end))
        if not same and len(words) > 1:
            half = len(words) // 2
            self._add_chunk(words[:half])
            self._add_chunk(words[half:])
            return
        first = len(self.text)
        self.at.update(zip(words, range(first, first + len(words))))
        if not same or not words[0]:
            self.text.append("")
            self.counts.append(np.zeros((1, 5), dtype=np.int64))
            self.pairs.append(np.zeros(0, dtype=np.int64))
            return
        to = terminals(a_end, b_end)
        n = len(a)
        last = np.flatnonzero(to[:n] == np.arange(n))  # terminal tokens, one a group
        group = np.searchsorted(last, to)
        # links: the pieces of the common refinement, each of one A and one B token
        cut = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        cut = cut[np.append(True, cut[1:] != cut[:-1])]
        pair = a[np.searchsorted(a_end, cut)] << 32 | b[np.searchsorted(b_end, cut)]

        def per_word(x):
            return np.bincount(np.searchsorted(ends, x), minlength=len(words))

        n_links = per_word(cut)
        self.counts.append(np.stack(
            [per_word(a_end), per_word(b_end), per_word(a_end[last]), n_links, np.ones(len(words), dtype=np.int64)], axis=1))
        self.pairs.append(pair)
        # ids in the order group, side, place, each with what follows it
        side = np.repeat([0, 1], [n, len(b)])
        order = np.lexsort((side, group))
        g, s, ids = group[order], side[order], np.concatenate([a, b])[order]
        follow = np.full(len(ids), 2)
        follow[:-1] = np.where(g[1:] != g[:-1], 2, np.where(s[1:] != s[:-1], 1, 0))
        parts = list(map(self.shown.__getitem__, (follow * self.ids + ids).tolist()))
        word_of = np.searchsorted(ends, a_end[last])[g]
        stop = np.searchsorted(word_of, np.arange(len(words)), side="right").tolist()
        begin = 0
        for end in stop:
            self.text.append("".join(parts[begin:end]))
            begin = end

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts by word, and the pairs of word i at pairs[start[i]:start[i+1]]."""
        if self._flat is None:
            counts = np.concatenate([np.zeros((0, 5), dtype=np.int64), *self.counts])
            pairs = np.concatenate([np.zeros(0, dtype=np.int64), *self.pairs])
            self.counts, self.pairs = [counts], [pairs]
            self._flat = counts, pairs, np.append(0, np.cumsum(counts[:, 3]))
        return self._flat


@functools.lru_cache(maxsize=1)
def _held(a_model: str, b_model: bytes) -> Aligned:
    """What a worker process knows; the tasks it runs one after the other share it."""
    return Aligned(Encoders(a_model, b_model))


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of each range, one after the other."""
    step = np.ones(int(length.sum()), dtype=np.int64)
    full = np.flatnonzero(length)
    if not len(full):
        return step[:0]
    begin = np.append(0, np.cumsum(length[full])[:-1])
    step[begin] = start[full]
    step[begin[1:]] -= start[full][:-1] + length[full][:-1] - 1
    return np.cumsum(step)


def _pack(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted pairs, as steps of A's id and B's id, and their times, in as few bytes as hold them."""
    out = [np.array([len(pairs)], dtype="<u4").tobytes()]
    for x in (np.diff(pairs >> 32, prepend=0), pairs & 0xFFFFFFFF, times):
        width = next(w for w in (1, 2, 4, 8) if x.max(initial=0) < 1 << (8 * w))
        out.append(bytes([width]) + x.astype(f"<u{width}").tobytes())
    return b"".join(out)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, dtype="<u4", count=1)[0])
    at, cols = 4, []
    for _ in range(3):
        width = data[at]
        cols.append(np.frombuffer(data, dtype=f"<u{width}", count=n, offset=at + 1).astype(np.int64))
        at += 1 + n * width
    return np.cumsum(cols[0]) << 32 | cols[1], cols[2]


def _one(blocks: Iterable[list[str]], known: Aligned) -> tuple[np.ndarray, str, bytes]:
    """Counts, digest and packed pairs of a text given as blocks of words."""
    total, digest, held = np.zeros(5, dtype=np.int64), hashlib.sha256(), []
    words_seen, last = 0, ""
    for words in blocks:
        try:
            at = list(map(known.at.__getitem__, words))
        except KeyError:
            if len(known.at) > HELD:
                known.clear()
            known.learn(words)
            at = list(map(known.at.__getitem__, words))
        counts, pairs, start = known.flat()
        at_array = np.array(at)
        total += counts[at_array].sum(axis=0)
        words_seen += len(at)
        digest.update(last.encode())
        groups = "".join(map(known.text.__getitem__, at))
        digest.update(groups[:-1].encode())
        last = groups[-1:]
        held.append(np.unique(pairs[_ranges(start[at_array], counts[at_array, 3])], return_counts=True))
        if len(held) > 1:
            both = np.concatenate([p for p, _ in held])
            p, inverse = np.unique(both, return_inverse=True)
            held = [(p, np.bincount(inverse, weights=np.concatenate([t for _, t in held])).astype(np.int64))]
    if not words_seen or total[4] < words_seen:
        return np.zeros(5, dtype=np.int64), "", b""
    return total, digest.hexdigest(), _pack(*held[0])


def aligned(docs: DataFrame, a_model: str, b_model: bytes) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs) of doc_id, t."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _held(a_model, b_model)
        enc = known.enc
        for whole in batches:
            for b in small_batches(whole, 64):
                texts = b.column("t").to_pylist()
                # the words of the texts that aren't long are learned together, which takes fewer calls
                short = [enc.words(t) if t and enc.by_word and len(t) <= CHUNK else [] for t in texts]
                if len(known.at) > HELD:
                    known.clear()
                known.learn(itertools.chain.from_iterable(short))
                got = [_one([w] if w else map(enc.words, enc.blocks(t or "")), known) for w, t in zip(short, texts)]
                n = np.array([g[0] for g in got]).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays(
                    [b.column("row"), b.column("doc_id"), *(pa.array(n[:, i]) for i in range(4)),
                     pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.binary())],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])

    return docs.mapInArrow(run, "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                "groups_sha256 string, pairs binary")


def pair_documents(rows: DataFrame) -> DataFrame:
    """(pair, n): documents that hold each pair linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            p, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(p), pa.array(n.astype(np.int64))], ["pair", "n"])

        for b in batches:
            for data in b.column("pairs"):
                raw = data.as_py()
                if raw:
                    held.append(_unpacked(raw)[0])
                    size += len(held[-1])
                    if size > COUNTED:
                        yield out()
                        held, size = [], 0
        if held:
            yield out()

    return rows.select("pairs").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def _table(counted: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best")]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()]) for c in cols], ["pair", "n", "best"])

    rows = counted.mapInArrow(run, "pair binary, n binary, best binary").collect()
    kinds = {"pair": np.int64, "n": np.int64, "best": np.bool_}
    cols = [np.concatenate([np.zeros(0, dtype=t), *(np.frombuffer(r[c], dtype=t) for r in rows)]) for c, t in kinds.items()]
    order = np.argsort(cols[0])
    return tuple(c[order] for c in cols)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """Groups and links between the tokens of A (a byte-level ``tokenizers``
    JSON file, encoding space + text) and B (a ``sentencepiece`` model, which
    adds that space itself) in every document.

    Returns one row per row of ``docs``: doc_id, n_a and n_b (tokens), n_groups
    (parts between byte offsets at which tokens of both end), n_links (pairs
    of an A and a B token whose bytes overlap), n_best (links whose pair of
    ids is linked in as many documents as any pair of its A id is, ties
    included), count_sum (over the links: documents that hold the pair linked),
    groups_sha256 (of ``a1,a2|b1;a3|b2,b3``, the ids of each group). Strings
    of special tokens are ordinary text.

    A text that is null or empty, or whose tokens joined differ from space + text
    on either side (as where a tokenizer collapses white space), has no
    tokens: zeros and an empty string. Repeated rows and null ids each get a row
    and count as documents; an empty table gives an empty result. Other
    columns are not read. The files are read on the driver and travel with
    the tasks.
    """
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as f:
        a_model = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    store = Store(spark, "alignment")
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
                      F.col(text_col).cast("string").alias("t"))
    rows = store.put(aligned(src, a_model, b_model))
    counted = store.put(pair_documents(rows).withColumn("a", F.shiftright("pair", 32)))
    # one row for an A id: as many as the vocabulary has at most
    highest = F.broadcast(counted.groupBy("a").agg(F.max("n").alias("most")))
    counted = counted.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    # the smallest power of two that at most ``table_pairs`` pairs reach
    by_size = {r[0]: r[1] for r in counted.groupBy(F.floor(F.log2("n")).alias("b")).count().collect()}
    cut, above = max(by_size, default=0) + 1, 0
    while cut > 0 and above + by_size.get(cut - 1, 0) <= table_pairs:
        cut -= 1
        above += by_size.get(cut, 0)
    frequent = F.floor(F.log2("n")) >= cut
    table = spark.sparkContext.broadcast(_table(counted.where(frequent)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = table.value
        rare = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
        for whole in batches:
            for b in small_batches(whole):
                sums, bests, left = [], [], []
                for data in b.column("pairs"):
                    raw = data.as_py()
                    p, times = _unpacked(raw) if raw else (np.zeros(0, dtype=np.int64),) * 2
                    at = np.minimum(np.searchsorted(pairs, p), max(len(pairs) - 1, 0))
                    hit = pairs[at] == p if len(pairs) else np.zeros(len(p), dtype=bool)
                    sums.append(int((times[hit] * n[at[hit]]).sum()))
                    bests.append(int(times[hit][best[at[hit]]].sum()))
                    left.append([{"pair": x, "times": t} for x, t in zip(p[~hit].tolist(), times[~hit].tolist())])
                keep = [b.column(c) for c in NARROW]
                yield pa.RecordBatch.from_arrays(
                    [*keep, pa.array(sums, pa.int64()), pa.array(bests, pa.int64()), pa.array(left, rare)],
                    [*NARROW, "sum", "best_sum", "rare"])

    kinds = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in NARROW)
    met = store.put(rows.mapInArrow(
        run, f"{kinds}, sum bigint, best_sum bigint, rare array<struct<pair:bigint,times:bigint>>"))
    rest = (
        met.where(F.size("rare") > 0).select("row", F.explode("rare").alias("r"))
        .select("row", F.col("r.pair").alias("pair"), F.col("r.times").alias("times"))
        .join(counted.where(~frequent), "pair")
        .groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("more"),
                            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    )
    zero = F.lit(0).cast("bigint")
    return met.drop("rare").join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("best_sum") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("sum") + F.coalesce("more", zero)).alias("count_sum"), "groups_sha256",
    )


NARROW = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
