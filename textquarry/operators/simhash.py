"""SimHash fingerprints over a weighted matrix and Hamming distances.

A document's fingerprint is the sign of the weighted sum of its terms' hash
bits (as +1/-1), made where the document's terms are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import checked_broadcast

WIDTH = {"md5": 128, "sha1": 160}
# Sums closer to zero than this count as an exact tie.
TIE_EPS = 1e-9


def check_hash(hashing: str) -> None:
    if hashing not in WIDTH:
        raise ValueError(f"unknown hash {hashing!r}: choose one of {sorted(WIDTH)}")


def hash_bits(term: Column, hashing: str) -> Column:
    """Bits of the term's digest as an integer, most significant first.

    MD5 is read as a little-endian integer (bit i lives in byte 15 - i/8),
    SHA-1 as a big-endian one (bit i lives in byte i/8); within a byte the
    shift is 7 - i%8. Bytes come from the hex digest.
    """
    check_hash(hashing)
    width = WIDTH[hashing]
    hexd = F.md5(term) if hashing == "md5" else F.sha1(term)
    nbytes = width // 8

    def bit(i):
        byte = (F.lit(nbytes - 1) - F.floor(i / 8)) if hashing == "md5" else F.floor(i / 8)
        pos = (byte * 2 + 1).cast("int")
        val = F.conv(hexd.substr(pos, F.lit(2)), 16, 10).cast("int")
        shift = F.pow(F.lit(2.0), F.lit(7) - F.pmod(i, F.lit(8)))
        return F.pmod(F.floor(val / shift), F.lit(2)).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), bit)


def _bit_sums(hashing: str):
    """mapInArrow: the weighted sums of the signs of every document's terms, a
    few documents at a time as the product of their weights and the signs."""
    import hashlib

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    width = WIDTH[hashing]

    def signs(terms: list[str]) -> np.ndarray:
        digests = b"".join(getattr(hashlib, hashing)(t.encode()).digest() for t in terms)
        octets = np.frombuffer(digests, dtype=np.uint8).reshape(len(terms), width // 8)
        if hashing == "md5":
            octets = octets[:, ::-1]  # read as a little-endian number
        return np.unpackbits(octets, axis=1).astype(np.float64) * 2 - 1

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                doc = pc.list_parent_indices(b.column("rows")).to_numpy(zero_copy_only=False)
                cells = pc.list_flatten(b.column("rows"))
                term = pc.struct_field(cells, "term").dictionary_encode()
                weights = np.zeros((b.num_rows, len(term.dictionary)))
                value = pc.struct_field(cells, "value").to_numpy(zero_copy_only=False)
                np.add.at(weights, (doc, term.indices.to_numpy(zero_copy_only=False)), value)
                sums = weights @ signs(term.dictionary.to_pylist())
                ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_num"), pa.ListArray.from_arrays(ends, pa.array(sums.ravel()))], ["doc_num", "sums"])

    return run


def simhash(x: DataFrame, docs: DataFrame, vocab: DataFrame, hashing: str) -> DataFrame:
    """``(doc_num, fp)``: bit i is 1 when the weighted sum is positive, 0 when
    negative, and ``i % 2`` on a tie (so a document with no term gets the
    alternating pattern). Terms outside ``vocab`` don't count.

    Only a document's terms and weights are shuffled; their hash bits are
    made and summed where the document then is."""
    check_hash(hashing)
    width = WIDTH[hashing]
    kind = docs.schema["doc_num"].dataType.simpleString()
    sums = (
        x.join(checked_broadcast(vocab.select("term")), "term", "left_semi")
        .groupBy("doc_num").agg(F.collect_list(F.struct("term", "value")).alias("rows"))
        .mapInArrow(_bit_sums(hashing), f"doc_num {kind}, sums array<double>")
    )
    filled = docs.select("doc_num").join(sums, "doc_num", "left").select(
        "doc_num", F.coalesce(F.col("sums"), F.array_repeat(F.lit(0.0), width)).alias("sums")
    )

    def bit(s, i):
        return (
            F.when(s > F.lit(TIE_EPS), F.lit(1))
            .when(s < F.lit(-TIE_EPS), F.lit(0))
            .otherwise(F.pmod(i, F.lit(2)))
        )

    return filled.select("doc_num", F.transform("sums", bit).alias("fp"))


def hamming_to_target(fp: DataFrame, target) -> DataFrame:
    """``(doc_num, sig_hamming_distance)`` against the target fingerprint
    (one row of at most 160 bits, read on the driver)."""
    row = fp.where(F.col("doc_num") == F.lit(target)).select("fp").first()
    if row is None:
        raise ValueError(f"target document {target} not found")
    t = F.array(*[F.lit(int(b)) for b in row["fp"]])
    diff = F.aggregate(F.zip_with("fp", t, lambda a, b: F.when(a != b, 1).otherwise(0)), F.lit(0), lambda acc, v: acc + v)
    return fp.select("doc_num", diff.cast("bigint").alias("sig_hamming_distance"))


def choose_hash(corr_md5, corr_sha1) -> str:
    """MD5 only when its correlation is strictly lower; NaN/None -> SHA-1."""
    if corr_md5 is None or corr_sha1 is None:
        return "sha1"
    return "md5" if corr_md5 < corr_sha1 else "sha1"
