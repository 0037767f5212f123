"""Sharding by vector bin packing.

Documents of equal text are one group, and a group goes to one shard. Every
group is a vector of its parts of all bytes, tokens and rows; every shard
has a residual capacity in the same three dimensions, at first its even part
of each. Groups are placed from the largest down, each where the dot product
of its vector and the residual capacity is highest, which is the place that
lowers the squared distance of all shards from even the most.

The placing is a sequence, so its length must not grow with the data:

* A group of at least one ``OWN_PARTS``-th of any total is placed on its own;
  there are at most ``3 * OWN_PARTS`` of them.
* Smaller groups are dealt to bundles, by the power of two below the bytes of
  one of their documents and then by the hash of their text; a bundle is placed
  like a group. There are at most ``BUNDLES`` a power of two, and since
  those of short and of long documents differ in their vectors they can still
  even out a shard that has its rows but not its bytes.
* A group larger than a whole shard in some dimension can't stay together in
  even shards. It is cut into pieces of at most a quarter of a shard.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Store
from .mixing import word_count

SHARDS = 16
OWN_PARTS = 20_000
BUNDLES = 2_048
# Pieces to a shard's capacity of a group that is larger than a shard.
PIECES = 4

DIMENSIONS = ("bytes", "tokens", "rows")


def place(units: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each unit (a row of its parts of every total, largest first):
    where the dot product with the residual capacity is highest."""
    left = np.full((n_shards, units.shape[1]), 1.0 / n_shards)
    out = np.zeros(len(units), dtype=np.int64)
    for i, v in enumerate(units):
        s = int((left @ v).argmax())  # the lowest number of those that tie
        out[i] = s
        left[s] -= v
    return out


def _parts(rows: list, totals: list[int]) -> np.ndarray:
    """Parts of the totals; a dimension without any counts for nothing."""
    a = np.array([[r[d] for d in DIMENSIONS] for r in rows], dtype=np.float64).reshape(len(rows), len(DIMENSIONS))
    return a / np.maximum(np.array(totals, dtype=np.float64), 1.0)


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                    own_parts: int = OWN_PARTS, bundles: int = BUNDLES) -> DataFrame:
    """Shard and slot of every document under the law ``bytes``: sizes near equal.

    Returns one row per row of ``docs``: doc_id, size (UTF-8 bytes of the text
    plus 1), text_crc32 (unsigned, of the UTF-8 bytes), law, shard (from 0),
    slot (gapless from 0 in each shard), grown_shard (null: this law places
    anew when a shard is added), n_tokens (runs of anything but ASCII white
    space). Bytes, tokens and rows of the shards are all balanced.

    A null text counts as empty: size 1, CRC 0. Rows of equal text share a
    shard, whatever their ids, unless they are together larger than a shard;
    then the place of a row in the files decides its piece, so the same files
    give the same result. Null ids and repeated rows each get a slot; with
    fewer groups than shards some shards stay empty; an empty table gives an
    empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    store = Store(spark, "sharding")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = store.put(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
        F.unhex(F.md5(text.cast("binary"))).alias("key"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        word_count(text).alias("n_tokens"), F.crc32(text.cast("binary")).alias("text_crc32"),
    ))
    sums = [F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    groups = store.put(rows.groupBy("key").agg(*sums, F.first("size").alias("size")))
    totals = [int(x or 0) for x in groups.agg(*[F.sum(d) for d in DIMENSIONS]).first()]

    def part_of(d: str, total: int):
        return F.col(d) / F.lit(float(max(total, 1)))

    part = F.greatest(*[part_of(d, t) for d, t in zip(DIMENSIONS, totals)])
    own = part >= 1.0 / own_parts
    bundle = (F.floor(F.log2("size")) * bundles + F.pmod(F.xxhash64("key"), F.lit(bundles))).cast("int")
    # at most 3 * own_parts rows, and at most ``bundles`` rows a power of two
    alone = groups.where(own).withColumn("part", part).select("key", "part", *DIMENSIONS).collect()
    small = (
        groups.where(~own).groupBy(bundle.alias("bundle")).agg(*[F.sum(d).alias(d) for d in DIMENSIONS]).collect()
    )
    cut = {bytes(r["key"]): math.ceil(r["part"] * n_shards * PIECES) for r in alone if r["part"] > 1.0 / n_shards}
    piece = F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int")
    pieces = {}
    if cut:  # under n_shards groups a dimension
        listed = spark.createDataFrame([(bytearray(k), n) for k, n in cut.items()], "key binary, pieces int")
        for r in rows.join(F.broadcast(listed), "key").groupBy("key", piece.alias("piece")).agg(*sums).collect():
            pieces[bytes(r["key"]), r["piece"]] = r

    units = [((bytes(r["key"]), 0), r) for r in alone if bytes(r["key"]) not in cut]
    units += [*pieces.items(), *((r["bundle"], r) for r in small)]
    parts = _parts([r for _, r in units], totals)
    order = sorted(range(len(units)), key=lambda i: (-parts[i].max(), str(units[i][0])))
    shards = np.zeros(len(units), dtype=np.int64)
    shards[order] = place(parts[order], n_shards)
    where = {name: int(s) for (name, _), s in zip(units, shards)}
    own_table = [
        (bytearray(k), cut.get(k, 1), [where.get((k, p), 0) for p in range(cut.get(k, 1))])
        for k in (bytes(r["key"]) for r in alone)
    ]
    own_df = spark.createDataFrame(own_table, "key binary, pieces int, shards array<int>")
    bundle_df = spark.createDataFrame([(r["bundle"], where[r["bundle"]]) for r in small], "bundle int, bundle_shard int")

    placed = store.put(
        rows.withColumn("bundle", bundle).join(F.broadcast(own_df), "key", "left")
        .join(F.broadcast(bundle_df), "bundle", "left")
        .withColumn("shard", F.coalesce(F.element_at("shards", piece + 1), F.col("bundle_shard")))
        .withColumn("part", F.shiftright("row", 33))
        .select("row", "part", "doc_id", "size", "n_tokens", "text_crc32", "shard")
    )
    # A slot is the number of the shard's rows in earlier parts of the files plus
    # the place among those of its own part, so no task holds a whole shard.
    before = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).drop("n")
    within = placed.withColumn("nth", F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1)
    return within.join(before, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("nth")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "n_tokens",
    )
