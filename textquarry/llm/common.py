"""Helpers shared by the operators: stored intermediates, connected
components, and walking over Arrow batches inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.session import ensure_checkpoint_dir

# Bytes of text taken into Python lists at a time.
BLOCK_BYTES = 1 << 20


class Store:
    """Parquet tables in the shared checkpoint folder, to cut lineage.

    A job that loses an executor reads them again instead of recomputing
    what led to them; ``drop`` deletes one that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        self.n = 0

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{self.n}"
        self.n += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.paths.pop(id(df), None)
        if path:
            jvm = self.spark._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def components(store: Store, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (columns src, dst) as (node, component).

    ``component`` is the smallest node reachable; nodes without an edge to
    another node are absent. Alternates large-star and small-star steps
    until the edge set is a forest of stars; every step is a partially
    aggregated minimum and a join that AQE may split at a hub, so no node's
    neighbours are gathered anywhere.
    """
    e = store.put(
        edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct()
    )
    before = None
    while True:
        sym = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low2.select("u", F.col("m").alias("v"))).distinct()
        )
        nxt = store.put(small)
        store.drop(e)
        e = nxt
        state = e.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u"),
        ).first()
        if before == tuple(state):
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = tuple(state)


def with_component(nodes: DataFrame, found: DataFrame, key: str, name: str) -> DataFrame:
    """``nodes`` with the component of ``key``; a node without links is its own."""
    f = found.select(F.col("node").alias("_node"), F.col("component").alias("_comp"))
    return (
        nodes.join(f, F.col(key) == F.col("_node"), "left")
        .withColumn(name, F.coalesce("_comp", key)).drop("_node", "_comp")
    )


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a[i]-b[i] reduced to one link (node, smallest of its group) per node."""
    if not len(a):
        return a, b
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = inv[: len(a)], inv[len(a):]
    label = np.arange(len(nodes))
    while True:
        old = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(old, label):
            break
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def word_blocks(text: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words (runs without ASCII white space) of ``text``, in blocks, so
    that a very long text never becomes one list."""
    if len(text) <= size:
        yield text.split()
        return
    pos = 0
    while pos < len(text):
        end = min(pos + size, len(text))
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[pos:end].split()
        pos = end


def small_batches(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of a batch (no copies), so that lists made of it stay small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def whole_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of a sorted partition cut only where the keys change."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        if held:
            last = held[-1]
            change[0] = any(
                last.column(k)[last.num_rows - 1].as_py() != b.column(k)[0].as_py() for k in keys
            )
        cuts = np.flatnonzero(change)
        if len(cuts):
            cut = int(cuts[-1])
            if cut:
                held.append(b.slice(0, cut))
            if held:
                yield pa.Table.from_batches(held)
            held = [b.slice(cut)]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return batch.column(column).cast(pa.binary()).to_pylist()
