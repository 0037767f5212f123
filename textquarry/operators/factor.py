"""Sparse rows assembled from a long matrix, and their leading components.

A long matrix ``(row, term, value)`` becomes one sparse row per document by
term id. ``components`` finds the leading principal components of such rows by
randomised block iteration: only products of the centred Gram matrix with a
narrow block are taken, each a pass over the stored rows, and centring is done
on the products (``XᵀX W - n m (mᵀW)``), so the rows stay sparse and no
``terms x terms`` matrix exists anywhere. What a pass sends to the tasks and
back is ``terms x block`` numbers; the terms are at most a vocabulary's cap.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .joins import checked_broadcast

# Columns of the block beyond the components asked for, and blocks of a Krylov basis:
# a deeper one needs fewer passes over the rows and holds more columns on the driver.
EXTRA = 14
DEPTH = 16
# Components found together when a share of the variance is asked for.
BLOCK = 48
# A pair counts as found when its residual is at most this part of the largest eigenvalue.
RESIDUAL = 1e-9
# Numbers of a dense block of rows that a task multiplies at a time.
DENSE = 1 << 20
SEED = 20


def sparse_rows(x: DataFrame, vocab: DataFrame, docs: DataFrame, key: str = "doc_num") -> DataFrame:
    """``(key, ids array<int>, values array<double>)``: one row per document of
    ``docs``, ids ascending; a document without terms has empty arrays.

    ``x`` is ``(key, term, value)`` with one row a cell, ``vocab`` ``(term,
    term_id)``. A document's list is as long as its distinct terms.
    """
    ids = checked_broadcast(vocab.select("term", F.col("term_id").cast("int").alias("term_id")))
    cells = F.sort_array(F.collect_list(F.struct("term_id", "value")))
    per_doc = x.join(ids, "term").groupBy(key).agg(cells.alias("_c")).select(
        key, F.col("_c.term_id").alias("ids"), F.col("_c.value").alias("values"))
    return docs.select(key).join(per_doc, key, "left").select(
        key, F.coalesce("ids", F.array().cast("array<int>")).alias("ids"),
        F.coalesce("values", F.array().cast("array<double>")).alias("values"))


def write_rows(rows: DataFrame, size: int, key: str = "doc_num") -> DataFrame:
    """Sparse rows written once to the checkpoint folder, read back with a column
    ``features`` of ``pyspark.ml`` sparse vectors beside ids and values.

    The vector type is stored as the struct it consists of, so no row passes
    through Python. What is fitted on the table reads it again after a lost
    executor instead of building it anew.
    """
    from pyspark.ml.linalg import VectorUDT

    spark = rows.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sparse-{uuid.uuid4().hex}"
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.col("ids").alias("indices"), F.col("values").alias("values"))
    out = rows.withColumn("features", vector)
    out.write.parquet(path)
    fields = [T.StructField("features", VectorUDT()) if f.name == "features" else f for f in out.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _dense_blocks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, int]]:
    """Rows of a batch as dense blocks of bounded size, with the place of each block's first row."""
    step = max(1, DENSE // max(size, 1))
    for at in range(0, batch.num_rows, step):
        b = batch.slice(at, step)
        lengths = b.column("ids").value_lengths().to_numpy(zero_copy_only=False)
        d = np.zeros((b.num_rows, size))
        d[np.repeat(np.arange(b.num_rows), lengths), b.column("ids").flatten().to_numpy(zero_copy_only=False)] = (
            b.column("values").flatten().to_numpy(zero_copy_only=False))
        yield d, at


def _summed(rows: DataFrame, size: int, one: Callable[[np.ndarray], np.ndarray], adders: int) -> np.ndarray:
    """Sum of ``one`` over all dense blocks: in each task, in ``adders`` tasks, in one task;
    one sum goes to the driver however many tasks there are."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for d, _ in _dense_blocks(b, size):
                y = one(d)
                total = y if total is None else total + y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["y"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for y in b.column("y"):
                y = np.frombuffer(y.as_buffer())
                total = y.copy() if total is None else total + y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["y"])

    parts = rows.select("ids", "values").mapInArrow(each, "y binary")
    for tasks in sorted({adders, 1}, reverse=True):
        parts = parts.repartition(tasks).mapInArrow(add, "y binary")
    return np.frombuffer(parts.collect()[0]["y"])


def _orthonormal(z: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for q in against:
            z = z - q @ (q.T @ z)
        z = np.linalg.qr(z)[0]
    return z


@dataclass
class Components:
    loadings: np.ndarray     # terms x components, unit columns
    variances: np.ndarray    # eigenvalues of the covariance (divisor n - 1)
    shares: np.ndarray       # of the total variance
    mean: np.ndarray         # of each term


def leading(product: Callable[[np.ndarray], np.ndarray], size: int, found: np.ndarray, k: int, width: int,
            seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``k`` leading eigenpairs orthogonal to the columns of ``found``, by a block
    Krylov basis restarted with its best vectors until the residuals are small."""
    rng = np.random.default_rng(seed)
    room = size - found.shape[1]
    width, k = min(width, room), min(k, room)
    w = _orthonormal(rng.standard_normal((size, width)), [found])
    top = None
    while True:
        basis, images = [w], [product(w)]
        while len(basis) < DEPTH and (left := room - sum(b.shape[1] for b in basis)):
            basis.append(_orthonormal(images[-1][:, :left], [found, *basis]))
            images.append(product(basis[-1]))
        b, g = np.concatenate(basis, axis=1), np.concatenate(images, axis=1)
        h = b.T @ g
        e, u = np.linalg.eigh((h + h.T) / 2)
        e, u = e[::-1][:width], u[:, ::-1][:, :width]
        w = b @ u
        gap = g @ u - w * e
        gap -= found @ (found.T @ gap)
        top = max(e[0], 0.0) if top is None else max(top, e[0])
        if np.linalg.norm(gap[:, :k], axis=0).max(initial=0.0) <= RESIDUAL * max(top, 1e-300) or width == room:
            return e[:k], w[:, :k]
        w = _orthonormal(w, [found])


def components(rows: DataFrame, size: int, k: int | None = 2, var_share: float | None = None,
               seed: int = SEED, centre: bool = True) -> Components | None:
    """The ``k`` leading principal components of sparse rows of ``size`` terms, or
    with ``var_share`` as many as reach that share of the variance. Without
    ``centre`` the rows are taken as they are (the right singular vectors).

    Signs are fixed so that the largest loading of each component is
    positive. Fewer come back where the rows have no more variance; without
    rows the result is None.
    """
    adders = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    n = rows.count()
    if not n:
        return None
    sums = _summed(rows, size, lambda d: np.concatenate([d.sum(axis=0), [(d * d).sum()]]), adders)
    mean = sums[:-1] / n if centre else np.zeros(size)
    total = sums[-1] - n * float(mean @ mean)

    def product(w: np.ndarray) -> np.ndarray:
        z = _summed(rows, size, lambda d: d.T @ (d @ w), adders).reshape(size, -1)
        return z - n * np.outer(mean, mean @ w)

    loadings, values = np.zeros((size, 0)), np.zeros(0)
    while loadings.shape[1] < size and total > 0:
        want = min(BLOCK, size - loadings.shape[1]) if var_share is not None else k
        e, q = leading(product, size, loadings, want, want + EXTRA, seed + loadings.shape[1])
        keep = e > 1e-12 * total
        values, loadings = np.append(values, e[keep]), np.concatenate([loadings, q[:, keep]], axis=1)
        if var_share is None or not keep.all() or values.sum() / total >= var_share:
            break
    if var_share is not None and len(values):
        k = int(np.argmax(np.append(np.cumsum(values) / total >= var_share - 1e-12, True))) + 1
        loadings, values = loadings[:, :k], values[:k]
    sign = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])]) if loadings.size else 1.0
    return Components(loadings * sign, values / max(n - 1, 1), values / total if total > 0 else values, mean)


def project(rows: DataFrame, found: Components, key: str = "doc_num") -> DataFrame:
    """``(key, pc array<double>)``: every row, centred, on the components."""
    loadings, shift = found.loadings, found.mean @ found.loadings
    size = len(found.mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, at in _dense_blocks(b, size):
                y = d @ loadings - shift
                flat = pa.array(y.reshape(-1))
                ends = pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [b.column(key).slice(at, len(y)), pa.ListArray.from_arrays(ends, flat)], [key, "pc"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "ids", "values").mapInArrow(run, f"{key} {kind}, pc array<double>")
