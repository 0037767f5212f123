"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V of all vectors are found from
products V Q alone, with Q a narrow block of orthonormal columns:

1. One pass sums every dimension exactly. A second one stores the vectors, less
   a whole number near the mean, as blocks of small integers; every later pass
   reads these. A vector is centred (less the rest of the mean) before
   it is multiplied.
2. A pass gives XᵀXQ: each task multiplies its blocks, and the products of
   d x m numbers are added up in two steps.
3. A round applies a Chebyshev polynomial of V to Q by its three-term
   recurrence, one pass a degree. The polynomial is small on the unwanted
   part of the spectrum, from zero to the smallest Ritz value of the block,
   and grows steeply above it. QR makes the columns orthonormal again, and
   Rayleigh-Ritz turns them towards the eigenvectors.
4. The residuals |V q - e q| certify a pair. A block that converges slowly is
   widened; as wide as the space, Rayleigh-Ritz is exact, so the rounds end.

Only d x m numbers and d sums reach the driver, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Store

COMPONENTS = 8
SCALE = 1024
OFFSET = 100_000
# Columns of the block beyond the components asked for, at first.
EXTRA = 24
DEGREE = 16
# A round amplifies the first component over the last wanted one by this at most,
# else rounding in the first would drown the last.
SPREAD = 1e6
# Certified: residual of a pair against the largest eigenvalue.
RESIDUAL = 1e-14
# Attainable residual if the sums don't round better; beyond it a round that does not improve is an end.
STALLED = 1e-12
# Eigenvalues below this part of the largest can't be told from none in double precision.
RANK = 1e-11
# Vectors of a stored block.
BLOCK = 2_048
SEED = 11


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls, all of the same length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def integers(v: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 of every entry; beyond the range of a long, its end."""
    f = np.floor(v * SCALE)
    big = 2.0**62
    return np.where(np.abs(f) < big, f, 0).astype(np.int64) + np.where(
        np.abs(f) < big, 0, np.sign(f) * big).astype(np.int64) + OFFSET


def _sums(x: np.ndarray) -> list[int]:
    """Exact sums of the columns."""
    if np.abs(x).max(initial=0) < 2**40 and len(x) < 2**20:
        return [int(s) for s in x.sum(axis=0)]
    return [sum(c) for c in x.astype(object).T]


def _lengths_and_sums(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """The most frequent length of the vectors (the longest of those that tie),
    how many have it, and the exact sums of their entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}
        for b in batches:
            lists = b.column("v")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                s = _sums(integers(_matrix(lists.take(pa.array(at))))) if d else []
                n, old = held.get(int(d), (0, [0] * int(d)))
                held[int(d)] = n + len(at), [p + q for p, q in zip(old, s)]
        rows = [(d, -1, str(n)) for d, (n, _) in held.items()]
        rows += [(d, i, str(x)) for d, (_, s) in held.items() for i, x in enumerate(s)]
        d, i, x = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(d, pa.int32()), pa.array(i, pa.int32()), pa.array(x, pa.string())], ["d", "i", "x"])

    parts = vectors.mapInArrow(run, "d int, i int, x string")
    total = parts.groupBy("d", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    modal = total.where("i = -1").orderBy(F.col("x").desc(), F.col("d").desc()).limit(1).first()
    if modal is None or not modal["d"]:
        return 0, 0, []
    sums = {r["i"]: int(r["x"]) for r in total.where(F.col("d") == modal["d"]).collect()}
    return modal["d"], sums[-1], [sums[i] for i in range(modal["d"])]


def _packed(x: np.ndarray) -> tuple[bytes, int]:
    """Integers in as few bytes each as hold them all."""
    most = np.abs(x).max(initial=0)
    width = next(w for w in (2, 4, 8) if most < 1 << (8 * w - 1))
    return x.astype(f"<i{width}").tobytes(), width


def _blocks(vectors: DataFrame, d: int, base: list[int], block: int = BLOCK) -> DataFrame:
    """(id list, data, width): integers less ``base``, packed."""
    low = np.array(base, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(ids: list, rows: list):
            data, width = _packed(np.concatenate(rows))
            return pa.RecordBatch.from_arrays(
                [pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)), pa.array([data]),
                 pa.array([width], pa.int32())], ["ids", "data", "width"])

        ids, rows, n = [], [], 0
        for whole in batches:
            sizes = whole.column("v").value_lengths().to_numpy(zero_copy_only=False)
            fit = whole.take(pa.array(np.flatnonzero(sizes == d)))
            for at in range(0, fit.num_rows, block):
                b = fit.slice(at, block)
                ids.append(b.column("id"))
                rows.append(integers(_matrix(b.column("v"))) - low)
                n += b.num_rows
                if n >= block:
                    yield out(ids, rows)
                    ids, rows, n = [], [], 0
        if n:
            yield out(ids, rows)

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"ids array<{kind}>, data binary, width int")


def _unpack(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    for data, width in zip(batch.column("data"), batch.column("width").to_pylist()):
        yield np.frombuffer(data.as_buffer(), dtype=f"<i{width}").reshape(-1, d)


def summed(blocks: DataFrame, one: Callable[[np.ndarray], np.ndarray], d: int, adders: int) -> np.ndarray:
    """Sum of ``one(x)`` over the stored blocks x: in each task, then in ``adders``
    tasks, then on the driver."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in _unpack(b, d):
                y = one(x)
                total = y if total is None else total + y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["y"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for y in b.column("y"):
                v = np.frombuffer(y.as_buffer())
                total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["y"])

    rows = blocks.mapInArrow(each, "y binary").repartition(adders).mapInArrow(add, "y binary").collect()
    return np.sum([np.frombuffer(r["y"]) for r in rows], axis=0)


def filtered(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, cut: float,
             degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V that lies within 1 on [0, cut], applied to
    q by its recurrence; ``vq`` is V q, so the first degree needs no pass."""
    half = cut / 2
    before, now = q, (vq - half * q) / half
    for _ in range(degree - 1):
        before, now = now, 2 / half * (product(now) - half * now) - before
    return now


def _growth(x: float, cut: float, degree: int) -> float:
    """The polynomial's value at an eigenvalue x."""
    t = 2 * x / cut - 1
    return math.cosh(min(degree * math.acosh(t), 700.0)) if t > 1 else 1.0


def leading(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, extra: int = EXTRA, degree: int = DEGREE,
            seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of V, falling, their unit vectors (columns)
    and the residual |V q - e q| of each, by products with V only."""
    rng = np.random.default_rng(seed)
    m = min(d, k + extra)
    k = min(k, d)
    q = np.linalg.qr(rng.standard_normal((d, m)))[0]
    worst = []
    while True:
        vq = product(q)
        h = q.T @ vq
        e, u = np.linalg.eigh((h + h.T) / 2)
        e, u = e[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        residual = np.linalg.norm(vq - q * e, axis=0)
        top = max(e[0], 0.0)
        worst.append(float(residual[:k].max()))
        done = worst[-1] <= RESIDUAL * top
        if len(worst) > 2 and worst[-1] <= STALLED * top and worst[-1] > 0.5 * worst[-3]:
            done = True  # as small as rounding lets it be
        if done or m == d:
            return np.maximum(e[:k], 0.0), q[:, :k], residual[:k]
        if len(worst) > 3 and worst[-1] > 0.1 * worst[-3]:  # slow: widen the block
            more = min(d, 2 * m) - m
            fresh = rng.standard_normal((d, more))
            q = np.linalg.qr(np.concatenate([q, fresh], axis=1))[0]
            m += more
            worst = []
            continue
        cut = float(e[-1])
        if cut <= RANK * top:  # nothing unwanted is left that is larger than rounding
            q = np.linalg.qr(vq)[0]
            continue
        p = degree
        while p > 1 and _growth(e[0], cut, p) > SPREAD * _growth(e[k - 1], cut, p):
            p -= 1
        q = np.linalg.qr(filtered(product, q, vq, cut, p))[0]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """The leading whitened components of every vector.

    Every entry c becomes the whole number x = floor(1024 c) + 100000; V is
    the covariance of x over all vectors, with divisor n. Returns per vector
    and component: vec_id, component (from 1, by falling eigenvalue e), n
    (vectors), deviation (sum over the dimensions of (n x - S)^2, with the sums
    S; exact, null beyond the range of a long), whitened ((x - S/n) on the
    component, over the square root of e), explained (e over the trace of V),
    identity_error (largest entry of the covariance of whitened minus the
    identity), residual (|V q - e q| / e of the component).

    Vectors that are null or hold null or non-finite entries are dropped, and so are
    those of another length than the most frequent one (the longest of those that
    tie; empty vectors have no entries to whiten). Repeated rows and null ids
    each get their rows. Components whose eigenvalue is zero, as all are
    for one vector or equal ones, have no whitened value and no rows; with fewer
    dimensions than components there are as many as dimensions. Equal
    eigenvalues leave their vectors open within their space. An empty table gives
    an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    src = vectors.where(v.isNotNull() & ~odd).select(F.col(id_col).alias("id"), v.alias("v"))
    d, n, sums = _lengths_and_sums(src)
    kind = src.schema["id"].dataType
    out = "vec_id " + kind.simpleString() + (
        ", component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, "
        "residual double")
    if not n:
        return spark.createDataFrame([], out)
    base = [s // n for s in sums]
    rest = np.array([s - n * b for s, b in zip(sums, base)], dtype=np.int64)  # n (x - base) - rest = n x - S
    mean = np.array([(s - n * b) / n for s, b in zip(sums, base)])
    blocks = Store(spark, "whitening").put(_blocks(src, d, base))
    adders = max(1, math.isqrt(blocks.rdd.getNumPartitions()))  # what reaches the driver grows with its square root

    def product(q: np.ndarray) -> np.ndarray:
        def one(x):
            c = x - mean
            return c.T @ (c @ q)

        return summed(blocks, one, d, adders).reshape(d, q.shape[1]) / n

    trace = float(summed(blocks, lambda x: np.array([((x - mean) ** 2).sum()]), d, adders)[0]) / n
    e, q, residual = leading(product, d, components)
    keep = e > RANK * max(e[0], 0.0)
    e, q, residual = e[keep], q[:, keep], residual[keep]
    if not len(e):
        return spark.createDataFrame([], out)
    turn = q / np.sqrt(e)

    def spread(x):
        w = (x - mean) @ turn
        return w.T @ w

    error = float(np.abs(summed(blocks, spread, d, adders).reshape(len(e), -1) / n - np.eye(len(e))).max())
    explained, k = e / trace, len(e)
    far = 2.0**31  # n times less is exact in a long, and so is the sum of squares of it below the next bound

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, x in zip(b.column("ids"), _unpack(b, d)):
                x = x.astype(np.int64)
                r = len(x)
                reach = (float(np.abs(x).max(initial=0)) + 1) * n
                if reach < far and reach * reach * d < 2.0**62:
                    dev = (((n * x - rest) ** 2).sum(axis=1)).tolist()
                else:  # whole numbers of any size
                    dev = [sum((n * int(a) - int(z)) ** 2 for a, z in zip(row, rest)) for row in x]
                    dev = [s if s < 1 << 63 else None for s in dev]
                w = (x - mean) @ turn
                each = np.repeat(np.arange(r), k)
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)),
                    pa.array(np.full(r * k, n)), pa.array(dev, pa.int64()).take(pa.array(each)),
                    pa.array(w.reshape(-1)), pa.array(np.tile(explained, r)), pa.array(np.full(r * k, error)),
                    pa.array(np.tile(residual / e, r)),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"])

    return blocks.mapInArrow(rows, out)
