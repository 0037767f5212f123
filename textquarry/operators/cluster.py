"""Clustering: exact k nearest neighbours and DBSCAN on low-dimensional
points by grid joins, plus ``pyspark.ml`` k-means, bisecting k-means and
PCA wrappers, per-cluster keywords and a projection sample.

Points are ``(id, x, y)`` (two coordinates, as produced by a 2-D
projection); distances are Euclidean and compared squared, so no square
root decides membership.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import checked_broadcast
from .keys import ordered_index, top_k_per_group

MAX_ROUNDS = 64
# Queries, and vectors, that meet in one task of the exact kNN at most; tasks along each side while there are fewer.
RUN_ROWS, RUNS = 32_768, 8


def _d2():
    dx = F.col("px") - F.col("qx")
    dy = F.col("py") - F.col("qy")
    return dx * dx + dy * dy


def _extent(points: DataFrame):
    r = points.agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"),
        F.min("y").alias("y0"), F.max("y").alias("y1"),
    ).first()
    return r["n"], r["x0"], r["x1"], r["y0"], r["y1"]


def _grid(points: DataFrame, s: float) -> DataFrame:
    return points.select(
        "id", "x", "y",
        F.floor(F.col("x") / F.lit(s)).alias("cx"), F.floor(F.col("y") / F.lit(s)).alias("cy"),
    )


def _block(grid: DataFrame, ring: int = 1) -> DataFrame:
    """Each point with every cell of the (2*ring+1)^2 block around its cell."""
    offs = [(dx, dy) for dx in range(-ring, ring + 1) for dy in range(-ring, ring + 1)]
    cells = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offs])
    return grid.select("id", "x", "y", "cx", "cy", F.explode(cells).alias("o")).select(
        F.col("id").alias("pid"), F.col("x").alias("px"), F.col("y").alias("py"),
        (F.col("cx") + F.col("o.dx")).alias("cx"), (F.col("cy") + F.col("o.dy")).alias("cy"),
    )


def knn(points: DataFrame, k: int = 7, salt_buckets: int = 32) -> DataFrame:
    """Exact ``k`` nearest neighbours (the point itself included, as a
    model fitted on the same points returns it): ``(id, rank, neighbor_id,
    distance)``; ties by neighbour id.

    Points are first collapsed to distinct locations with a multiplicity
    (partial aggregation), so a hot spot of identical points is one row.
    Locations are resolved on a multi-resolution grid: with cell width
    ``s`` every location within ``s`` of p lies in the 3x3 block around p's
    cell, so p is resolved once the multiplicities within ``s`` add up to
    ``k``; unresolved locations go to the next round with ``s`` doubled.
    A location's list keeps every neighbour location up to the distance
    where ``k`` points are reached (ties included) and is expanded with the
    ``k`` smallest ids of each (a salted two-phase pick, so a location
    holding a third of all points is never sorted in one task). Every point
    of a location shares the location's list.
    """
    n, x0, x1, y0, y1 = _extent(points)
    if not n:
        return points.sparkSession.createDataFrame([], "id long, rank long, neighbor_id long, distance double")
    k_eff = min(k, n)
    locs = points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("id")).checkpoint(eager=True)
    n_locs = locs.count()
    area = max((x1 - x0) * (y1 - y0), 1e-12)
    s = max(math.sqrt(area * k_eff / (2.0 * n_locs)), 1e-9)
    span = max(x1 - x0, y1 - y0, 1e-9)
    # Start finer where the data is denser than average: shrink the first
    # cell width until the fullest cell holds about 16 k locations, so a
    # dense region resolves on small blocks instead of one huge one.
    limit = 16 * k_eff
    for _ in range(8):
        fullest = _grid(locs, s).groupBy("cx", "cy").count().agg(F.max("count")).first()[0] or 0
        if fullest <= limit or s <= 1e-9:
            break
        s = max(s / math.sqrt(fullest / limit), 1e-9)
    todo = locs.select("id", "x", "y")
    done = []
    for _ in range(MAX_ROUNDS):
        last = s >= span
        q = _grid(locs, s).join(locs.select("id", "m"), "id").select(
            F.col("id").alias("nid"), F.col("x").alias("qx"), F.col("y").alias("qy"), "cx", "cy", "m"
        )
        cand = _block(_grid(todo, s)).join(q, ["cx", "cy"]).select("pid", "nid", "m", _d2().alias("d2"))
        if not last:
            cand = cand.where(F.col("d2") <= F.lit(s * s))
        # Points covered up to each distance (ties share one running sum).
        w = Window.partitionBy("pid").orderBy("d2").rangeBetween(Window.unboundedPreceding, 0)
        cum = cand.withColumn("cum", F.sum("m").over(w))
        reach = cum.where(F.col("cum") >= k_eff).groupBy("pid").agg(F.min("d2").alias("dk"))
        keep = cum.join(reach, "pid").where(F.col("d2") <= F.col("dk")).select("pid", "nid", "d2")
        done.append(keep.checkpoint(eager=True))
        todo = todo.join(reach.select(F.col("pid").alias("id")), "id", "left_anti").checkpoint(eager=True)
        if last or todo.limit(1).count() == 0:
            break
        s *= 2.0
    else:
        raise RuntimeError("knn did not resolve every location")
    loc_nn = done[0]
    for d in done[1:]:
        loc_nn = loc_nn.unionByName(d)
    # The location key is its smallest id.
    members = points.join(checked_broadcast(locs.select("x", "y", F.col("id").alias("lid"))), ["x", "y"]).select(
        "lid", "id"
    )
    return _expanded(loc_nn, members, k_eff, salt_buckets)


def _nearest_pivot(pivots):
    """mapInArrow: every vector's cell (its nearest pivot) and the distance to it."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for b in batches:
            v = np.asarray(b.column("v").flatten(), dtype=np.float64).reshape(b.num_rows, len(pivots[0]))
            d = np.stack([np.sqrt(((v - p) ** 2).sum(axis=1)) for p in pivots], axis=1)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("v"), b.column("m"), pa.array(cell.astype(np.int64)),
                 pa.array(d[np.arange(len(v)), cell])], ["id", "v", "m", "cell", "r"])

    return run


def _pack(pivots):
    """applyInPandas over a block of a cell's vectors: one row, in single precision if that
    holds them exactly, with the block's smallest distance to every pivot."""
    import numpy as np
    import pandas as pd

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(rows["v"]).astype(np.float64)
        with np.errstate(over="ignore"):
            narrow = v.astype(np.float32)
        wide = not np.array_equal(narrow, v)
        near = [np.fmin.reduce(np.sqrt(((v - p) ** 2).sum(axis=1)), initial=np.inf) for p in pivots]
        return pd.DataFrame({
            "cell": rows["cell"][:1], "part": rows["part"][:1], "n": [len(v)], "ids": [rows["id"].to_numpy().tobytes()],
            "v": [(v if wide else narrow).tobytes()], "wide": [wide], "near": [near]})

    return run


def _meetings(q_cells, q_sizes, t_cells, t_sizes, near, reach, side: int):
    """Blocks dealt to runs of ``side`` rows, cell by cell: for each block of queries its run and the
    runs of vectors it meets, for each block of vectors its run and the runs of queries. A block of
    vectors is needed by the cells of which it may hold a neighbour (``near`` within ``reach``)."""
    import numpy as np

    def dealt(cells, sizes):
        order = np.lexsort((np.arange(len(cells)), cells))
        run = np.empty(len(cells), dtype=np.int64)
        run[order] = (np.cumsum(sizes[order]) - sizes[order]) // side
        return np.unique(run, return_inverse=True)[1]

    q_run, t_run = dealt(q_cells, q_sizes), dealt(t_cells, t_sizes)
    needs = near.T <= (reach * (1 + 1e-9) + 1e-12)[:, None]  # cell, block of vectors
    by_run = np.zeros((q_run.max() + 1, len(t_cells)), dtype=bool)
    np.logical_or.at(by_run, q_run, needs[q_cells])
    by_cell = np.zeros((len(reach), t_run.max() + 1), dtype=bool)
    for run in range(t_run.max() + 1):
        by_cell[:, run] = needs[:, t_run == run].any(axis=1)
    return (q_run, [np.flatnonzero(by_cell[c]).tolist() for c in q_cells],
            t_run, [np.flatnonzero(by_run[:, t]).tolist() for t in range(len(t_cells))])


def _run_neighbours(k: int, reach, queries: int = 256, vectors: int = 2048, hits: int = 1 << 17):
    """applyInPandas over the blocks of a run of queries and of a run of vectors: each
    query's ``k`` nearest of these vectors, the smaller id first where distances are equal."""
    import numpy as np
    import pandas as pd

    def unpacked(r):
        v = np.frombuffer(r.v, np.float64 if r.wide else np.float32).astype(np.float64)
        return np.frombuffer(r.ids, np.int64), v.reshape(r.n, -1)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        targets = []
        for r in rows[~rows["query"]].itertuples():
            ids, y = unpacked(r)
            targets.append((ids, y, np.hstack([y, (y * y).sum(axis=1)[:, None]]), r.near))
        out = []
        for r in rows[rows["query"]].itertuples():
            pid, block = unpacked(r)
            mine = [t for t in targets if t[3][r.cell] <= reach[r.cell] * (1 + 1e-9) + 1e-12]
            for at in range(0, r.n, queries):
                x = block[at:at + queries]
                x2 = (x * x).sum(axis=1)
                ask = np.hstack([-2 * x, np.ones((len(x), 1))])
                best = np.full((len(x), k), np.inf)
                names = np.full((len(x), k), np.iinfo(np.int64).max)
                for ids, y, held, _ in mine:
                    for lo in range(0, len(y), vectors):
                        part = held[lo:lo + vectors]
                        rough = ask @ part.T
                        slack = 1e-12 * (x2 + part[:, -1].max())
                        bound = best[:, -1] - x2 + slack
                        if np.isinf(bound).any():
                            kk = min(k, len(part)) - 1
                            bound = np.fmin(bound, np.partition(rough, kk, axis=1)[:, kk] + 2 * slack)
                        w, t = np.nonzero(rough <= bound[:, None])
                        for j in range(0, len(w), hits):
                            who, near = w[j:j + hits], lo + t[j:j + hits]
                            d2 = ((y[near] - x[who]) ** 2).sum(axis=1)  # exact, for the few that remain
                            own = np.unique(who)
                            who = np.concatenate([np.repeat(own, k), who])
                            d2 = np.concatenate([best[own].ravel(), d2])
                            name = np.concatenate([names[own].ravel(), ids[near]])
                            order = np.lexsort((name, d2, who))
                            who, d2, name = who[order], d2[order], name[order]
                            first = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
                            rank = np.arange(len(who)) - np.repeat(first, np.diff(np.append(first, len(who))))
                            keep = rank < k
                            best[who[keep], rank[keep]], names[who[keep], rank[keep]] = d2[keep], name[keep]
                who, place = np.nonzero(best < np.inf)
                out.append((pid[at + who], names[who, place], best[who, place]))
        if not out:
            return pd.DataFrame({"pid": [], "nid": [], "d2": []})
        return pd.DataFrame(dict(zip(("pid", "nid", "d2"), map(np.concatenate, zip(*out)))))

    return run


def knn_vectors(vectors: DataFrame, k: int = 7, pivots: int = 64, query_block: int = 1024,
                vector_block: int = 8192, salt_buckets: int = 32) -> DataFrame:
    """Exact ``k`` nearest neighbours of vectors of any (one) length by
    Euclidean distance: ``(id, rank, neighbor_id, distance)`` for ``vectors``
    ``(id, v array<double>)``; the vector itself is included, ties go by
    neighbour id. Null vectors are left out.

    Distinct vectors (with a multiplicity) are dealt to the cells of a few
    pivots. From each cell's radius and the smallest pivot distances of all
    cells follows a bound on its queries' k-th distance, and by the triangle
    inequality only vectors within radius + bound of its pivot can matter;
    only blocks that hold such are sent there. A cell's queries and vectors are packed in
    blocks of bounded size, so a cell holding a third of all vectors is many
    rows; runs of blocks meet in tasks, whose short lists are merged per
    query. A vector is sent once for each run of queries, so what is shuffled
    is vectors x (runs of queries + runs of vectors).
    """
    import numpy as np

    spark = vectors.sparkSession
    locs = (
        vectors.where(F.col("v").isNotNull()).groupBy("v").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("id"))
        .select("id", "v", "m").checkpoint(eager=True)
    )
    size = locs.agg(F.count(F.lit(1)), F.sum("m")).first()
    if not size[0]:
        return spark.createDataFrame([], "id long, rank long, neighbor_id long, distance double")
    k_eff = min(k, size[1])
    count = min(pivots, max(1, math.isqrt(size[0])))
    p = np.array([r["v"] for r in locs.orderBy(F.xxhash64("id"), "id").limit(count).collect()], dtype=np.float64)
    dealt = locs.mapInArrow(
        _nearest_pivot(p), "id long, v array<double>, m long, cell long, r double"
    ).checkpoint(eager=True)
    stats = {r["cell"]: r for r in dealt.groupBy("cell").agg(
        F.max("r").alias("radius"), F.count(F.lit(1)).alias("queries")).collect()}
    closest = top_k_per_group(dealt.select("cell", "r", "m", "id"), ["cell"], [F.col("r").asc(), F.col("id").asc()], k_eff,
                              salt_buckets=salt_buckets).select("cell", "r", "m").collect()
    apart = np.sqrt(((p[:, None, :] - p[None]) ** 2).sum(axis=2))
    reach = np.full(len(p), -1.0)
    for cell, st in stats.items():
        # k vectors are surely within: radius + way to their pivot + their distance from it
        bound = sorted((st["radius"] + apart[cell, c["cell"]] + c["r"], c["m"]) for c in closest)
        seen, limit = 0, bound[-1][0]
        for d, m in bound:
            seen += m
            if seen >= k_eff:
                limit = d
                break
        reach[cell] = st["radius"] + limit
    kind = "cell long, part int, n long, ids binary, v binary, wide boolean, near array<double>"

    def packed(rows: int) -> DataFrame:
        parts = F.element_at(F.array(*[F.lit(-(-stats[c]["queries"] // rows) if c in stats else 1) for c in range(len(p))]),
                             F.col("cell").cast("int") + 1)
        part = F.pmod(F.xxhash64("id", F.lit(1)), parts).cast("int").alias("part")
        named = F.coalesce("id", F.lit(-(1 << 63))).alias("id")  # null joins with nothing later, nor does this
        return dealt.select(named, "v", "cell", part).groupBy("cell", "part").applyInPandas(_pack(p), kind).checkpoint(eager=True)

    queries, targets = packed(query_block), packed(vector_block)
    q_meta, t_meta = queries.select("cell", "part", "n").collect(), targets.select("cell", "part", "n", "near").collect()
    of = lambda meta, name: np.array([r[name] for r in meta])
    side = min(RUN_ROWS, max(vector_block, -(-size[0] // RUNS)))
    q_run, q_meets, t_run, t_meets = _meetings(of(q_meta, "cell"), of(q_meta, "n"), of(t_meta, "cell"), of(t_meta, "n"),
                                               of(t_meta, "near"), reach, side)

    def sent(packs, meta, run, meets, own, other, query):
        where = spark.createDataFrame([(r["cell"], r["part"], int(n), m) for r, n, m in zip(meta, run, meets)],
                                      f"cell long, part int, {own} int, others array<int>")
        return packs.join(F.broadcast(where), ["cell", "part"]).withColumn(other, F.explode("others")).select(
            "qr", "tr", F.lit(query).alias("query"), "cell", "n", "ids", "v", "wide", "near")

    meeting = sent(queries, q_meta, q_run, q_meets, "qr", "tr", True).unionByName(
        sent(targets, t_meta, t_run, t_meets, "tr", "qr", False))
    cand = meeting.groupBy("qr", "tr").applyInPandas(_run_neighbours(k_eff, reach), "pid long, nid long, d2 double")
    # k locations hold k points, and of equal distances those of the smallest ids come first
    loc_nn = top_k_per_group(cand, ["pid"], [F.col("d2").asc(), F.col("nid").asc()], k_eff).select("pid", "nid", "d2")
    loc_nn = loc_nn.checkpoint(eager=True)
    members = vectors.join(locs.select("v", F.col("id").alias("lid")), "v").select("lid", "id").checkpoint(eager=True)
    return _expanded(loc_nn, members, k_eff, salt_buckets)


def _expanded(loc_nn: DataFrame, members: DataFrame, k: int, salt_buckets: int) -> DataFrame:
    """Neighbour lists of locations ``(pid, nid, d2)`` as lists of their
    points ``(lid, id)``: each location's k smallest ids, k per list.

    A hot location is one key on the big side of these joins: the small
    side is broadcast when its size allows, else AQE splits the skewed key.
    """
    ids = top_k_per_group(members, ["lid"], [F.col("id").asc()], k, salt_buckets=salt_buckets, name="_r")
    lists = loc_nn.join(ids.select(F.col("lid").alias("nid"), F.col("id").alias("neighbor_id")), "nid")
    lists = top_k_per_group(lists, ["pid"], [F.col("d2").asc(), F.col("neighbor_id").asc()], k, name="rank")
    return members.join(checked_broadcast(lists.withColumnRenamed("pid", "lid")), "lid").select(
        "id", "rank", "neighbor_id", F.sqrt("d2").alias("distance")
    )


def k_distance(nn: DataFrame, j: int) -> DataFrame:
    """Distance of every point to its ``j``-th neighbour (``j=1`` is the point
    itself, ``j=2`` the nearest other point), in ascending order with a
    0-based ``position`` assigned by a range-partitioned sort."""
    d = nn.where(F.col("rank") == j).select("id", "distance")
    return ordered_index(d, ["distance", "id"], name="position")


def _boxes(core: DataFrame, h: float, level: int, side: str) -> DataFrame:
    """Bounding boxes of the core points in every part of a cell, a cell
    being cut into 4**level parts along each axis."""
    n = 4**level
    part = h / n
    sx = F.floor((F.col("x") - F.col("cx") * h) / part)
    sy = F.floor((F.col("y") - F.col("cy") * h) / part)
    return (
        core.select("cx", "cy", sx.alias("sx"), sy.alias("sy"), "x", "y").groupBy("cx", "cy", "sx", "sy")
        .agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
        .select(*[F.col(c).alias(side + c) for c in ("cx", "cy", "sx", "sy", "x0", "x1", "y0", "y1")],
                F.floor(F.col("sx") / 4).alias(f"{side}px"), F.floor(F.col("sy") / 4).alias(f"{side}py"))
    )


def _linked_cells(core: DataFrame, h: float, eps: float) -> DataFrame:
    """``(pcx, pcy, qcx, qcy)``: pairs of cells (both ways) that hold a pair
    of core points within ``eps``.

    Cells are compared by the bounding boxes of their parts, 16 to a part a
    level: boxes wholly within ``eps`` link their cells, boxes farther apart
    say nothing, and only undecided ones are cut again, until they are
    single points. So no pairs of points are listed however many two
    neighbouring cells hold.
    """
    e2 = F.lit(eps * eps)
    cells = core.select("cx", "cy").distinct()
    near = _block(cells.select(F.lit(0).alias("id"), F.lit(0).alias("x"), F.lit(0).alias("y"), "cx", "cy")
                  .withColumn("id", F.struct("cx", "cy")), 2)
    pairs = (
        near.select(F.col("pid.cx").alias("acx"), F.col("pid.cy").alias("acy"), "cx", "cy")
        .where("acx < cx OR (acx = cx AND acy < cy)").join(cells, ["cx", "cy"], "left_semi")
        .select("acx", "acy", F.col("cx").alias("bcx"), F.col("cy").alias("bcy"))
    )
    open_boxes = pairs.select(
        "acx", "acy", "bcx", "bcy", *[F.lit(0).cast("bigint").alias(c) for c in ("apx", "apy", "bpx", "bpy")])
    linked, level = [], 1
    while True:
        a, b = _boxes(core, h, level, "a"), _boxes(core, h, level, "b")
        both = open_boxes.join(a, ["acx", "acy", "apx", "apy"]).join(b, ["bcx", "bcy", "bpx", "bpy"])
        gap, span = [], []
        for c in ("x", "y"):
            gap.append(F.greatest(F.lit(0.0), F.col(f"a{c}0") - F.col(f"b{c}1"), F.col(f"b{c}0") - F.col(f"a{c}1")))
            span.append(F.greatest(F.col(f"a{c}1") - F.col(f"b{c}0"), F.col(f"b{c}1") - F.col(f"a{c}0")))
        judged = (
            both.withColumn("low", gap[0] * gap[0] + gap[1] * gap[1])
            .withColumn("high", span[0] * span[0] + span[1] * span[1])
            .where(F.col("low") <= e2)
            .select("acx", "acy", "bcx", "bcy", "asx", "asy", "bsx", "bsy", "high").checkpoint(eager=True)
        )
        sure = judged.where(F.col("high") <= e2).select("acx", "acy", "bcx", "bcy").distinct().checkpoint(eager=True)
        linked.append(sure)
        open_boxes = (
            judged.where(F.col("high") > e2).join(sure, ["acx", "acy", "bcx", "bcy"], "left_anti")
            .select("acx", "acy", "bcx", "bcy", F.col("asx").alias("apx"), F.col("asy").alias("apy"),
                    F.col("bsx").alias("bpx"), F.col("bsy").alias("bpy")).checkpoint(eager=True)
        )
        if open_boxes.isEmpty():
            break
        level += 1
    one = linked[0]
    for more in linked[1:]:
        one = one.unionByName(more)
    return one.select(F.col("acx").alias("pcx"), F.col("acy").alias("pcy"), F.col("bcx").alias("qcx"), F.col("bcy").alias("qcy")).unionByName(
        one.select(F.col("bcx").alias("pcx"), F.col("bcy").alias("pcy"), F.col("acx").alias("qcx"), F.col("acy").alias("qcy"))
    ).checkpoint(eager=True)


def dbscan(points: DataFrame, eps: float, min_pts: int, max_rounds: int = 10_000) -> DataFrame:
    """``(id, cluster, is_core)``: DBSCAN with ``distance <= eps``; a point
    counts itself; border points join the lowest-numbered neighbouring
    cluster; noise is -1. Clusters are numbered by their smallest core id.

    Grid of cell width just under ``eps / sqrt(2)``: any two points of one
    cell are within ``eps``. So a cell holding at least ``min_pts`` points
    is all core and one clique, and no pair inside it is ever enumerated
    (a hot cell with a third of all points costs one count). Only points
    of sparse cells (fewer than ``min_pts`` each) list their neighbours in
    the 5x5 block around them, which bounds that work linearly. Components
    are found on cells: two core cells are linked when a core pair across
    them is within ``eps``, found by boxes of ever smaller parts of the cells
    and not by their points; min-label propagation runs over that cell
    graph, one checkpointed round per step.
    """
    h = eps / math.sqrt(2.0) * (1.0 - 1e-9)
    e2 = F.lit(eps * eps)
    g = _grid(points, h)
    cells = g.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    g = g.join(checked_broadcast(cells), ["cx", "cy"]).checkpoint(eager=True)
    q = g.select(F.col("id").alias("nid"), F.col("x").alias("qx"), F.col("y").alias("qy"), "cx", "cy")

    # Neighbours of points in sparse cells (own cell included, self included).
    sparse = g.where(F.col("n") < min_pts)
    sp = (
        _block(sparse, 2).join(q, ["cx", "cy"]).where(_d2() <= e2)
        .select(F.col("pid").alias("id"), "nid")
    ).checkpoint(eager=True)
    core_sparse = sp.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= min_pts).select("id")
    core = g.where(F.col("n") >= min_pts).select("id").unionByName(core_sparse)
    cg = g.join(core, "id").select("id", "x", "y", "cx", "cy").checkpoint(eager=True)

    # Cell graph: a node per cell with a core point, labelled by its smallest
    # core id; an edge where a core pair across two cells is within eps.
    cell_lab = cg.groupBy("cx", "cy").agg(F.min("id").alias("lab"))
    cross = _linked_cells(cg, h, eps)
    labels = cell_lab.checkpoint(eager=True)
    # Pointer jumping: a label is a core point id, so a cell can also take
    # the label of the cell holding that point; chains shrink geometrically.
    home = cg.select(F.col("id").alias("lab"), F.col("cx").alias("jcx"), F.col("cy").alias("jcy"))
    for _ in range(max_rounds):
        nl = labels.select(F.col("cx").alias("qcx"), F.col("cy").alias("qcy"), F.col("lab").alias("nlab"))
        prop = cross.join(nl, ["qcx", "qcy"]).groupBy(F.col("pcx").alias("cx"), F.col("pcy").alias("cy")).agg(
            F.min("nlab").alias("m")
        )
        step = labels.join(prop, ["cx", "cy"], "left").select(
            "cx", "cy", F.least("lab", F.coalesce("m", "lab")).alias("lab")
        )
        jumped = step.join(home, "lab").join(
            labels.select(F.col("cx").alias("jcx"), F.col("cy").alias("jcy"), F.col("lab").alias("jlab")),
            ["jcx", "jcy"],
        )
        new = jumped.select("cx", "cy", F.least("lab", "jlab").alias("lab")).checkpoint(eager=True)
        changed = (
            new.join(labels.withColumnRenamed("lab", "old"), ["cx", "cy"])
            .where(F.col("lab") != F.col("old")).limit(1).count()
        )
        labels = new
        if changed == 0:
            break
    else:
        raise RuntimeError("dbscan label propagation did not converge")

    core_lab = cg.join(labels, ["cx", "cy"]).select("id", "lab")
    # Border points: non-core points of sparse cells with a core neighbour.
    border = (
        sp.join(core_lab.select(F.col("id").alias("nid"), F.col("lab").alias("nlab")), "nid")
        .join(core_lab.select("id"), "id", "left_anti")
        .groupBy("id").agg(F.min("nlab").alias("lab"))
    )
    lab = core_lab.withColumn("is_core", F.lit(True)).unionByName(border.withColumn("is_core", F.lit(False)))
    # Cluster numbers: rank of the component label among the labels.
    comps = ordered_index(lab.select("lab").distinct(), ["lab"], name="cluster")
    out = points.select("id").join(lab, "id", "left").join(checked_broadcast(comps), "lab", "left")
    return out.select(
        "id", F.coalesce(F.col("cluster"), F.lit(-1)).cast("bigint").alias("cluster"),
        F.coalesce(F.col("is_core"), F.lit(False)).alias("is_core"),
    )


# ------------------------------------------------------------ ML wrappers

def with_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def kmeans_elbow(df: DataFrame, features: str = "features", ks: Sequence[int] = range(2, 21, 2),
                 seed: int = 20) -> DataFrame:
    """``(k, sse)``: k-means training cost for each ``k`` (one fit per k on
    the feature column; ``df`` should be a stored table, which each fit reads
    and a lost executor reads again)."""
    from pyspark.ml.clustering import KMeans

    data = df.select(features)
    rows = []
    for k in ks:
        model = KMeans(k=k, seed=seed, featuresCol=features).fit(data)
        rows.append((int(k), float(model.summary.trainingCost)))
    return df.sparkSession.createDataFrame(rows, "k long, sse double")


def kmeans_assign(df: DataFrame, key: str, features: str = "features", k: int = 14, seed: int = 20) -> DataFrame:
    from pyspark.ml.clustering import KMeans

    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)
    return model.transform(df).select(key, F.col("cluster").cast("bigint"))


def hierarchy(df: DataFrame, key: str, features: str = "features", k: int = 8, seed: int = 42):
    """Divisive hierarchical clustering (bisecting k-means): assignments,
    and cluster sizes with centres."""
    from pyspark.ml.clustering import BisectingKMeans

    model = BisectingKMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)
    assign = model.transform(df).select(key, F.col("cluster").cast("bigint"))
    centers = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    sizes = assign.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    cdf = df.sparkSession.createDataFrame(centers, "cluster long, center array<double>")
    return assign, sizes.join(cdf, "cluster")


def pca(df: DataFrame, key: str, features: str = "features", k: int | None = 2, var_share: float | None = None):
    """Centred PCA. Returns ``(projection (key, pc array), explained
    (component, variance_share, cumulative))``. With ``var_share`` the
    number of components is the smallest reaching that share. Component
    signs are fixed so that each component's largest-magnitude loading is
    positive."""
    import numpy as np
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    mean = df.select(Summarizer.mean(F.col(features)).alias("m")).first()["m"].toArray()
    arr = vector_to_array(F.col(features))
    centred = df.select(
        key, array_to_vector(F.transform(arr, lambda v, i: v - F.element_at(F.array(*[F.lit(float(m)) for m in mean]), i + 1))).alias("cf")
    )
    dim = len(mean)
    full = PCA(k=dim if var_share is not None else k, inputCol="cf", outputCol="pc").fit(centred)
    ev = list(full.explainedVariance.toArray())
    if var_share is not None:
        cum, kk = 0.0, 0
        for v in ev:
            cum += v
            kk += 1
            if cum >= var_share - 1e-12:
                break
        k = kk
    comps = full.pc.toArray()[:, :k]
    signs = np.sign(comps[np.abs(comps).argmax(axis=0), range(k)])
    signs[signs == 0] = 1.0
    proj = full.transform(centred).select(key, F.slice(vector_to_array("pc"), 1, k).alias("pc"))
    proj = proj.select(key, F.transform("pc", lambda v, i: v * F.element_at(F.array(*[F.lit(float(s)) for s in signs]), i + 1)).alias("pc"))
    cum, rows = 0.0, []
    for i, v in enumerate(ev[:k]):
        cum += v
        rows.append((i, float(v), float(cum)))
    explained = df.sparkSession.createDataFrame(rows, "component long, variance_share double, cumulative double")
    return proj, explained


def project_sample(proj: DataFrame, labels: DataFrame, key: str, n: int = 300) -> DataFrame:
    """Label joined to the projection by key, then a deterministic sample of
    ``n`` points (ordered by a hash of the key)."""
    j = proj.join(labels, key)
    return j.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(n)


def cluster_keywords(x: DataFrame, assign: DataFrame, n_terms: int = 10) -> DataFrame:
    """``(cluster, rank, term, mean)``: mean value of each term over the
    cluster's documents (zeros included), top ``n_terms`` per cluster."""
    size = assign.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    sums = x.join(assign, "doc_num").groupBy("cluster", "term").agg(F.sum("value").alias("s"))
    means = sums.join(checked_broadcast(size), "cluster").select("cluster", "term", (F.col("s") / F.col("size")).alias("mean"))
    return top_k_per_group(
        means.withColumn("_m", F.round("mean", 9)), ["cluster"], [F.col("_m").desc(), F.col("term").asc()], n_terms,
        name="rank",
    ).drop("_m")
