"""Embedding near-duplicates by HNSW graphs per shard.

Equal vectors of a label become one row first. The rows of a label are dealt
to shards of bounded size, each with a hierarchical navigable small-world
graph over its vectors. Blocks of query vectors meet every shard of their
label, several blocks with one copy of a shard: a beam search finds the surroundings of each query, from its hits the
graph is followed as long as it yields links, and every link is verified by
its cosine in double precision. Each block is audited: for a sample of its
queries the links are found by brute force as well, and while the recall is
below the target the beam is doubled and the block searched again (a beam as
wide as the shard is a full scan). Links are joined into components.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Store, components, stars, with_component

THRESHOLD = 0.93
# A search's time follows the logarithm of a graph's size, but every shard is searched: so few and large ones.
SHARD_ROWS = 32_768
BLOCK_ROWS = 1024
RUN_BLOCKS = 8  # blocks that share a copy of a shard
MOST_PARTS = 960  # partitions that graphs or searches, seconds each, are dealt to
DEGREE = 12  # links of a node; twice as many on the ground level
BUILD_BEAM = 48
BEAM = 64
AUDITED = 64  # queries of a block that are checked by brute force
RECALL = 1.0
SLACK = 0.08  # nodes this far below the threshold are still followed
PAIRS = 1 << 20


class Graph:
    """HNSW over unit vectors (single precision; links are verified elsewhere)."""

    def __init__(self, vectors: np.ndarray, seed: int = 3):
        n = len(vectors)
        self.v = vectors
        rng = np.random.default_rng(seed)
        level = (-np.log(1 - rng.random(n)) / np.log(DEGREE)).astype(int)
        self.links = [np.zeros((n, DEGREE * (2 if k == 0 else 1)), dtype=np.int32) for k in range(level.max() + 1)]
        self.size = [np.zeros(n, dtype=np.int32) for _ in self.links]
        self.seen, self.mark = np.zeros(n, dtype=np.int64), 0
        self.entry, self.top = 0, int(level[0])
        for i in range(1, n):
            self._insert(i, int(level[i]))
        # the ground level backwards: a node that others have dropped is found through its own links
        to = self.links[0][np.arange(self.links[0].shape[1]) < self.size[0][:, None]]
        order = np.argsort(to, kind="stable")
        self.sources = np.repeat(np.arange(n), self.size[0])[order]
        self.first = np.searchsorted(to[order], np.arange(n + 1))

    def near(self, i: int, level: int) -> np.ndarray:
        return self.links[level][i, : self.size[level][i]]

    def descend(self, q: np.ndarray, down_to: int) -> int:
        """Greedy steps from the top to the level above ``down_to``."""
        at, best = self.entry, float(self.v[self.entry] @ q)
        for level in range(self.top, down_to, -1):
            while True:
                nb = self.near(at, level)
                if not len(nb):
                    break
                s = self.v[nb] @ q
                k = int(s.argmax())
                if s[k] <= best:
                    break
                at, best = int(nb[k]), float(s[k])
        return at

    def beam(self, q: np.ndarray, start: int, width: int, level: int) -> list[tuple[float, int]]:
        """The best ``width`` nodes found, as (similarity, node)."""
        self.mark += 1
        mark, seen = self.mark, self.seen
        s = float(self.v[start] @ q)
        seen[start] = mark
        todo, best = [(-s, start)], [(s, start)]
        while todo:
            s, i = heapq.heappop(todo)
            if len(best) >= width and -s < best[0][0]:
                break
            nb = self.near(i, level)
            nb = nb[seen[nb] != mark]
            if not len(nb):
                continue
            seen[nb] = mark
            sims = self.v[nb] @ q
            if len(best) >= width:
                ok = sims > best[0][0]
                nb, sims = nb[ok], sims[ok]
            for j, t in zip(nb.tolist(), sims.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (t, j))
                    heapq.heappush(todo, (-t, j))
                elif t > best[0][0]:
                    heapq.heapreplace(best, (t, j))
                    heapq.heappush(todo, (-t, j))
        return best

    def _spread(self, nodes: np.ndarray, sims: np.ndarray, count: int) -> np.ndarray:
        """At most ``count`` nodes, near ones first, but rather one that is
        nearer to the centre than to those already taken."""
        order = np.argsort(-sims, kind="stable")
        nodes, sims = nodes[order], sims[order]
        if len(nodes) <= count:
            return nodes
        among = self.v[nodes] @ self.v[nodes].T
        taken, closest = [], np.full(len(nodes), -2.0)
        for k in range(len(nodes)):
            if sims[k] > closest[k]:
                taken.append(k)
                if len(taken) == count:
                    break
                closest = np.maximum(closest, among[k])
        if len(taken) < count:
            rest = np.setdiff1d(np.arange(len(nodes)), taken)
            taken += rest[: count - len(taken)].tolist()
        return nodes[taken]

    def _insert(self, i: int, level: int) -> None:
        q = self.v[i]
        at = self.descend(q, min(level, self.top))
        for k in range(min(level, self.top), -1, -1):
            found = self.beam(q, at, BUILD_BEAM, k)
            sims = np.array([s for s, _ in found])
            nodes = np.array([j for _, j in found], dtype=np.int32)
            at = int(nodes[sims.argmax()])
            mine = self._spread(nodes, sims, DEGREE)
            self.links[k][i, : len(mine)], self.size[k][i] = mine, len(mine)
            room = self.links[k].shape[1]
            for j in mine.tolist():
                m = self.size[k][j]
                if m < room:
                    self.links[k][j, m] = i
                    self.size[k][j] = m + 1
                else:
                    both = np.append(self.links[k][j], np.int32(i))
                    kept = self._spread(both, self.v[both] @ self.v[j], room)
                    self.links[k][j, : len(kept)], self.size[k][j] = kept, len(kept)
        if level > self.top:
            self.entry, self.top = i, level

    def within(self, q: np.ndarray, least: float, width: int, node: int | None = None) -> np.ndarray:
        """Nodes with similarity ``least`` or more: the beam's, and what is
        reached from them over nodes not much below. The beam starts at the
        query's own ``node`` if the graph holds it."""
        if width >= len(self.v):
            return np.flatnonzero(self.v @ q >= least)
        found = self.beam(q, self.descend(q, 0) if node is None else node, width, 0)
        edge = np.array([j for s, j in found if s >= least - SLACK], dtype=np.int32)
        hits = [np.array([j for s, j in found if s >= least], dtype=np.int32)]
        self.mark += 1
        self.seen[edge] = self.mark
        while len(edge):
            filled = np.arange(self.links[0].shape[1]) < self.size[0][edge][:, None]
            lo, n = self.first[edge], self.first[edge + 1] - self.first[edge]
            back = self.sources[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            nb = np.unique(np.concatenate([self.links[0][edge][filled], back]))
            nb = nb[self.seen[nb] != self.mark]
            self.seen[nb] = self.mark
            s = self.v[nb] @ q
            hits.append(nb[s >= least])
            edge = nb[s >= least - SLACK]
        return np.unique(np.concatenate(hits))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _wide(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """One row: the shard's keys, copies, vectors and graph."""
    rows = rows.sort_values("key", ignore_index=True)
    x = _wide(rows["vector"])
    shard = (rows["key"].to_numpy(), rows["copies"].to_numpy(), x, Graph(_unit(x)))
    return pd.DataFrame({"group": [rows["group"][0]], "shard": [rows["shard"][0]], "index": [pickle.dumps(shard)]})


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    """One row: a block of queries."""
    rows = rows.sort_values("key", ignore_index=True)
    packed = pickle.dumps((rows["key"].to_numpy(), _wide(rows["vector"])))
    return pd.DataFrame({"group": [rows["group"][0]], "block": [rows["block"][0]], "queries": [packed]})


def search_block(queries: tuple, shard: tuple, threshold: float, beam: int = BEAM,
                 recall: float = RECALL) -> tuple[list[np.ndarray], int]:
    """(links of every query as positions in the shard, beam it took): the
    beam is widened until the audited queries reach the recall."""
    keys, q = queries
    own, _, x, graph = shard
    unit = _unit(q)
    qn, xn = np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)

    def verified(i: int, at: np.ndarray) -> np.ndarray:
        at = at[own[at] != keys[i]]
        return at[(x[at] @ q[i]) / (xn[at] * qn[i]) >= threshold]

    node = np.minimum(np.searchsorted(own, keys), len(own) - 1)  # keys of a shard are sorted
    node = [int(j) if own[j] == k else None for j, k in zip(node, keys)]
    least = threshold - 1e-5  # single precision finds a little more than is verified
    audit = np.unique(np.linspace(0, len(keys) - 1, min(AUDITED, len(keys))).astype(int))
    truth = {int(i): len(verified(i, np.flatnonzero(graph.v @ unit[i] >= least))) for i in audit}
    while True:
        found = {i: verified(i, graph.within(unit[i], least, beam, node[i])) for i in truth}
        if sum(map(len, found.values())) >= recall * sum(truth.values()) or beam >= len(own):
            break
        beam *= 2
    rest = (i for i in range(len(keys)) if i not in found)
    found |= {i: verified(i, graph.within(unit[i], least, beam, node[i])) for i in rest}
    return [found[i] for i in range(len(keys))], beam


def _search(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Rows (node, other, links): other null with a query's number of
        links, else a link of a spanning star."""
        out = [pd.DataFrame({"node": [], "other": pd.array([], dtype="Int64"), "links": []})]
        for index in rows.loc[rows["block"] < 0, "packed"]:
            own, copies, _, _ = shard = pickle.loads(index)
            for block in rows[rows["block"] >= 0].sort_values("block")["packed"]:
                keys, _ = queries = pickle.loads(block)
                found, _ = search_block(queries, shard, threshold)
                links = np.array([copies[at].sum() for at in found], dtype=np.int64)
                out.append(pd.DataFrame({"node": keys, "other": pd.array([None] * len(keys), dtype="Int64"), "links": links}))
                src, dst, held = [], [], 0
                for i, at in enumerate(found):
                    src.append(np.full(len(at), keys[i]))
                    dst.append(own[at])
                    held += len(at)
                    if held > PAIRS or i == len(found) - 1:
                        a, b = stars(np.concatenate(src), np.concatenate(dst))
                        out.append(pd.DataFrame({"node": a, "other": pd.array(b, dtype="Int64"), "links": 0}))
                        src, dst, held = [], [], 0
        return pd.concat(out[1:] or out, ignore_index=True)

    return run


def meetings(shards: DataFrame, blocks: DataFrame, parts: DataFrame) -> DataFrame:
    """``(group, shard, run, block, packed)``: every shard once (block -1) for each run
    of ``RUN_BLOCKS`` blocks of its group, every block once for each shard."""
    runs = F.sequence(F.lit(0), F.ceil(F.col("blocks") / RUN_BLOCKS).cast("int") - 1)
    each = F.sequence(F.lit(0).cast("bigint"), F.col("shards").cast("bigint") - 1)
    graphs = shards.join(parts, "group").select(
        "group", "shard", F.explode(runs).alias("run"), F.lit(-1).cast("bigint").alias("block"), F.col("index").alias("packed"))
    asked = blocks.join(parts, "group").select(
        "group", F.explode(each).alias("shard"), F.floor(F.col("block") / RUN_BLOCKS).cast("int").alias("run"),
        "block", F.col("queries").alias("packed"))
    return graphs.unionByName(asked)


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     label_col: str = "label", threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS,
                     block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Near-duplicate vectors of equal labels.

    Returns one row per row of ``vectors``: vec_id, n_links (other vectors
    linked directly), component_id (the smallest vec_id reachable by links,
    itself included), kept (vec_id = component_id). Vectors link if their
    labels are equal and not null and their cosine, in double precision, is
    ``threshold`` or more; those that are null, empty, zero, or hold null or
    non-finite components link with nothing, nor do vectors of different
    length. Repeated rows are vectors of their own, linked with each other.
    Rows with a null vec_id link and count, but never name a component; they
    are kept, with a null component_id if no other names it. An empty table
    gives an empty result; other columns are not read.
    """
    store = Store(vectors.sparkSession, "embeddings")
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"), F.col(label_col).alias("label"))
    valid = F.coalesce(
        F.col("label").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = store.put(rows.withColumn("vector", F.when(valid, F.col("v"))).withColumn("dim", F.size("vector")).drop("v"))
    distinct = (
        rows.where("vector is not null").groupBy("label", "dim", "vector")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    )
    # the key is stored with the row, so it stays what it is
    distinct = store.put(distinct.withColumn("key", F.monotonically_increasing_id()))
    sizes = distinct.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    parts = sizes.select(
        "label", "dim", F.struct("label", "dim").alias("group"), F.ceil(F.col("n") / shard_rows).alias("shards"),
        F.ceil(F.col("n") / block_rows).alias("blocks"))
    dealt = store.put(
        distinct.join(parts, ["label", "dim"]).select(
            F.to_json("group").alias("group"), "key", "copies", "vector",
            F.pmod(F.xxhash64("key"), F.col("shards")).alias("shard"),
            F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks")).alias("block"))
    )
    parts = parts.select(F.to_json("group").alias("group"), "shards", "blocks")
    n = parts.agg(F.sum("shards"), F.sum(F.col("shards") * F.ceil(F.col("blocks") / RUN_BLOCKS))).first()
    few = [max(1, min(4 * (k or 0), MOST_PARTS)) for k in n]
    shards = store.put(
        dealt.repartition(few[0], "group", "shard").groupBy("group", "shard")
        .applyInPandas(_build, "group string, shard bigint, index binary"))
    blocks = dealt.groupBy("group", "block").applyInPandas(_pack, "group string, block bigint, queries binary")
    found = store.put(
        meetings(shards, blocks, parts).repartition(few[1], "group", "shard", "run").groupBy("group", "shard", "run")
        .applyInPandas(_search(threshold), "node bigint, other bigint, links bigint")
    )
    store.drop(dealt)
    store.drop(shards)
    links = found.where("other is null").groupBy("node").agg(F.sum("links").alias("found"))
    edges = found.where("other is not null").select(F.col("node").alias("src"), F.col("other").alias("dst"))
    nodes = distinct.select("key", "label", "vector", "dim", "first_id", "copies")
    groups = with_component(nodes, components(store, edges), "key", "group")
    lowest = groups.groupBy("group").agg(F.min("first_id").alias("lowest"))
    info = groups.join(lowest, "group").join(links, groups["key"] == links["node"], "left").select(
        F.col("label").alias("_l"), F.col("vector").alias("_v"), "lowest",
        (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n"))
    out = rows.join(info, (rows["label"] == info["_l"]) & (rows["vector"] == info["_v"]), "left")
    component = F.when(F.col("_v").isNotNull(), F.col("lowest")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


EMBEDDING_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), r AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (
  SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a
), n AS (
  SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a
)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
