"""MinHash over a presence matrix.

Permutations of the vocabulary are defined by sorting terms on
``md5(perm || ':' || term)`` inside each permutation: collision free,
reproducible in any engine, and computed by a window partitioned by
``perm`` (each partition holds one vocabulary, at most 4096 rows).

Each term's ranks are packed into one array (vocabulary x permutations,
bounded by the feature cap) and folded per document where its terms are: no
rows or rank arrays per permutation cross the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import BROADCAST_BYTES, side_bytes
from .similarity import pair_stats, jaccard_expr


def permutations(vocab: DataFrame, n_perm: int) -> DataFrame:
    """``(term, perm, rank)``: rank 1..N of every term in each permutation."""
    p = vocab.select("term", F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1))).alias("perm"))
    order = F.md5(F.concat(F.col("perm").cast("string"), F.lit(":"), F.col("term")))
    w = Window.partitionBy("perm").orderBy(order, F.col("term"))
    return p.withColumn("rank", F.row_number().over(w))


def rank_arrays(perms: DataFrame) -> DataFrame:
    """``(term, ranks)`` with ``ranks[i]`` = rank in permutation ``i``."""
    return perms.groupBy("term").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("perm", "rank"))), lambda s: s["rank"]).alias("ranks")
    )


def _folded_ranks(ranks: DataFrame, n_perm: int):
    """mapInArrow: the element-wise smallest ranks of every document's terms,
    for a few documents at a time, from one broadcast table."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    rows = ranks.collect()
    matrix = np.array([r["ranks"][:n_perm] for r in rows], dtype=np.int32).reshape(len(rows), n_perm)
    table = ranks.sparkSession.sparkContext.broadcast(([r["term"] for r in rows], matrix))

    def run(batches):
        vocab, matrix = pa.array(table.value[0], pa.string()), table.value[1]
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                lists = b.column("terms")
                # documents and rows of the table of all their known terms, one document after the other
                doc = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
                term = pc.index_in(pc.list_flatten(lists), vocab)
                known = term.is_valid().to_numpy(zero_copy_only=False)
                term, doc = term.drop_null().to_numpy(), doc[known]
                sig = np.ones((b.num_rows, n_perm), dtype=np.int32)
                if len(doc):
                    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                    sig[doc[first]] = np.minimum.reduceat(matrix[term], first, axis=0)
                ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * n_perm)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_num"), pa.ListArray.from_arrays(ends, pa.array(sig.ravel()))], ["doc_num", "sig"])

    return run


def minhash_signature(x_clip: DataFrame, docs: DataFrame, ranks: DataFrame, n_perm: int,
                      table_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(doc_num, sig)``: per permutation the smallest rank among the
    document's present terms; a document with no term gets 1 everywhere.

    Only a document's terms are shuffled; the ranks are folded where the
    document then is, from the rank table, which goes to every task if it
    holds at most ``table_bytes`` (vocabulary x permutations is bounded by
    the feature cap). A larger table is joined term by term.
    """
    x = x_clip.where(F.col("value") > 0)
    ranks = ranks.checkpoint(eager=True)
    if side_bytes(ranks, table_bytes) <= table_bytes:
        kind = docs.schema["doc_num"].dataType.simpleString()
        terms = x.groupBy("doc_num").agg(F.collect_list("term").alias("terms"))
        sig = terms.mapInArrow(_folded_ranks(ranks, n_perm), f"doc_num {kind}, sig array<int>")
    else:
        first = F.array_repeat(F.lit(2**31 - 1), n_perm)
        sig = x.join(ranks, "term").groupBy("doc_num").agg(F.collect_list("ranks").alias("rows")).select(
            "doc_num",
            F.aggregate("rows", first, lambda acc, r: F.zip_with(acc, r, lambda a, b: F.least(a, b))).alias("sig"),
        )
    ones = F.array_repeat(F.lit(1), n_perm)
    return docs.select("doc_num").join(sig, "doc_num", "left").select(
        "doc_num", F.coalesce(F.col("sig"), ones).alias("sig")
    )


def target_signature(sig: DataFrame, target) -> list[int]:
    """The target's signature (one row of at most ``n_perm`` integers)."""
    row = sig.where(F.col("doc_num") == F.lit(target)).select("sig").first()
    if row is None:
        raise ValueError(f"target document {target} not found")
    return list(row["sig"])


def signature_measures(sig_col, tsig: Sequence[int], estimator: str = "set"):
    """Cosine and Jaccard of a signature column against a literal signature.

    ``estimator='set'`` compares the sets of values; ``'positional'`` is the
    share of positions that agree (the usual MinHash estimate).
    """
    t = F.array(*[F.lit(int(v)) for v in tsig])
    tnorm = sum(float(v) * float(v) for v in tsig) ** 0.5
    dot = F.aggregate(F.zip_with(sig_col, t, lambda a, b: (a * b).cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    sq = F.aggregate(F.transform(sig_col, lambda a: (a * a).cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    cosine = F.coalesce(F.try_divide(dot, F.sqrt(sq) * F.lit(tnorm)), F.lit(0.0))
    if estimator == "set":
        inter = F.size(F.array_intersect(sig_col, t))
        union = F.size(F.array_distinct(sig_col)) + F.lit(len(set(tsig))) - inter
        jac = F.coalesce(F.try_divide(inter.cast("double"), union.cast("double")), F.lit(0.0))
    elif estimator == "positional":
        agree = F.aggregate(F.zip_with(sig_col, t, lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda acc, v: acc + v)
        jac = agree.cast("double") / F.lit(float(len(tsig)))
    else:
        raise ValueError(f"unknown estimator {estimator!r}")
    return cosine, jac


def minhash_similarity(sig: DataFrame, x_clip: DataFrame, docs: DataFrame, target, n_perm: int | None = None,
                       estimator: str = "set", tsig: Sequence[int] | None = None,
                       exact: DataFrame | None = None) -> DataFrame:
    """Signature cosine, signature Jaccard and exact presence Jaccard of
    every document against the target; missing values become 0.

    ``tsig`` (the target's full signature) and ``exact`` (output of
    ``exact_jaccard``) may be passed in when several sizes share them."""
    s = sig if n_perm is None else sig.select("doc_num", F.slice("sig", 1, n_perm).alias("sig"))
    tsig = target_signature(sig, target) if tsig is None else list(tsig)
    if n_perm is not None:
        tsig = tsig[:n_perm]
    cos, jac = signature_measures(F.col("sig"), tsig, estimator)
    if exact is None:
        exact = exact_jaccard(x_clip, docs, target)
    return s.select("doc_num", cos.alias("sig_cosine_similarity"), jac.alias("sig_jaccard_similarity")).join(
        exact, "doc_num", "full"
    )


def exact_jaccard(x_clip: DataFrame, docs: DataFrame, target) -> DataFrame:
    return pair_stats(x_clip, docs, target).select("doc_num", jaccard_expr().alias("doc_jaccard_similarity"))


def _measured(tsig: Sequence[int], sizes: Sequence[int], estimator: str):
    """mapInArrow: ``signature_measures`` of every document's signature at all sizes, as
    arrays in the order of the sizes."""
    import numpy as np
    import pyarrow as pa

    if estimator not in ("set", "positional"):
        raise ValueError(f"unknown estimator {estimator!r}")
    whole_t = np.array(tsig, dtype=np.int64)

    def one(sig, t):
        tnorm = float((t * t).sum()) ** 0.5
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = (sig * t).sum(axis=1) / (np.sqrt((sig * sig).sum(axis=1).astype(np.float64)) * tnorm)
        if estimator == "positional":
            return np.nan_to_num(cosine, nan=0.0, posinf=0.0), (sig == t).sum(axis=1) / len(t)
        held = np.zeros(max(sig.max(initial=0), t.max()) + 1, dtype=bool)
        held[t] = True
        values = np.sort(sig, axis=1)
        new = np.ones(values.shape, dtype=bool)
        new[:, 1:] = values[:, 1:] != values[:, :-1]
        both = (new & held[values]).sum(axis=1)
        return np.nan_to_num(cosine, nan=0.0, posinf=0.0), both / (new.sum(axis=1) + int(held.sum()) - both)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                sig = b.column("sig").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.int64)
                pairs = [one(sig[:, :n], whole_t[:n]) for n in sizes]
                ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(pairs))
                measures = [pa.ListArray.from_arrays(ends, pa.array(np.stack([p[i] for p in pairs], axis=1).ravel()))
                            for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([b.column("doc_num"), *measures], ["doc_num", "cosine", "jaccard"])

    return run


def minhash_sweep(x_clip: DataFrame, docs: DataFrame, vocab: DataFrame, target,
                  sizes: Sequence[int] = (50, 100, 150, 200), estimator: str = "set",
                  exact: DataFrame | None = None) -> DataFrame:
    """One frame over several permutation counts (column ``num_perm``).

    The largest set of permutations is built once and every smaller count
    uses its prefix: all sizes are measured on a document's one signature
    row, which the exact measures are joined to before it becomes a row per
    size. ``exact`` (the presence-matrix measures) is joined on; its
    ``doc_jaccard_similarity``, if it has one, is not computed again.
    """
    n_max = max(sizes)
    ranks = rank_arrays(permutations(vocab, n_max))
    sig = minhash_signature(x_clip, docs, ranks, n_max).checkpoint(eager=True)
    tsig = target_signature(sig, target)
    kind = sig.schema["doc_num"].dataType.simpleString()
    measured = sig.mapInArrow(_measured(tsig, sizes, estimator), f"doc_num {kind}, cosine array<double>, jaccard array<double>")
    each = [F.struct(F.col("cosine")[i].alias("sig_cosine_similarity"), F.col("jaccard")[i].alias("sig_jaccard_similarity"),
                     F.lit(n).alias("num_perm")) for i, n in enumerate(sizes)]
    wide = measured.select("doc_num", F.array(*each).alias("each"))
    if exact is None or "doc_jaccard_similarity" not in exact.columns:
        wide = wide.join(exact_jaccard(x_clip, docs, target), "doc_num", "full")
    if exact is not None:
        wide = wide.join(exact, "doc_num", "full")
    # documents of the measures alone keep a row per size
    none = F.array(*[F.struct(F.lit(None).cast("double").alias("sig_cosine_similarity"),
                              F.lit(None).cast("double").alias("sig_jaccard_similarity"), F.lit(n).alias("num_perm"))
                     for n in sizes])
    others = [c for c in wide.columns if c not in ("doc_num", "each")]
    return wide.select("doc_num", F.inline(F.coalesce("each", none)), *others)


def best_num_perm(quality: DataFrame):
    """The permutation count with the highest correlation (larger count on
    a tie); one row of a table with one row per count."""
    row = quality.where(F.col("correlation").isNotNull()).orderBy(
        F.col("correlation").desc(), F.col("num_perm").desc()
    ).first()
    return None if row is None else row["num_perm"]
