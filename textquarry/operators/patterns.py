"""Frequent itemsets and association rules.

``frequent_itemsets`` runs ``pyspark.ml.fpm.FPGrowth`` (parallel FP-growth).
``apriori`` is the level-wise alternative over vertical bitmaps (packed
transactions, AND and ``bit_count`` in DataFrame joins); it needs no deep
tree for long transactions and serves as a cross-check.
``association_rules`` enumerates every non-empty proper split of each
itemset (multi-item consequents included), which ML's rules do not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import checked_broadcast
from .keys import ordered_index

# Words of 64 transactions in a row of a bitmap.
WORDS = [f"w{i}" for i in range(8)]


def _min_count(n: int, min_support: float) -> int:
    """Smallest frequency with ``freq / n >= min_support``, in exact decimals."""
    from decimal import Decimal

    return int(math.ceil(Decimal(str(min_support)) * n))


def transactions(df: DataFrame, tid: str, item: str) -> DataFrame:
    """``(tid, items)``: distinct items per transaction, sorted."""
    return df.groupBy(tid).agg(F.array_sort(F.collect_set(item)).alias("items"))


def frequent_itemsets(tx: DataFrame, items: str = "items", min_support: float = 0.6,
                      max_len: int | None = None) -> DataFrame:
    """``(items, freq, support)`` with ``support = freq / n`` over all
    transactions (empty ones included). Items are de-duplicated per row.
    Sets of any length are mined unless ``max_len`` is given. The result is
    checkpointed, so reading it several times mines once."""
    from pyspark.ml.fpm import FPGrowth

    data = tx.select(F.array_distinct(F.coalesce(F.col(items), F.array().cast("array<string>"))).alias("items"))
    n = data.count()
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(data)
    out = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").cast("bigint").alias("freq"))
    if max_len is not None:
        out = out.where(F.size("items") <= max_len)
    return out.withColumn("support", F.col("freq") / F.lit(float(n))).checkpoint(eager=True)


def _extend(occurrences: DataFrame, ti: DataFrame) -> DataFrame:
    """Every transaction's sets with one more, larger item of the transaction."""
    more = ti.select(F.col("tid").alias("_tid"), F.col("item").alias("_item"))
    on = (F.col("tid") == F.col("_tid")) & (F.element_at("items", -1) < F.col("_item"))
    return occurrences.join(more, on).select("tid", F.concat("items", F.array("_item")).alias("items"))


def _meet() -> list[Column]:
    """The transactions that hold both sides' sets, word by word."""
    return [F.col(w).bitwiseAND(F.col("_" + w)).alias(w) for w in WORDS]


def _extend(sets: DataFrame, singles: DataFrame) -> DataFrame:
    """Every ``tid``'s sets with one more, larger item of the same ``tid``. A
    ``tid`` is a transaction, or a block of them with the bitmaps of its sets
    and items; then the result has the bitmaps of those that hold both."""
    words = WORDS if WORDS[0] in sets.columns else []
    more = singles.select(F.col("tid").alias("_tid"), F.col("item").alias("_item"),
                          *[F.col(w).alias("_" + w) for w in words])
    on = (F.col("tid") == F.col("_tid")) & (F.element_at("items", -1) < F.col("_item"))
    return sets.join(more, on).select("tid", F.concat("items", F.array("_item")).alias("items"),
                                      *(_meet() if words else []))


def _held() -> Column:
    """Transactions in a row's bitmap."""
    return sum((F.bit_count(w) for w in WORDS[1:]), F.bit_count(WORDS[0])).cast("bigint")


def bitmaps(tx: DataFrame, items: str = "items") -> DataFrame:
    """Vertical bitmaps ``(block, item, w0..w7)``: for every block of 512
    rows of ``tx`` and every item in it, the rows that hold the item. The
    bitmap of the null item is that of all rows, with or without items.

    Rows are numbered within their partition, so a block never spans two
    and its bitmaps are folded where the rows lie. They are sorted there
    first, so that a task repeated after a lost executor gives its rows the
    same numbers; the result is checkpointed.
    """
    # numbered before they are exploded: a number in the same select would count the items
    row = tx.select(F.array_sort(F.array_distinct(items)).alias("items")).sortWithinPartitions(F.xxhash64("items"), "items")
    row = row.select(F.monotonically_increasing_id().alias("row"), "items")
    none = F.array(F.lit(None).cast("string"))
    row = row.select("row", F.explode(F.concat(F.coalesce("items", none), none)).alias("item"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("row") % 64).cast("int"))
    word = F.shiftright("row", 6) % len(WORDS)
    return (
        row.groupBy(F.shiftright("row", 9).alias("block"), "item")
        .agg(*[F.coalesce(F.bit_or(F.when(word == i, bit)), F.lit(0).cast("bigint")).alias(w)
               for i, w in enumerate(WORDS)])
        .checkpoint(eager=True)
    )


def _candidates(level: DataFrame, k: int) -> DataFrame:
    """``(items, l, r)``: sets of ``k`` items whose subsets of ``k - 1`` are
    all in ``level`` ``(items, set_id)``; ``l`` and ``r`` are the two that
    lack the last item and the one before it."""
    prefix = F.slice("items", 1, k - 2)
    left = level.select(prefix.alias("prefix"), "items", F.col("set_id").alias("l"))
    right = level.select(prefix.alias("_prefix"), F.element_at("items", -1).alias("last"), F.col("set_id").alias("r"))
    on = (F.col("prefix") == F.col("_prefix")) & (F.element_at("items", -1) < F.col("last"))
    cand = left.join(right, on).select(F.concat("items", F.array("last")).alias("items"), "l", "r")
    # leaving out one of the last two gives l and r, which are known
    others = cand.select("items", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(k - 2)), lambda i: F.filter("items", lambda x, j: j + 1 != i))).alias("sub"))
    bad = others.join(level.select(F.col("items").alias("sub")), "sub", "left_anti").select("items").distinct()
    return cand.join(bad, "items", "left_anti")


def apriori(tx: DataFrame, tid: str = "tid", items: str = "items", min_support: float = 0.6,
            max_len: int | None = None) -> DataFrame:
    """Level-wise Apriori over vertical bitmaps: ``(items, freq, support)``,
    sets of any length unless ``max_len`` is given. Every row of ``tx`` is a
    transaction; ``tid`` is not needed and kept for callers. Null items
    and items repeated in a row don't count; rows without items count in
    the support's divisor only. No rows give no sets.

    A set's transactions are the AND of the bitmaps of two of its subsets,
    512 transactions a row, and its frequency is their ``bit_count``; so no
    level lists the sets of a transaction. Pairs are counted block by block
    (a join on the block, folded before the shuffle); longer sets only
    where all their subsets are frequent. Bitmaps are kept of frequent sets
    only; each level is checkpointed, the loop ends with an empty one.
    """
    every = bitmaps(tx, items)
    n = every.where(F.col("item").isNull()).agg(F.sum(_held())).first()[0] or 0
    mc = max(1, _min_count(n, min_support))
    single = every.where(F.col("item").isNotNull())
    l1 = single.groupBy("item").agg(F.sum(_held()).alias("freq")).where(F.col("freq") >= mc)
    l1 = ordered_index(l1, ["item"], name="set_id").checkpoint(eager=True)
    level = l1.select(F.array("item").alias("items"), "freq", "set_id")
    result = level.select("items", "freq")
    held = (
        single.join(checked_broadcast(l1.select("item", "set_id")), "item").select("block", "set_id", *WORDS)
        .repartition("block").checkpoint(eager=True)
    )
    k = 2
    while (max_len is None or k <= max_len) and not level.isEmpty():
        if k == 2:
            one = held.select(F.col("block").alias("tid"), F.col("set_id").alias("item"), *WORDS)
            both = _extend(one.withColumn("items", F.array("item")).drop("item"), one)
            found = both.groupBy("items").agg(F.sum(_held()).alias("freq")).where(F.col("freq") >= mc)
            names = level.select("set_id", F.element_at("items", 1).alias("item"))
            cand = (
                found.select(F.col("items")[0].alias("l"), F.col("items")[1].alias("r"), "freq")
                .join(names.toDF("l", "a"), "l").join(names.toDF("r", "b"), "r")
                .select(F.array("a", "b").alias("items"), "l", "r", "freq")
            )
        else:
            cand = _candidates(level, k)
        cand = cand.withColumn("id", F.monotonically_increasing_id()).checkpoint(eager=True)
        pairs = checked_broadcast(cand.select("l", "r", "id"))
        other = held.select(F.col("block").alias("_block"), F.col("set_id").alias("_set"),
                            *[F.col(w).alias("_" + w) for w in WORDS])
        mine = held.join(pairs, F.col("set_id") == F.col("l")).select("block", "r", "id", *WORDS)
        held = (
            mine.join(other, (F.col("block") == F.col("_block")) & (F.col("r") == F.col("_set")))
            .select("block", F.col("id").alias("set_id"), *_meet()).where(_held() > 0)
        )
        held = held.checkpoint(eager=True)
        if k == 2:
            level = cand.select("items", "freq", F.col("id").alias("set_id"))
        else:
            freq = held.groupBy("set_id").agg(F.sum(_held()).alias("freq")).where(F.col("freq") >= mc)
            level = cand.join(freq, cand["id"] == freq["set_id"]).select("items", "freq", "set_id").checkpoint(eager=True)
            held = held.join(checked_broadcast(level.select("set_id")), "set_id", "left_semi").select(
                "block", "set_id", *WORDS)
        result = result.unionByName(level.select("items", "freq"))
        k += 1
    return result.withColumn("support", F.col("freq") / F.lit(float(n)))


def _bit(mask: Column, i: Column) -> Column:
    return F.getbit(mask, i) == 1


def association_rules(itemsets: DataFrame, metric: str = "lift", min_threshold: float = 1.0) -> DataFrame:
    """Rules ``antecedents -> consequents`` from every itemset of two or more
    items: all non-empty proper splits by bit mask, supports looked up by
    joining the itemset table on the (sorted) item arrays. Sets may have any
    length up to 62 items; the masks of a long one are made in two steps, so
    no row holds more than 65,536 of them.

    Measures: support, confidence, lift, leverage, conviction (NULL when
    confidence is 1); kept when ``metric >= min_threshold``; sorted by
    lift, antecedent length, consequent length, confidence (descending).
    """
    if metric not in ("support", "confidence", "lift", "leverage", "conviction"):
        raise ValueError(f"unknown metric {metric!r}")
    sup = itemsets.select(F.col("items").alias("k"), F.col("support").alias("s"))
    big = itemsets.where(F.size("items") >= 2).select("items", "support", F.size("items").alias("n"))
    two = F.lit(2)
    high = F.sequence(F.lit(0), (F.pow(two, F.greatest(F.col("n") - 16, F.lit(0))) - 1).cast("bigint"))
    low = F.sequence(F.lit(0), (F.pow(two, F.least(F.col("n"), F.lit(16))) - 1).cast("bigint"))
    splits = (
        big.withColumn("high", F.explode(high)).withColumn("low", F.explode(low))
        .withColumn("mask", F.col("high") * 65536 + F.col("low"))
        .where((F.col("mask") > 0) & (F.col("mask") < F.pow(two, F.col("n")).cast("bigint") - 1))
    )
    splits = splits.select(
        "items", "support",
        F.filter("items", lambda x, i: _bit(F.col("mask"), i)).alias("antecedents"),
        F.filter("items", lambda x, i: ~_bit(F.col("mask"), i)).alias("consequents"),
    )
    r = (
        splits.join(sup.select(F.col("k").alias("antecedents"), F.col("s").alias("antecedent_support")), "antecedents")
        .join(sup.select(F.col("k").alias("consequents"), F.col("s").alias("consequent_support")), "consequents")
    )
    conf = F.col("support") / F.col("antecedent_support")
    r = r.select(
        "antecedents", "consequents", "antecedent_support", "consequent_support", "support",
        conf.alias("confidence"),
        (conf / F.col("consequent_support")).alias("lift"),
        (F.col("support") - F.col("antecedent_support") * F.col("consequent_support")).alias("leverage"),
        F.when(conf == 1.0, F.lit(None).cast("double"))
        .otherwise((F.lit(1.0) - F.col("consequent_support")) / (F.lit(1.0) - conf)).alias("conviction"),
        F.size("antecedents").alias("antecedent_len"),
        F.size("consequents").alias("consequents_len"),
    )
    return r.where(F.col(metric) >= min_threshold).orderBy(*rule_order())


def rule_order() -> list[Column]:
    """Lift, antecedent length, consequent length, confidence (all
    descending), then the item arrays as a final tie key."""
    return [
        F.col("lift").desc(), F.col("antecedent_len").desc(), F.col("consequents_len").desc(),
        F.col("confidence").desc(), F.col("antecedents").asc(), F.col("consequents").asc(),
    ]


def rule_edges(rules: DataFrame, topic_words, n: int = 5) -> DataFrame:
    """Edge list of the first ``n`` rules (``rule_order``): item ->
    antecedent-set node and consequent-set node -> item, weight 2, with a
    flag telling whether the item is a topic word."""
    from .counts import top_k

    top = top_k(rules, n, rule_order(), ordinal="rule_rank")

    def label(c):
        return F.concat(F.lit("{"), F.array_join(c, ", "), F.lit("}"))

    ante = top.select("rule_rank", F.explode("antecedents").alias("item"), label(F.col("antecedents")).alias("node"))
    cons = top.select("rule_rank", F.explode("consequents").alias("item"), label(F.col("consequents")).alias("node"))
    edges = ante.select("rule_rank", F.col("item").alias("src"), F.col("node").alias("dst"), "item").unionByName(
        cons.select("rule_rank", F.col("node").alias("src"), F.col("item").alias("dst"), "item")
    )
    words = sorted(set(topic_words))
    flag = F.col("item").isin(*words) if words else F.lit(False)
    return edges.select("rule_rank", "src", "dst", F.lit(2).cast("bigint").alias("weight"), "item",
                        flag.alias("item_is_topic"))
