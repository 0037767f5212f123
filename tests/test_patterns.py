from pyspark.sql import functions as F

from textquarry.operators import patterns


def baskets(spark):
    rows = [(1, ["a", "b", "c"]), (2, ["a", "b", "c"]), (3, ["a", "b", "c"]), (4, ["a"]), (5, [])]
    return spark.createDataFrame(rows, "tid long, items array<string>")


def as_set(df):
    return {(tuple(r["items"]), r["freq"]) for r in df.collect()}


def test_fpgrowth_and_apriori_agree(spark):
    tx = baskets(spark)
    fp = patterns.frequent_itemsets(tx, "items", 0.6)
    ap = patterns.apriori(tx, "tid", "items", 0.6)
    assert as_set(fp) == as_set(ap)
    assert len(as_set(fp)) == 7
    assert (("a",), 4) in as_set(fp)


def test_rules_have_multi_item_consequents(spark):
    its = patterns.frequent_itemsets(baskets(spark), "items", 0.6)
    rules = patterns.association_rules(its, "lift", 1.0).collect()
    cons = {tuple(r.consequents) for r in rules}
    assert ("b", "c") in cons
    for r in rules:
        assert r.lift >= 1.0
        assert abs(r.confidence - r.support / r.antecedent_support) < 1e-12


def test_rule_graph_edges(spark):
    its = patterns.frequent_itemsets(baskets(spark), "items", 0.6)
    rules = patterns.association_rules(its, "lift", 1.0)
    e = patterns.rule_edges(rules, ["a"], 2).collect()
    assert {r.weight for r in e} == {2}
    assert any(r.dst.startswith("{") for r in e) and any(r.src.startswith("{") for r in e)


def test_rules_of_long_itemsets(spark):
    """Nine items: every split of every subset, sorted by the rule order."""
    tx = spark.createDataFrame([(i, list("abcdefghi")) for i in range(4)] + [(9, ["a"])], "tid long, items array<string>")
    its = patterns.apriori(tx, "tid", "items", 0.6)
    assert as_set(its) == as_set(patterns.frequent_itemsets(tx, "items", 0.6)) and its.count() == 2**9 - 1
    rules = patterns.association_rules(its, "support", 0.0).collect()
    assert len(rules) == 3**9 - 2 * 2**9 + 1
    keys = [(-r.lift, -r.antecedent_len, -r.consequents_len, -r.confidence, r.antecedents, r.consequents) for r in rules]
    assert keys == sorted(keys)


def test_apriori_plans_no_product(spark, capfd):
    tx = spark.createDataFrame([(i, list("abc")) for i in range(5)], "tid long, items array<string>")
    ti = tx.selectExpr("tid", "explode(items) item")
    held = patterns._extend(ti.selectExpr("tid", "array(item) items"), ti)
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_apriori_over_many_blocks(spark):
    """Random transactions over several blocks and partitions, nulls, repeated
    items, empty and null rows: sets and frequencies of a plain count."""
    import itertools
    import random

    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        t = [x for x, p in zip("abcdefg", (0.9, 0.7, 0.5, 0.4, 0.3, 0.05, 0.6)) if rnd.random() < p]
        rows.append((i % 50, t + t[:1] + [None] if i % 3 else t))
    rows += [(1, []), (None, None), (2, [None])]
    df = spark.createDataFrame(rows, "tid long, items array<string>").repartition(5)
    want = {}
    for _, t in rows:
        held = sorted({x for x in t or [] if x is not None})
        for k in range(1, len(held) + 1):
            for c in itertools.combinations(held, k):
                want[c] = want.get(c, 0) + 1
    for support in (0.02, 0.1, 0.35):
        got = patterns.apriori(df, "tid", "items", support).collect()
        assert len({tuple(r["items"]) for r in got}) == len(got)
        assert {(tuple(r["items"]), r["freq"]) for r in got} == {(c, n) for c, n in want.items() if n >= support * len(rows)}
        assert all(r["support"] == r["freq"] / len(rows) for r in got)
    short = patterns.apriori(df, "tid", "items", 0.1, max_len=2)
    assert {len(r["items"]) for r in short.collect()} == {1, 2}


def test_apriori_of_no_rows(spark):
    none = spark.createDataFrame([], "tid long, items array<string>")
    assert patterns.apriori(none).count() == 0
    assert patterns.apriori(spark.createDataFrame([(1, [])], none.schema)).count() == 0


def test_bitmap_level_plans_no_product(spark):
    tx = spark.createDataFrame([(i, list("abc")) for i in range(5)], "tid long, items array<string>")
    plan = patterns.apriori(tx)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    level = spark.createDataFrame([(list("ab"), 0), (list("ac"), 1), (list("bc"), 2), (list("ad"), 3)],
                                  "items array<string>, set_id long")
    cand = patterns._candidates(level, 3)
    assert [(r["items"], r["l"], r["r"]) for r in cand.collect()] == [(list("abc"), 0, 1)]
    plan = cand._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
