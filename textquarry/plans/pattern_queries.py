"""Association mining queries.

Baskets: every order with the distinct part types of its line items
(orders without line items are empty baskets). Minimum support 0.05,
itemsets of any length, rules kept at lift >= 1.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import patterns
from ..session import read_table
from .catalog import register
from .corpus import build_corpus, corpus_ctes

MIN_SUPPORT = 0.05
TOKEN_SUPPORT = 0.2
R = 6


def baskets(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    items = li.join(p, li.l_partkey == p.p_partkey).select(F.col("l_orderkey").alias("tid"), "p_type")
    tx = patterns.transactions(items, "tid", "p_type")
    return o.select(F.col("o_orderkey").alias("tid")).join(tx, "tid", "left").select(
        "tid", F.coalesce(F.col("items"), F.array().cast("array<string>")).alias("items")
    )


BASKET_CTES = f"""
baskets AS (
  SELECT o.o_orderkey AS tid,
         coalesce(list_sort(list_distinct(list(p.p_type) FILTER (WHERE p.p_type IS NOT NULL))), []) AS items
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey LEFT JOIN part p ON p.p_partkey = l.l_partkey
  GROUP BY o.o_orderkey
),
ti AS (SELECT tid, unnest(items) AS item FROM baskets),
nb AS (SELECT count(*) AS n, ceil({MIN_SUPPORT} * count(*)) AS mc FROM baskets),
held(tid, items) AS (
  SELECT tid, [item] FROM ti
  UNION ALL
  SELECT h.tid, list_append(h.items, t.item) FROM held h JOIN ti t ON t.tid = h.tid AND t.item > h.items[-1]
),
itemsets AS (
  SELECT items, freq::BIGINT AS freq, freq / (SELECT n FROM nb) AS support
  FROM (SELECT items, count(*) AS freq FROM held GROUP BY items HAVING count(*) >= (SELECT mc FROM nb))
)"""

RULE_CTES = """
splits AS (
  SELECT items, support, mask,
         list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 1) AS antecedents,
         list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 0) AS consequents
  FROM (SELECT items, support, unnest(range(1, (1 << len(items)) - 1)) AS mask FROM itemsets WHERE len(items) >= 2)
),
rules AS (
  SELECT s.antecedents, s.consequents, a.support AS antecedent_support, c.support AS consequent_support, s.support,
         s.support / a.support AS confidence,
         s.support / a.support / c.support AS lift,
         s.support - a.support * c.support AS leverage,
         CASE WHEN s.support / a.support = 1.0 THEN NULL
              ELSE (1.0 - c.support) / (1.0 - s.support / a.support) END AS conviction,
         len(s.antecedents)::INTEGER AS antecedent_len, len(s.consequents)::INTEGER AS consequents_len
  FROM splits s JOIN itemsets a ON a.items = s.antecedents JOIN itemsets c ON c.items = s.consequents
  WHERE s.support / a.support / c.support >= 1.0
)"""


def _itemsets(spark, sf_dir):
    return patterns.frequent_itemsets(baskets(spark, sf_dir), "items", MIN_SUPPORT)


def _round_rules(r):
    return r.select(
        "antecedents", "consequents",
        *[F.round(c, R).alias(c) for c in ("antecedent_support", "consequent_support", "support", "confidence",
                                           "lift", "leverage", "conviction")],
        "antecedent_len", "consequents_len",
    )


@register("frequent_itemsets", f"WITH RECURSIVE {BASKET_CTES}\nSELECT items, freq, round(support, 6) AS support FROM itemsets")
def q_frequent_itemsets(spark, sf_dir):
    return _itemsets(spark, sf_dir).select("items", "freq", F.round("support", R).alias("support"))


@register("apriori", f"WITH RECURSIVE {BASKET_CTES}\nSELECT items, freq, round(support, 6) AS support FROM itemsets")
def q_apriori(spark, sf_dir):
    a = patterns.apriori(baskets(spark, sf_dir), "tid", "items", MIN_SUPPORT)
    return a.select("items", "freq", F.round("support", R).alias("support"))


@register(
    "association_rules",
    f"WITH RECURSIVE {BASKET_CTES},{RULE_CTES}\n"
    + """SELECT antecedents, consequents, round(antecedent_support, 6) AS antecedent_support,
       round(consequent_support, 6) AS consequent_support, round(support, 6) AS support,
       round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(leverage, 6) AS leverage,
       round(conviction, 6) AS conviction, antecedent_len, consequents_len FROM rules""",
)
def q_association_rules(spark, sf_dir):
    return _round_rules(patterns.association_rules(_itemsets(spark, sf_dir), "lift", 1.0))


def _topic_items(itemsets, k=3):
    """The ``k`` most frequent single items (the 'topic words' of the graph)."""
    singles = itemsets.where(F.size("items") == 1).orderBy(F.col("freq").desc(), F.col("items"))
    return [r["items"][0] for r in singles.limit(k).collect()]


@register(
    "rule_edges",
    f"WITH RECURSIVE {BASKET_CTES},{RULE_CTES},"
    + """
top AS (
  SELECT *, row_number() OVER (ORDER BY lift DESC, antecedent_len DESC, consequents_len DESC, confidence DESC,
                                        antecedents, consequents) AS rule_rank
  FROM rules QUALIFY rule_rank <= 5
),
tw AS (SELECT items[1] AS w FROM itemsets WHERE len(items) = 1 ORDER BY freq DESC, items LIMIT 3),
edges AS (
  SELECT rule_rank, item AS src, '{' || array_to_string(antecedents, ', ') || '}' AS dst, item
  FROM (SELECT rule_rank, antecedents, unnest(antecedents) AS item FROM top)
  UNION ALL
  SELECT rule_rank, '{' || array_to_string(consequents, ', ') || '}' AS src, item AS dst, item
  FROM (SELECT rule_rank, consequents, unnest(consequents) AS item FROM top)
)
SELECT rule_rank::BIGINT AS rule_rank, src, dst, 2::BIGINT AS weight, item, item IN (SELECT w FROM tw) AS item_is_topic
FROM edges""",
)
def q_rule_edges(spark, sf_dir):
    its = _itemsets(spark, sf_dir)
    rules = patterns.association_rules(its, "lift", 1.0)
    return patterns.rule_edges(rules, _topic_items(its), 5)


@register(
    "frequent_tokens",
    f"WITH RECURSIVE {corpus_ctes()},"
    + f"""
least AS (SELECT ceil({TOKEN_SUPPORT} * n) AS mc, n FROM ndocs),
held AS (SELECT term, list(doc_num) AS docs FROM tf GROUP BY term HAVING count(*) >= (SELECT mc FROM least)),
sets(items, docs) AS (
  SELECT [term], docs FROM held
  UNION ALL
  SELECT items, docs FROM (
    SELECT list_append(s.items, h.term) AS items, list_intersect(s.docs, h.docs) AS docs
    FROM sets s JOIN held h ON h.term > s.items[-1]
  ) WHERE len(docs) >= (SELECT mc FROM least)
)
SELECT items, len(docs)::BIGINT AS freq, round(len(docs) / (SELECT n FROM least), 6) AS support FROM sets""",
)
def q_frequent_tokens(spark, sf_dir):
    """Frequent token sets of the English documents (support 0.2), by the
    level-wise operator."""
    c = build_corpus(spark, sf_dir)
    tx = c.docs.select(F.col("doc_num").alias("tid"), F.array_distinct("tokens").alias("items"))
    a = patterns.apriori(tx, "tid", "items", TOKEN_SUPPORT)
    return a.select("items", "freq", F.round("support", R).alias("support"))
