"""Queries over raw text: word counts, top words, text helpers, dates,
filters, the first-match join and the tokenizer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.stopwords import full_stopwords
from ..operators import counts, filters, joins
from ..session import read_table
from .catalog import register
from .sqlparts import singular_sql, stop_list, tokens_of, words_of

STOP = full_stopwords()


def _documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents")


def paper_fields(docs):
    """Paper-like fields derived from a document: first line = title, second
    line = abstract ('' for a one-line document), whole text = body."""
    lines = F.split(F.col("text"), "\n")
    return docs.select(
        "doc_id",
        lines.getItem(0).alias("title"),
        F.when(F.size(lines) > 1, lines.getItem(1)).otherwise(F.lit("")).alias("abstract"),
        F.col("text").alias("body_text"),
        "lang",
        "source",
    )


PAPER_FIELDS_SQL = """
  SELECT doc_id,
         string_split(text, chr(10))[1] AS title,
         CASE WHEN len(string_split(text, chr(10))) > 1 THEN string_split(text, chr(10))[2] ELSE '' END AS abstract,
         text AS body_text, lang, source
  FROM documents
"""

# --------------------------------------------------------------- word counts

WC_RAW_SQL = f"""
SELECT word, count(*)::BIGINT AS count
FROM (SELECT unnest({words_of('text')}) AS word FROM documents)
GROUP BY word
"""

WC_STOP_SQL = f"""
SELECT word, count FROM ({WC_RAW_SQL}) WHERE NOT list_contains({stop_list()}, word)
"""

WC_NORM_SQL = f"""
SELECT lower(regexp_replace(word, '[^a-zA-Z0-9]', '', 'g')) AS word, sum(count)::BIGINT AS count
FROM ({WC_RAW_SQL}) GROUP BY 1
"""


def _top_sql(inner: str, n: int = 50) -> str:
    return f"""
SELECT word, count, row_number() OVER (ORDER BY count DESC, word) AS rank
FROM ({inner}) QUALIFY rank <= {n}
"""


@register("word_count_raw", WC_RAW_SQL)
def q_word_count_raw(spark, sf_dir):
    return counts.word_count(_documents(spark, sf_dir), "text")


@register("word_count_stop", WC_STOP_SQL)
def q_word_count_stop(spark, sf_dir):
    return counts.word_count(_documents(spark, sf_dir), "text", stopwords=STOP)


@register("word_count_normalized", WC_NORM_SQL)
def q_word_count_normalized(spark, sf_dir):
    return counts.word_count_normalized(counts.word_count(_documents(spark, sf_dir), "text"))


@register("top_words_raw", _top_sql(WC_RAW_SQL))
def q_top_words_raw(spark, sf_dir):
    return counts.top_words(counts.word_count(_documents(spark, sf_dir), "text"), 50)


@register("top_words_stop", _top_sql(WC_STOP_SQL))
def q_top_words_stop(spark, sf_dir):
    return counts.top_words(counts.word_count(_documents(spark, sf_dir), "text", stopwords=STOP), 50)


@register(
    "text_columns_union",
    f"""
SELECT word, count(*)::BIGINT AS count
FROM (SELECT unnest({words_of('t')}) AS word
      FROM (SELECT role AS t FROM conversations UNION ALL SELECT text AS t FROM conversations))
GROUP BY word
""",
)
def q_text_columns_union(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    return counts.word_count(counts.text_source(conv, ["role", "text"]), "text")


# ------------------------------------------------------------- text helpers

def _trunc_sql(expr: str, n: int) -> str:
    parts = f"string_split({expr}, ' ')"
    return (
        f"CASE WHEN len({parts}) > {n} THEN array_to_string({parts}[1:{n}], ' ') || '...' ELSE {expr} END"
    )


@register(
    "truncate_words",
    f"SELECT doc_id, {_trunc_sql('text', 100)} AS text_100 FROM documents",
)
def q_truncate_words(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", T.truncate_words("text", 100).alias("text_100"))


@register(
    "summary_or_body",
    f"""
SELECT doc_id, {_trunc_sql('title', 40)} AS title,
       CASE WHEN length(abstract) = 0 THEN {_trunc_sql('body_text', 100)}
            ELSE {_trunc_sql('abstract', 100)} END AS abstract_summary
FROM ({PAPER_FIELDS_SQL})
""",
)
def q_summary_or_body(spark, sf_dir):
    p = paper_fields(_documents(spark, sf_dir))
    return p.select(
        "doc_id",
        T.truncate_words("title", 40).alias("title"),
        T.summary_or_body("abstract", "body_text", 100).alias("abstract_summary"),
    )


@register(
    "abbreviate_list",
    """
SELECT doc_id,
       CASE WHEN len(string_split(text, '|')) > 2
            THEN array_to_string(string_split(text, '|')[1:2], '. ') || '...'
            ELSE array_to_string(string_split(text, '|'), '. ') END AS authors
FROM documents
""",
)
def q_abbreviate_list(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", T.abbreviate_list("text", "|", 2).alias("authors"))


# ------------------------------------------------------------------- dates

def _pub_text(o):
    """Publication-date text derived from orders: full dates, year-only for
    low-priority orders, and a day-first (unparsable) form for urgent
    pending orders."""
    d = F.col("o_orderdate")
    return (
        F.when(F.col("o_orderpriority") == "5-LOW", F.date_format(d, "yyyy"))
        .when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"), F.date_format(d, "dd/MM/yyyy"))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )


PUB_TEXT_SQL = """
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y')
              WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN strftime(o_orderdate, '%d/%m/%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS pub_text
  FROM orders
"""

PARSE_SQL = f"""
  SELECT o_orderkey, pub_text,
         CAST(CASE WHEN length(trim(pub_text)) = 4 THEN try_strptime(trim(pub_text) || '-01-01', '%Y-%m-%d')
                   WHEN length(trim(pub_text)) > 4 THEN try_strptime(trim(pub_text), '%Y-%m-%d') END AS DATE) AS publish_date
  FROM ({PUB_TEXT_SQL})
"""


def _parsed_orders(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", _pub_text(o).alias("pub_text")).withColumn(
        "publish_date", T.parse_pub_date("pub_text")
    )


@register(
    "parse_pub_date",
    f"SELECT o_orderkey, pub_text, publish_date, CAST(year(publish_date) AS INTEGER) AS publish_year FROM ({PARSE_SQL})",
)
def q_parse_pub_date(spark, sf_dir):
    return _parsed_orders(spark, sf_dir).withColumn("publish_year", F.year("publish_date"))


@register(
    "year_histogram",
    f"""
SELECT CAST(year(publish_date) AS INTEGER) AS publish_year, count(*)::BIGINT AS count
FROM ({PARSE_SQL}) WHERE year(publish_date) BETWEEN 1996 AND 2000 GROUP BY 1
""",
)
def q_year_histogram(spark, sf_dir):
    p = _parsed_orders(spark, sf_dir).withColumn("publish_year", F.year("publish_date"))
    return counts.value_counts(filters.year_range(p, "publish_year", 1996, 2000), "publish_year")


# ----------------------------------------------------------------- filters

@register(
    "count_having",
    "SELECT source, count(*)::BIGINT AS count FROM documents GROUP BY source HAVING count(*) > 20",
)
def q_count_having(spark, sf_dir):
    return counts.count_having(_documents(spark, sf_dir), "source", 20)


@register(
    "filter_language",
    "SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'en'",
)
def q_filter_language(spark, sf_dir):
    return filters.filter_language(_documents(spark, sf_dir), "lang", "en").select("doc_id", "lang", "source", "n_chars")


@register(
    "label_target",
    """
WITH j AS (
  SELECT d.doc_id, d.source, d.lang, d.text, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
), kept AS (
  SELECT * FROM j
  WHERE doc_id IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL
    AND quality IS NOT NULL AND toxic IS NOT NULL AND length(text) > 0
)
SELECT doc_id, source, quality, toxic,
       CASE WHEN doc_id = (SELECT min(doc_id) FROM kept) THEN 'target document' ELSE 'other documents' END AS doc_type
FROM kept
""",
)
def q_label_target(spark, sf_dir):
    d = _documents(spark, sf_dir).select("doc_id", "source", "lang", "text")
    lab = read_table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    kept = filters.drop_empty(filters.drop_null_rows(j), "text")
    target = filters.min_key(kept, "doc_id")
    return filters.label_target(kept, "doc_id", target).select("doc_id", "source", "quality", "toxic", "doc_type")


@register(
    "first_match_join",
    """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, f.l_linenumber, f.l_partkey, f.l_quantity
FROM orders o JOIN (
  SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) = 1
) f ON o.o_orderkey = f.l_orderkey
""",
)
def q_first_match_join(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    li = read_table(spark, sf_dir, "lineitem")
    # l_linenumber repeats within an order: the other columns make the order total.
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
    li = li.select("l_orderkey", *order)
    j = joins.first_match_join(o, li, "o_orderkey", "l_orderkey", order)
    return j.select("o_orderkey", "o_custkey", "o_totalprice", "l_linenumber", "l_partkey", "l_quantity")


# --------------------------------------------------------------- tokenizer

@register(
    "tokenize",
    f"SELECT doc_id, {tokens_of('text')} AS tokens FROM documents WHERE lang = 'en'",
)
def q_tokenize(spark, sf_dir):
    d = filters.filter_language(_documents(spark, sf_dir), "lang", "en")
    return d.select("doc_id", T.tokenize("text", STOP).alias("tokens"))


@register(
    "clean_text",
    f"""
WITH t AS (
  SELECT doc_id, {tokens_of('title')} AS processed_title_list, {tokens_of('abstract')} AS processed_abstract_list,
         {tokens_of('body_text')} AS processed_text_list
  FROM ({PAPER_FIELDS_SQL}) WHERE lang = 'en'
)
SELECT doc_id,
       array_to_string(processed_title_list, ' ') AS processed_title,
       array_to_string(processed_abstract_list, ' ') AS processed_abstract,
       array_to_string(processed_text_list, ' ') AS processed_text,
       processed_title_list, processed_abstract_list, processed_text_list,
       list_concat(list_concat(processed_title_list, processed_abstract_list), processed_text_list) AS all_text_list
FROM t
""",
)
def q_clean_text(spark, sf_dir):
    from ..operators.features import clean_text

    p = filters.filter_language(paper_fields(_documents(spark, sf_dir)), "lang", "en")
    out = clean_text(p, {"title": "processed_title", "abstract": "processed_abstract", "body_text": "processed_text"}, STOP)
    return out.select(
        "doc_id", "processed_title", "processed_abstract", "processed_text",
        "processed_title_list", "processed_abstract_list", "processed_text_list", "all_text_list",
    )


@register(
    "singularize",
    f"""
SELECT word, {singular_sql('word')} AS singular
FROM (SELECT DISTINCT unnest({tokens_of('text', stop=False)}) AS word FROM documents WHERE lang = 'en')
""",
)
def q_singularize(spark, sf_dir):
    d = filters.filter_language(_documents(spark, sf_dir), "lang", "en")
    words = d.select(*T.explode_values(T.tokenize("text"), "word")).where(F.col("word").isNotNull()).distinct()
    return words.select("word", T.singularize("word").alias("singular"))
