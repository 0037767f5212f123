"""The English document corpus and its term matrices, shared by the
similarity, association and topic queries.

``doc_num`` is the document key (``doc_id``) carried through every table;
the target document is the smallest key of the corpus.
"""

from __future__ import annotations

import functools
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.stopwords import full_stopwords
from ..operators import features, filters
from ..session import read_table
from .sqlparts import tokens_of

STOP = full_stopwords()


@dataclass
class Corpus:
    docs: DataFrame          # doc_num, tokens, abstract_summary, doc_type
    tf: DataFrame            # doc_num, term, tf (all terms)
    vocab: DataFrame         # term, term_id, corpus_tf, df (top FEATURE_CAP)
    x_count: DataFrame       # doc_num, term, value
    x_clip: DataFrame
    x_tfidf: DataFrame
    n_docs: int
    target: int


def english_docs(spark: SparkSession, sf_dir: str, lang: str | None = "en") -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    if lang is not None:
        d = filters.filter_language(d, "lang", lang)
    lines = F.split(F.col("text"), "\n")
    abstract = F.when(F.size(lines) > 1, lines.getItem(1)).otherwise(F.lit(""))
    return d.select(
        F.col("doc_id").alias("doc_num"),
        T.tokenize("text", STOP).alias("tokens"),
        T.summary_or_body(abstract, F.col("text"), 100).alias("abstract_summary"),
        "text",
        "source",
        "lang",
    )


_BUILT: dict[tuple, Corpus] = {}


def _modified(spark: SparkSession, path: str) -> int:
    """Modification time of the input, in whatever store it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getModificationTime()


def build_corpus(spark: SparkSession, sf_dir: str, cap: int = features.FEATURE_CAP,
                 lang: str | None = "en") -> Corpus:
    """The corpus tables, materialised once per Spark application, input
    folder and parameters (the term table is what every analysis reads;
    recomputing it per analysis would re-tokenise the whole corpus)."""
    key = (spark.sparkContext.applicationId, sf_dir, cap, lang, _modified(spark, os.path.join(sf_dir, "documents.parquet")))
    if key not in _BUILT:
        _BUILT[key] = _build(spark, sf_dir, cap, lang)
    return _BUILT[key]


def once_per_corpus(fn):
    """``fn(spark, sf_dir, corpus)`` as ``(spark, sf_dir)``, run once for the English
    corpus of a folder; its result must be a stored table."""
    made: dict[int, tuple[Corpus, DataFrame]] = {}

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = build_corpus(spark, sf_dir)
        if id(c) not in made:
            made[id(c)] = c, fn(spark, sf_dir, c)  # the corpus is kept, so its id stays its own
        return made[id(c)][1]

    return run


def _build(spark: SparkSession, sf_dir: str, cap: int, lang: str | None) -> Corpus:
    docs = english_docs(spark, sf_dir, lang)
    stats = docs.agg(F.count(F.lit(1)).alias("n"), F.min("doc_num").alias("t")).first()
    n_docs, target = int(stats["n"]), stats["t"]
    docs = filters.label_target(docs, "doc_num", target)
    # The (doc, term, tf) table and the capped vocabulary feed every later
    # matrix, broadcast and driver scalar: write them once to the checkpoint
    # folder so no action re-tokenizes the text, and lineage stays short.
    tf = features.term_counts(docs, "tokens").checkpoint(eager=True)
    vocab = features.vocabulary(tf, cap).checkpoint(eager=True)
    x_count = features.count_matrix(tf, vocab, cap)
    return Corpus(
        docs=docs,
        tf=tf,
        vocab=vocab,
        x_count=x_count,
        x_clip=features.clip_matrix(x_count),
        x_tfidf=features.tfidf_matrix(tf, vocab, n_docs, cap),
        n_docs=n_docs,
        target=target,
    )


def _summary_sql() -> str:
    lines = "string_split(text, chr(10))"
    ab = f"CASE WHEN len({lines}) > 1 THEN {lines}[2] ELSE '' END"

    def trunc(e):
        parts = f"string_split({e}, ' ')"
        return f"CASE WHEN len({parts}) > 100 THEN array_to_string({parts}[1:100], ' ') || '...' ELSE {e} END"

    return f"CASE WHEN length({ab}) = 0 THEN {trunc('text')} ELSE {trunc(ab)} END"


def corpus_ctes(cap: int = features.FEATURE_CAP, lang: str | None = "en") -> str:
    """CTEs ``corpus, tf, vocab, xcount, xclip, xtfidf, target`` for DuckDB."""
    return f"""
corpus0 AS (
  SELECT doc_id AS doc_num, {tokens_of('text')} AS tokens, {_summary_sql()} AS abstract_summary, text, source, lang
  FROM documents {"WHERE lang = '" + lang + "'" if lang else ""}
),
target AS (SELECT min(doc_num) AS t FROM corpus0),
corpus AS (
  SELECT *, CASE WHEN doc_num = (SELECT t FROM target) THEN 'target document' ELSE 'other documents' END AS doc_type
  FROM corpus0
),
ndocs AS (SELECT count(*) AS n FROM corpus),
tf AS (
  SELECT doc_num, term, count(*) AS tf FROM (SELECT doc_num, unnest(tokens) AS term FROM corpus) GROUP BY doc_num, term
),
vocab0 AS (
  SELECT term, sum(tf)::BIGINT AS corpus_tf, count(*)::BIGINT AS df FROM tf GROUP BY term
  ORDER BY corpus_tf DESC, term LIMIT {cap}
),
vocab AS (SELECT *, (row_number() OVER (ORDER BY term) - 1)::BIGINT AS term_id FROM vocab0),
xcount AS (SELECT tf.doc_num, tf.term, tf.tf::DOUBLE AS value FROM tf JOIN vocab USING (term)),
xclip AS (SELECT doc_num, term, least(value, 1.0) AS value FROM xcount),
xtfidf0 AS (
  SELECT tf.doc_num, tf.term,
         tf.tf * (ln((1.0 + (SELECT n FROM ndocs)) / (1.0 + vocab.df)) + 1.0) AS raw
  FROM tf JOIN vocab USING (term)
),
xtfidf AS (SELECT doc_num, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_num)) AS value FROM xtfidf0)"""


def sim_ctes(m: str) -> str:
    """Target-versus-all measures of matrix CTE ``m`` as CTE ``{m}_sim``."""
    return f"""
{m}_t AS (SELECT term, value AS b FROM {m} WHERE doc_num = (SELECT t FROM target)),
{m}_tb AS (SELECT coalesce(sum(b), 0.0) AS tb1, coalesce(sum(b * b), 0.0) AS tb2 FROM {m}_t),
{m}_pd AS (
  SELECT x.doc_num, sum(x.value * x.value) AS a2, sum(x.value * coalesce(t.b, 0.0)) AS dot,
         sum(abs(x.value - coalesce(t.b, 0.0))) AS l1_part,
         sum((x.value - coalesce(t.b, 0.0)) * (x.value - coalesce(t.b, 0.0))) AS l2_part,
         sum(coalesce(t.b, 0.0)) AS shared_b, sum(coalesce(t.b, 0.0) * coalesce(t.b, 0.0)) AS shared_b2
  FROM {m} x LEFT JOIN {m}_t t USING (term) GROUP BY x.doc_num
),
{m}_sim AS (
  SELECT c.doc_num,
         coalesce(p.l1_part, 0.0) + greatest(tb.tb1 - coalesce(p.shared_b, 0.0), 0.0) AS doc_l1_norm,
         sqrt(greatest(coalesce(p.l2_part, 0.0) + tb.tb2 - coalesce(p.shared_b2, 0.0), 0.0)) AS doc_l2_norm,
         CASE WHEN coalesce(p.a2, 0.0) > 0 AND tb.tb2 > 0 THEN p.dot / (sqrt(p.a2) * sqrt(tb.tb2)) ELSE 0.0 END
           AS doc_cosine_similarity,
         CASE WHEN coalesce(p.a2, 0.0) + tb.tb2 - coalesce(p.dot, 0.0) > 0
              THEN coalesce(p.dot, 0.0) / (coalesce(p.a2, 0.0) + tb.tb2 - coalesce(p.dot, 0.0)) ELSE 0.0 END
           AS doc_jaccard_similarity,
         c.abstract_summary, c.doc_type
  FROM corpus c LEFT JOIN {m}_pd p USING (doc_num), {m}_tb tb
)"""
