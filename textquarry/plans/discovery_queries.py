"""Related documents, vocabulary coverage and topic labelling queries.

Target words and topic/label words are taken from the corpus vocabulary
itself (by corpus frequency rank), so the queries scale with the data and
every word is guaranteed to have a vector:
targets = ranks 1-3; topics = ranks 1-4, each with two labels from ranks
5-12 (topic i gets ranks 3+2i and 4+2i).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cooccur, features, insight, related
from .catalog import register
from .corpus import build_corpus, corpus_ctes, once_per_corpus

R = 6


def _with(*ctes):
    return "WITH " + ",".join(ctes)


def _vocab_ranked(c):
    return c.vocab.orderBy(F.col("corpus_tf").desc(), F.col("term")).limit(12).select("term", "corpus_tf")


def _targets(spark, c):
    words = [r["term"] for r in _vocab_ranked(c).collect()][:3]
    return spark.createDataFrame([(w,) for w in words], "target_word string")


def _topics(spark, c):
    words = [r["term"] for r in _vocab_ranked(c).collect()]
    rows = [(words[i - 1], [words[2 + 2 * i], words[3 + 2 * i]]) for i in range(1, 5)]
    return insight.topics_frame(spark, rows)


BASE_CTES = """
vrank AS (SELECT term, row_number() OVER (ORDER BY corpus_tf DESC, term) AS vr FROM vocab),
targets AS (SELECT term AS target_word FROM vrank WHERE vr <= 3),
vec AS (SELECT term, doc_num AS dim, tf::DOUBLE AS value FROM tf),
nrm AS (SELECT term, sqrt(sum(value * value)) AS nrm FROM vec GROUP BY term),
topics AS (
  SELECT a.term AS topic, b.term AS l0, c.term AS l1
  FROM vrank a JOIN vrank b ON b.vr = 3 + 2 * a.vr JOIN vrank c ON c.vr = 4 + 2 * a.vr WHERE a.vr <= 4
),
lab AS (SELECT topic, 0 AS label_pos, l0 AS label FROM topics UNION ALL SELECT topic, 1, l1 FROM topics),
ttargets AS (SELECT topic AS target_word FROM topics),
ltargets AS (SELECT DISTINCT label AS target_word FROM lab)"""


def term_sim_ctes(name: str, targets: str) -> str:
    return f"""
{name}_tvec AS (SELECT t.target_word, v.dim, v.value AS tval FROM {targets} t JOIN vec v ON v.term = t.target_word),
{name}_dots AS (
  SELECT tv.target_word, v.term, sum(v.value * tv.tval) AS dot
  FROM {name}_tvec tv JOIN vec v ON v.dim = tv.dim WHERE v.term IN (SELECT term FROM vocab) GROUP BY ALL
),
{name} AS (
  SELECT t.target_word, vb.term, d.dot / (n1.nrm * n2.nrm) AS score
  FROM {targets} t CROSS JOIN vocab vb
  LEFT JOIN {name}_dots d ON d.target_word = t.target_word AND d.term = vb.term
  LEFT JOIN nrm n1 ON n1.term = vb.term LEFT JOIN nrm n2 ON n2.term = t.target_word
),
{name}_top AS (
  SELECT target_word, term, coalesce(score, 0.0) AS score FROM {name}
  QUALIFY row_number() OVER (PARTITION BY target_word ORDER BY round(score, 9) DESC NULLS LAST, term) <= 20
)"""


def related_ctes(name: str, sims: str, targets: str) -> str:
    return f"""
{name}_sum AS (SELECT k.target_word, x.doc_num, sum(x.value) AS s FROM {sims}_top k JOIN xcount x USING (term) GROUP BY ALL),
{name} AS (
  SELECT t.target_word, c.doc_num, coalesce(r.s, 0.0) AS doc_score,
         row_number() OVER (PARTITION BY t.target_word ORDER BY coalesce(r.s, 0.0) DESC, c.doc_num) AS rank
  FROM {targets} t CROSS JOIN corpus c LEFT JOIN {name}_sum r ON r.target_word = t.target_word AND r.doc_num = c.doc_num
  QUALIFY rank <= 100
)"""


INSIGHT_CTES = """
lv0 AS (SELECT *, sqrt(sum(score * score) OVER (PARTITION BY target_word)) AS n FROM lsim_top),
lv AS (SELECT target_word AS label, term, CASE WHEN n > 0 THEN score / n ELSE 0.0 END AS w FROM lv0),
raw AS (SELECT x.doc_num, lv.label, sum(x.value * lv.w) AS raw FROM xtfidf x JOIN lv USING (term) GROUP BY ALL),
scored AS (
  SELECT r.target_word AS topic, r.doc_num, l.label_pos, l.label, coalesce(rw.raw, 0.0) AS raw
  FROM trel r JOIN lab l ON l.topic = r.target_word LEFT JOIN raw rw ON rw.doc_num = r.doc_num AND rw.label = l.label
),
s1 AS (SELECT *, max(raw) OVER (PARTITION BY doc_num, topic) AS m FROM scored),
s2 AS (
  SELECT *, sum(exp(raw - m)) OVER (PARTITION BY doc_num, topic) AS z,
         row_number() OVER (PARTITION BY doc_num, topic ORDER BY raw DESC, label_pos) AS rn
  FROM s1
),
insight AS (SELECT doc_num, topic, label, exp(raw - m) / z AS score FROM s2 WHERE rn = 1)"""


def _all_ctes():
    return _with(
        corpus_ctes(), BASE_CTES,
        term_sim_ctes("tsim", "targets"), related_ctes("rel", "tsim", "targets"),
        term_sim_ctes("ttsim", "ttargets"), related_ctes("trel", "ttsim", "ttargets"),
        term_sim_ctes("lsim", "ltargets"), INSIGHT_CTES,
    )


def _vectors(c):
    return related.vectors_from_counts(c.tf)


@register(
    "vocab_coverage",
    _with(corpus_ctes(lang=None))
    + """,
known AS (SELECT DISTINCT term FROM (SELECT unnest(tokens) AS term FROM corpus WHERE lang = 'en')),
judged AS (SELECT vocab.term, known.term IS NULL AS lacks FROM vocab LEFT JOIN known USING (term))
SELECT count(*) FILTER (WHERE lacks)::BIGINT AS missing, count(*)::BIGINT AS tokens,
       round(count(*) FILTER (WHERE lacks) / count(*), 6) AS missing_share
FROM judged""",
)
def q_vocab_coverage(spark, sf_dir):
    """Terms of the vocabulary of all languages that the English vectors lack."""
    every = build_corpus(spark, sf_dir, lang=None)
    vec = _vectors(build_corpus(spark, sf_dir))
    return related.vocab_coverage(every.vocab, vec).select("missing", "tokens", F.round("missing_share", R).alias("missing_share"))


@register(
    "term_similarity",
    _all_ctes() + "\nSELECT target_word, term, round(score, 6) AS score FROM tsim",
)
def q_term_similarity(spark, sf_dir):
    c = build_corpus(spark, sf_dir)
    s = related.term_similarity(_vectors(c), _targets(spark, c), c.vocab)
    return s.select("target_word", "term", F.round("score", R).alias("score"))


CO_SQL = "WITH " + corpus_ctes() + """,
tok AS (SELECT doc_num, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM corpus),
near AS (
  SELECT a.term AS a, b.term AS b FROM tok a, generate_series(1, 5) g(o), tok b
  WHERE b.doc_num = a.doc_num AND b.pos = a.pos + o
    AND a.term IN (SELECT term FROM vocab) AND b.term IN (SELECT term FROM vocab)
),
co AS (
  SELECT term, context, count(*)::BIGINT AS n
  FROM (SELECT a AS term, b AS context FROM near UNION ALL SELECT b, a FROM near) GROUP BY ALL
),
mass AS (SELECT term, sum(n)::DOUBLE AS s FROM co GROUP BY term),
pmi AS (
  SELECT term, context, ln(n * (SELECT sum(s) FROM mass) / (a.s * b.s)) AS pmi
  FROM co JOIN mass a USING (term) JOIN mass b ON b.term = co.context
)"""


@once_per_corpus
def _cooccurrence(spark, sf_dir, c):
    return cooccur.cooccurrence(c.docs, c.vocab).checkpoint(eager=True)


@once_per_corpus
def _term_vectors(spark, sf_dir, c):
    pmi = cooccur.positive_pmi(_cooccurrence(spark, sf_dir))
    return cooccur.term_vectors(pmi, c.vocab, features.FEATURE_CAP).checkpoint(eager=True)


@register("cooccurrence", CO_SQL + "\nSELECT term, context, n FROM co")
def q_cooccurrence(spark, sf_dir):
    return _cooccurrence(spark, sf_dir)


@register("positive_pmi", CO_SQL + "\nSELECT term, context, round(pmi, 6) AS pmi FROM pmi WHERE pmi > 1e-9")
def q_positive_pmi(spark, sf_dir):
    pmi = cooccur.positive_pmi(_cooccurrence(spark, sf_dir)).where("pmi > 1e-9")
    return pmi.select("term", "context", F.round("pmi", R).alias("pmi"))


@register("term_vectors")
def q_term_vectors(spark, sf_dir):
    """Term vectors: the 50 leading singular vectors of the positive PMI."""
    return _term_vectors(spark, sf_dir)


@register("term_vector_similarity")
def q_term_vector_similarity(spark, sf_dir):
    """Similarity of all terms to the target words by their PMI vectors."""
    c = build_corpus(spark, sf_dir)
    return related.term_similarity(_term_vectors(spark, sf_dir), _targets(spark, c), c.vocab)


def _related(spark, c, targets):
    vec = _vectors(c)
    related.check_targets(vec, targets)
    scores = related.term_similarity(vec, targets, c.vocab)
    return related.related_documents(c.x_count, scores, c.docs)


@register(
    "related_documents",
    _all_ctes() + "\nSELECT target_word, doc_num, round(doc_score, 6) AS doc_score, rank FROM rel",
)
def q_related_documents(spark, sf_dir):
    c = build_corpus(spark, sf_dir)
    r = _related(spark, c, _targets(spark, c))
    return r.select("target_word", "doc_num", F.round("doc_score", R).alias("doc_score"), "rank")


@register(
    "interested_documents",
    _all_ctes() + "\nSELECT r.target_word, r.doc_num, c.source FROM rel r JOIN corpus c USING (doc_num)",
)
def q_interested_documents(spark, sf_dir):
    c = build_corpus(spark, sf_dir)
    r = _related(spark, c, _targets(spark, c))
    return related.interested_documents(r, c.docs, ["source"]).select("target_word", "doc_num", "source")


def _insight(spark, sf_dir):
    c = build_corpus(spark, sf_dir)
    return insight.label_documents(c.x_tfidf, c.x_count, c.docs, _topics(spark, c), _vectors(c), c.vocab)


@register(
    "label_documents",
    _all_ctes() + "\nSELECT doc_num, topic, label, round(score, 6) AS score FROM insight",
)
def q_label_documents(spark, sf_dir):
    return _insight(spark, sf_dir).select("doc_num", "topic", "label", F.round("score", R).alias("score"))


@register(
    "topic_summary",
    _all_ctes()
    + """
SELECT topic, label, count(doc_num)::BIGINT AS doc_num_count, round(avg(score), 6) AS score_mean,
       round(median(score), 6) AS score_median
FROM insight GROUP BY topic, label""",
)
def q_topic_summary(spark, sf_dir):
    s = insight.topic_summary(_insight(spark, sf_dir))
    return s.select("topic", "label", "doc_num_count", F.round("score_mean", R).alias("score_mean"),
                    F.round("score_median", R).alias("score_median"))


@register(
    "score_histogram",
    _all_ctes()
    + """
SELECT topic, label,
       CASE WHEN score < 0 THEN 0 WHEN score >= 1 THEN 11 ELSE floor(score * 10)::BIGINT + 1 END AS bucket,
       count(*)::BIGINT AS count
FROM insight GROUP BY ALL""",
)
def q_score_histogram(spark, sf_dir):
    return insight.score_histogram(_insight(spark, sf_dir))
