"""Queries over the term matrices: vocabulary and matrices, target-versus-all
measures, MinHash, SimHash and the method rank tables.

Doubles are rounded to 6 digits in the output; values that are ranked are
first rounded to 9 digits so that ties do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import counts, embed, joins, minhash, similarity, simhash
from .catalog import register
from .corpus import build_corpus, corpus_ctes, sim_ctes

R = 6          # output rounding
RANK_R = 9     # rounding of ranked values
SWEEP = (50, 100, 150, 200)


def _r(c, name=None, digits=R):
    col = F.round(F.col(c), digits)
    return col.alias(name or c)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# ---------------------------------------------------------------- matrices

@register("vocabulary", _with(corpus_ctes()) + "\nSELECT term, term_id, corpus_tf, df FROM vocab")
def q_vocabulary(spark, sf_dir):
    return build_corpus(spark, sf_dir).vocab.select("term", "term_id", "corpus_tf", "df")


@register("count_matrix", _with(corpus_ctes()) + "\nSELECT doc_num, term, value FROM xcount")
def q_count_matrix(spark, sf_dir):
    return build_corpus(spark, sf_dir).x_count


@register("clip_matrix", _with(corpus_ctes()) + "\nSELECT doc_num, term, value FROM xclip")
def q_clip_matrix(spark, sf_dir):
    return build_corpus(spark, sf_dir).x_clip


@register("tfidf_matrix", _with(corpus_ctes()) + "\nSELECT doc_num, term, round(value, 6) AS value FROM xtfidf")
def q_tfidf_matrix(spark, sf_dir):
    return build_corpus(spark, sf_dir).x_tfidf.select("doc_num", "term", _r("value"))


@register(
    "bag_of_words",
    _with(corpus_ctes()) + "\nSELECT tf.doc_num, vocab.term_id, tf.tf::BIGINT AS tf FROM tf JOIN vocab USING (term)",
)
def q_bag_of_words(spark, sf_dir):
    from ..operators.features import bag_of_words

    c = build_corpus(spark, sf_dir)
    return bag_of_words(c.tf, c.vocab)


# ------------------------------------------------------- exact measures (K1)

def _sim_sql(m: str) -> str:
    return _with(corpus_ctes(), sim_ctes(m)) + f"""
SELECT doc_num, round(doc_l1_norm, 6) AS doc_l1_norm, round(doc_l2_norm, 6) AS doc_l2_norm,
       round(doc_cosine_similarity, 6) AS doc_cosine_similarity, abstract_summary, doc_type
FROM {m}_sim"""


def _sim(c, x):
    s = similarity.document_similarity(x, c.docs, c.target, attrs=["abstract_summary", "doc_type"])
    return s.select("doc_num", _r("doc_l1_norm"), _r("doc_l2_norm"), _r("doc_cosine_similarity"),
                    "abstract_summary", "doc_type")


@register("doc_similarity_count", _sim_sql("xcount"))
def q_doc_similarity_count(spark, sf_dir):
    c = build_corpus(spark, sf_dir)
    return _sim(c, c.x_count)


@register("doc_similarity_clip", _sim_sql("xclip"))
def q_doc_similarity_clip(spark, sf_dir):
    c = build_corpus(spark, sf_dir)
    return _sim(c, c.x_clip)


@register("doc_similarity_tfidf", _sim_sql("xtfidf"))
def q_doc_similarity_tfidf(spark, sf_dir):
    c = build_corpus(spark, sf_dir)
    return _sim(c, c.x_tfidf)


# ----------------------------------------------------------------- MinHash

def _minhash_ctes(n_max: int = max(SWEEP)) -> str:
    sizes = ", ".join(f"({n})" for n in SWEEP)
    return f"""
perm AS (
  SELECT v.term, p.perm,
         row_number() OVER (PARTITION BY p.perm ORDER BY md5(p.perm::VARCHAR || ':' || v.term), v.term) AS rank
  FROM vocab v, range({n_max}) AS p(perm)
),
sigl AS (SELECT x.doc_num, p.perm, min(p.rank) AS r FROM xclip x JOIN perm p USING (term) WHERE x.value > 0 GROUP BY ALL),
sig AS (
  SELECT c.doc_num, p.perm, coalesce(s.r, 1)::BIGINT AS r
  FROM corpus c CROSS JOIN range({n_max}) AS p(perm)
  LEFT JOIN sigl s ON s.doc_num = c.doc_num AND s.perm = p.perm
),
sizes AS (SELECT * FROM (VALUES {sizes}) AS v(num_perm)),
sw AS (
  SELECT z.num_perm, s.doc_num, s.perm, s.r, t.r AS tr
  FROM sig s JOIN sig t ON t.perm = s.perm AND t.doc_num = (SELECT t FROM target)
  JOIN sizes z ON s.perm < z.num_perm
),
mh AS (
  SELECT num_perm, doc_num,
         CASE WHEN sum(r * r) > 0 AND sum(tr * tr) > 0
              THEN sum(r * tr)::DOUBLE / (sqrt(sum(r * r)::DOUBLE) * sqrt(sum(tr * tr)::DOUBLE)) ELSE 0.0 END
           AS sig_cosine_similarity,
         len(list_intersect(list(r), list(tr)))::DOUBLE
           / (len(list_distinct(list(r))) + len(list_distinct(list(tr))) - len(list_intersect(list(r), list(tr))))
           AS sig_jaccard_similarity
  FROM sw GROUP BY num_perm, doc_num
),
sweep AS (
  SELECT mh.num_perm, mh.doc_num, mh.sig_cosine_similarity, mh.sig_jaccard_similarity,
         s.doc_jaccard_similarity, s.doc_l1_norm, s.doc_l2_norm, s.doc_cosine_similarity
  FROM mh FULL JOIN xclip_sim s USING (doc_num)
),
quality AS (
  SELECT num_perm, CASE WHEN isnan(corr(sig_jaccard_similarity, doc_jaccard_similarity)) THEN NULL
                        ELSE corr(sig_jaccard_similarity, doc_jaccard_similarity) END AS correlation,
         count(*)::BIGINT AS n
  FROM sweep GROUP BY num_perm
),
best AS (SELECT num_perm, correlation FROM quality WHERE correlation IS NOT NULL
         ORDER BY correlation DESC, num_perm DESC LIMIT 1)"""


def _mh_base(spark, sf_dir):
    c = build_corpus(spark, sf_dir)
    exact = similarity.document_similarity(c.x_clip, c.docs, c.target, jaccard=True)
    sweep = minhash.minhash_sweep(c.x_clip, c.docs, c.vocab, c.target, SWEEP, exact=exact)
    return c, sweep


def _quality(sweep):
    return similarity.pearson(sweep, "sig_jaccard_similarity", "doc_jaccard_similarity", by=["num_perm"])


@register(
    "minhash_signature",
    _with(corpus_ctes(), _minhash_ctes(50)) + "\nSELECT doc_num, list(r ORDER BY perm) AS sig FROM sig GROUP BY doc_num",
)
def q_minhash_signature(spark, sf_dir):
    c = build_corpus(spark, sf_dir)
    ranks = minhash.rank_arrays(minhash.permutations(c.vocab, 50))
    return minhash.minhash_signature(c.x_clip, c.docs, ranks, 50).select(
        "doc_num", F.transform("sig", lambda v: v.cast("bigint")).alias("sig")
    )


@register(
    "minhash_similarity",
    _with(corpus_ctes(), sim_ctes("xclip"), _minhash_ctes()) + """
SELECT doc_num, round(sig_cosine_similarity, 6) AS sig_cosine_similarity,
       round(sig_jaccard_similarity, 6) AS sig_jaccard_similarity,
       round(doc_jaccard_similarity, 6) AS doc_jaccard_similarity
FROM sweep WHERE num_perm = 50""",
)
def q_minhash_similarity(spark, sf_dir):
    c = build_corpus(spark, sf_dir)
    ranks = minhash.rank_arrays(minhash.permutations(c.vocab, 50))
    sig = minhash.minhash_signature(c.x_clip, c.docs, ranks, 50)
    m = minhash.minhash_similarity(sig, c.x_clip, c.docs, c.target)
    return m.select("doc_num", _r("sig_cosine_similarity"), _r("sig_jaccard_similarity"), _r("doc_jaccard_similarity"))


@register(
    "minhash_sweep",
    _with(corpus_ctes(), sim_ctes("xclip"), _minhash_ctes()) + """
SELECT num_perm, doc_num, round(sig_cosine_similarity, 6) AS sig_cosine_similarity,
       round(sig_jaccard_similarity, 6) AS sig_jaccard_similarity,
       round(doc_jaccard_similarity, 6) AS doc_jaccard_similarity,
       round(doc_l1_norm, 6) AS doc_l1_norm, round(doc_l2_norm, 6) AS doc_l2_norm,
       round(doc_cosine_similarity, 6) AS doc_cosine_similarity
FROM sweep""",
)
def q_minhash_sweep(spark, sf_dir):
    _, sweep = _mh_base(spark, sf_dir)
    return sweep.select(
        "num_perm", "doc_num", _r("sig_cosine_similarity"), _r("sig_jaccard_similarity"), _r("doc_jaccard_similarity"),
        _r("doc_l1_norm"), _r("doc_l2_norm"), _r("doc_cosine_similarity"),
    )


@register(
    "minhash_quality",
    _with(corpus_ctes(), sim_ctes("xclip"), _minhash_ctes())
    + "\nSELECT num_perm, round(correlation, 6) AS correlation, n FROM quality",
)
def q_minhash_quality(spark, sf_dir):
    _, sweep = _mh_base(spark, sf_dir)
    return _quality(sweep).select("num_perm", _r("correlation"), "n")


# The tail of Student's t as an integral of cos^(d-1) by Simpson's rule, less its value at the start.
PVALUE_SQL = """,
tail AS (
  SELECT num_perm, correlation, n, n - 2 AS d, atan(abs(correlation) / sqrt(1 - correlation * correlation)) AS a0
  FROM quality WHERE correlation IS NOT NULL AND n > 3 AND abs(correlation) < 1 AND correlation <> 0
),
span AS (
  SELECT *, least(pi() / 2, a0 + least(12 / sqrt(d - 1), 60 / ((d - 1) * tan(a0)))) - a0 AS w FROM tail
),
node AS (
  SELECT num_perm, CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
         * exp((d - 1) * ln(greatest(cos(a0 + w * i / 4000), 1e-300) / cos(a0))) * w / 12000 AS part
  FROM span, generate_series(0, 4000) g(i)
),
pv AS (
  SELECT num_perm, any_value(correlation) AS correlation, any_value(n) AS n,
         (ln(2) + lgamma((any_value(d) + 1) / 2) - lgamma(any_value(d) / 2) - 0.5 * ln(pi())
          + (any_value(d) - 1) * ln(cos(any_value(a0))) + ln(sum(part))) AS lp
  FROM span JOIN node USING (num_perm) GROUP BY num_perm
)
SELECT num_perm, round(correlation, 6) AS correlation, n, round(exp(lp), 6) AS pvalue, round(lp / ln(10), 4) AS log10_pvalue
FROM pv"""


@register("minhash_quality_pvalue", _with(corpus_ctes(), sim_ctes("xclip"), _minhash_ctes()) + PVALUE_SQL)
def q_minhash_quality_pvalue(spark, sf_dir):
    """Adds the two-sided p-value (t distribution) and its decimal logarithm."""
    _, sweep = _mh_base(spark, sf_dir)
    q = similarity.with_pvalue(_quality(sweep))
    return q.select("num_perm", _r("correlation"), "n", _r("pvalue"), F.round("log10_pvalue", 4).alias("log10_pvalue"))


@register(
    "minhash_best",
    _with(corpus_ctes(), sim_ctes("xclip"), _minhash_ctes())
    + "\nSELECT num_perm, round(correlation, 6) AS correlation FROM best",
)
def q_minhash_best(spark, sf_dir):
    _, sweep = _mh_base(spark, sf_dir)
    q = _quality(sweep).where(F.col("correlation").isNotNull())
    return counts.top_k(q, 1, [F.col("correlation").desc(), F.col("num_perm").desc()]).select(
        "num_perm", _r("correlation")
    )


# ----------------------------------------------------------------- SimHash

def _simhash_ctes(h: str) -> str:
    width = simhash.WIDTH[h]
    nbytes = width // 8
    byte = f"({nbytes - 1} - i.i // 8)" if h == "md5" else "(i.i // 8)"
    return f"""
bits_{h} AS (
  SELECT v.term, i.i AS bit,
         ((('0x' || substr({h}(v.term), 2 * {byte} + 1, 2))::INTEGER >> (7 - i.i % 8)) & 1) AS b
  FROM vocab v, range({width}) AS i(i)
),
fps_{h} AS (
  SELECT x.doc_num, b.bit, sum(x.value * (2 * b.b - 1)) AS s FROM xtfidf x JOIN bits_{h} b USING (term) GROUP BY ALL
),
fp_{h} AS (
  SELECT c.doc_num, i.i AS bit,
         CASE WHEN coalesce(f.s, 0.0) > 1e-9 THEN 1 WHEN coalesce(f.s, 0.0) < -1e-9 THEN 0 ELSE i.i % 2 END AS f
  FROM corpus c CROSS JOIN range({width}) AS i(i) LEFT JOIN fps_{h} f ON f.doc_num = c.doc_num AND f.bit = i.i
),
ham_{h} AS (
  SELECT a.doc_num, list(a.f ORDER BY a.bit) AS fp, sum(CASE WHEN a.f <> t.f THEN 1 ELSE 0 END)::BIGINT AS sig_hamming_distance
  FROM fp_{h} a JOIN fp_{h} t ON t.bit = a.bit AND t.doc_num = (SELECT t FROM target) GROUP BY a.doc_num
),
res_{h} AS (
  SELECT h.doc_num, h.fp, h.sig_hamming_distance, s.doc_cosine_similarity
  FROM xtfidf_sim s FULL JOIN ham_{h} h USING (doc_num)
),
corr_{h} AS (
  SELECT CASE WHEN isnan(corr(doc_cosine_similarity, sig_hamming_distance)) THEN NULL
              ELSE corr(doc_cosine_similarity, sig_hamming_distance) END AS c FROM res_{h}
)"""


SIMHASH_CHOICE_CTE = """
choice AS (
  SELECT CASE WHEN (SELECT c FROM corr_md5) < (SELECT c FROM corr_sha1) THEN 'md5' ELSE 'sha1' END AS chosen
)"""


def _simhash_result(c, h, cos=None):
    fp = simhash.simhash(c.x_tfidf, c.docs, c.vocab, h).checkpoint(eager=True)
    ham = simhash.hamming_to_target(fp, c.target)
    if cos is None:
        cos = similarity.document_similarity(c.x_tfidf, c.docs, c.target)
    return fp.join(ham, "doc_num").join(cos.select("doc_num", "doc_cosine_similarity"), "doc_num", "full")


def _simhash_query(h):
    sql = _with(corpus_ctes(), sim_ctes("xtfidf"), _simhash_ctes(h)) + f"""
SELECT doc_num, fp::BIGINT[] AS fp, sig_hamming_distance, round(doc_cosine_similarity, 6) AS doc_cosine_similarity
FROM res_{h}"""

    def fn(spark, sf_dir):
        c = build_corpus(spark, sf_dir)
        r = _simhash_result(c, h)
        return r.select("doc_num", F.transform("fp", lambda v: v.cast("bigint")).alias("fp"),
                        "sig_hamming_distance", _r("doc_cosine_similarity"))

    fn.__name__ = f"q_simhash_{h}"
    register(f"simhash_{h}", sql)(fn)


_simhash_query("md5")
_simhash_query("sha1")


def _simhash_corr(c, h, cos=None, result=None):
    r = result if result is not None else _simhash_result(c, h, cos)
    row = similarity.pearson(r, "doc_cosine_similarity", "sig_hamming_distance").first()
    return row["correlation"]


@register(
    "simhash_choice",
    _with(corpus_ctes(), sim_ctes("xtfidf"), _simhash_ctes("md5"), _simhash_ctes("sha1"), SIMHASH_CHOICE_CTE)
    + """
SELECT 'md5' AS hashing, round((SELECT c FROM corr_md5), 6) AS correlation, (SELECT chosen FROM choice) = 'md5' AS chosen
UNION ALL
SELECT 'sha1', round((SELECT c FROM corr_sha1), 6), (SELECT chosen FROM choice) = 'sha1'""",
)
def q_simhash_choice(spark, sf_dir):
    c = build_corpus(spark, sf_dir)
    cos = similarity.document_similarity(c.x_tfidf, c.docs, c.target).checkpoint(eager=True)
    cm, cs = _simhash_corr(c, "md5", cos), _simhash_corr(c, "sha1", cos)
    chosen = simhash.choose_hash(cm, cs)
    rows = [("md5", cm, chosen == "md5"), ("sha1", cs, chosen == "sha1")]
    df = spark.createDataFrame(rows, "hashing string, correlation double, chosen boolean")
    return df.select("hashing", _r("correlation"), "chosen")


# ------------------------------------------------------------- rank tables

RANK_MEASURES = (
    # name, source CTE / frame, value column, ascending
    ("tfidf_doc_cosine", "xtfidf_sim", "doc_cosine_similarity", False),
    ("count_doc_l2_norm", "xcount_sim", "doc_l2_norm", True),
    ("clip_doc_l1_norm", "xclip_sim", "doc_l1_norm", True),
    ("minhash_jaccard", "mh_best", "sig_jaccard_similarity", False),
    ("simhash_hamming", "sh_best", "sig_hamming_distance", True),
    ("doc2vec_cosine", "d2v_sim", "doc2vec_similarity", False),
)
BENCHMARK = "tfidf_doc_cosine"


def _rank_sql_ctes() -> str:
    parts = [corpus_ctes(), sim_ctes("xcount"), sim_ctes("xclip"), sim_ctes("xtfidf"), _minhash_ctes(),
             _simhash_ctes("md5"), _simhash_ctes("sha1"), SIMHASH_CHOICE_CTE]
    parts.append("""
mh_best AS (SELECT doc_num, sig_jaccard_similarity FROM sweep WHERE num_perm = (SELECT num_perm FROM best)),
sh_best AS (
  SELECT doc_num, sig_hamming_distance FROM res_md5 WHERE (SELECT chosen FROM choice) = 'md5'
  UNION ALL
  SELECT doc_num, sig_hamming_distance FROM res_sha1 WHERE (SELECT chosen FROM choice) = 'sha1'
),
hv AS (
  SELECT doc_num, ('0x' || substr(md5(term), 1, 4))::INTEGER % 32 AS dim,
         sum(value * CASE WHEN ('0x' || substr(md5(term), 5, 1))::INTEGER % 2 = 0 THEN 1.0 ELSE -1.0 END) AS s
  FROM xtfidf GROUP BY ALL
),
hn AS (SELECT doc_num, sum(s * s) AS n2 FROM hv GROUP BY doc_num),
hd AS (SELECT a.doc_num, sum(a.s * t.s) AS dot FROM hv a JOIN hv t ON t.dim = a.dim AND t.doc_num = (SELECT t FROM target)
       GROUP BY a.doc_num),
d2v_sim AS (
  SELECT c.doc_num, CASE WHEN hn.n2 > 0 AND tn.n2 > 0 THEN coalesce(hd.dot, 0.0) / (sqrt(hn.n2) * sqrt(tn.n2)) ELSE 0.0 END
           AS doc2vec_similarity
  FROM corpus c LEFT JOIN hn USING (doc_num) LEFT JOIN hd USING (doc_num)
  LEFT JOIN hn tn ON tn.doc_num = (SELECT t FROM target)
)""")
    for name, src, col, asc in RANK_MEASURES:
        d = "ASC" if asc else "DESC"
        parts.append(f"""
r_{name} AS (
  SELECT doc_num, rank() OVER (ORDER BY v {d}) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS {name}
  FROM (SELECT doc_num, round({col}::DOUBLE, {RANK_R}) AS v FROM {src})
)""")
    joins = " ".join(f"FULL JOIN r_{name} USING (doc_num)" for name, *_ in RANK_MEASURES[1:])
    cols = ", ".join(f"{name}::DOUBLE AS {name}" for name, *_ in RANK_MEASURES)
    parts.append(f"ranks AS (SELECT doc_num, {cols} FROM r_{RANK_MEASURES[0][0]} {joins})")
    diffs = ", ".join(f"{name} - {BENCHMARK} AS {name}" for name, *_ in RANK_MEASURES if name != BENCHMARK)
    parts.append(f"rdiff AS (SELECT doc_num, {diffs} FROM ranks)")
    return _with(*parts)


def _measures(spark, sf_dir):
    """The six measures, as name -> (frame, value column, ascending).

    They feed several driver decisions (best permutation
    count, chosen hash) and the final ranks, so each is checkpointed once.
    The independent inputs are submitted as concurrent Spark jobs (one
    driver thread each), so their small stages share the executors."""
    from concurrent.futures import ThreadPoolExecutor

    c = build_corpus(spark, sf_dir)

    def exact(x):
        return similarity.document_similarity(x, c.docs, c.target, jaccard=x is c.x_clip).checkpoint(eager=True)

    with ThreadPoolExecutor(max_workers=2) as pool:
        f_tfidf, f_clip = pool.submit(exact, c.x_tfidf), pool.submit(exact, c.x_clip)
        k_tfidf, k_clip = f_tfidf.result(), f_clip.result()
    k_count = similarity.document_similarity(c.x_count, c.docs, c.target)

    def sweep_job():
        return minhash.minhash_sweep(c.x_clip, c.docs, c.vocab, c.target, SWEEP, exact=k_clip).checkpoint(eager=True)

    def simhash_job(h):
        return _simhash_result(c, h, k_tfidf).checkpoint(eager=True)

    with ThreadPoolExecutor(max_workers=3) as pool:
        f_sweep = pool.submit(sweep_job)
        f_res = {h: pool.submit(simhash_job, h) for h in ("md5", "sha1")}
        sweep = f_sweep.result()
        res = {h: f.result() for h, f in f_res.items()}
    best = minhash.best_num_perm(_quality(sweep))
    mh = sweep.where(F.col("num_perm") == F.lit(best)).select("doc_num", "sig_jaccard_similarity")
    chosen = simhash.choose_hash(*[_simhash_corr(c, h, result=res[h]) for h in ("md5", "sha1")])
    sh = res[chosen].select("doc_num", "sig_hamming_distance")
    d2v = embed.embedding_similarity(embed.hashed_vectors(c.x_tfidf, c.docs).checkpoint(eager=True), c.target)
    frames = {"xtfidf_sim": k_tfidf, "xcount_sim": k_count, "xclip_sim": k_clip, "mh_best": mh, "sh_best": sh,
              "d2v_sim": d2v}
    measures = {}
    for name, src, col, asc in RANK_MEASURES:
        f = frames[src].select("doc_num", F.round(F.col(col).cast("double"), RANK_R).alias(col))
        measures[name] = (f, col, asc)
    return measures


def _ranks(spark, sf_dir):
    return similarity.rank_table(_measures(spark, sf_dir))


def _measure_sql() -> str:
    parts = "".join(
        f"m_{name} AS (SELECT doc_num, round({col}::DOUBLE, {RANK_R}) AS {name} FROM {src}),\n"
        for name, src, col, _ in RANK_MEASURES
    )
    joined = " ".join(f"FULL JOIN m_{name} USING (doc_num)" for name, *_ in RANK_MEASURES[1:])
    return _rank_sql_ctes() + ",\n" + parts + f"measures AS (SELECT * FROM m_{RANK_MEASURES[0][0]} {joined})"


@register(
    "measure_table",
    _measure_sql() + "\nSELECT doc_num, " + ", ".join(f"round({n}, 6) AS {n}" for n, *_ in RANK_MEASURES) + " FROM measures",
)
def q_measure_table(spark, sf_dir):
    """All six measures of every document side by side."""
    frames = [f.withColumnRenamed(col, name) for name, (f, col, _) in _measures(spark, sf_dir).items()]
    return joins.combine_results(frames).select("doc_num", *[_r(n) for n, *_ in RANK_MEASURES])


@register(
    "measure_top10",
    _measure_sql() + "\n" + "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS measure, * FROM (
  SELECT row_number() OVER (ORDER BY {n} {'ASC' if asc else 'DESC'} NULLS LAST, doc_num)::BIGINT AS position, doc_num,
         round({n}, 6) AS value FROM measures QUALIFY position <= 10)"""
        for n, _, _, asc in RANK_MEASURES
    ),
)
def q_measure_top10(spark, sf_dir):
    """The ten documents nearest to the target by each measure, in order."""
    out = None
    for name, (f, col, asc) in _measures(spark, sf_dir).items():
        v = F.col(col).asc_nulls_last() if asc else F.col(col).desc_nulls_last()
        top = counts.top_k(f, 10, [v, F.col("doc_num").asc()], ordinal="position").select(
            F.lit(name).alias("measure"), F.col("position").cast("bigint"), "doc_num", _r(col, "value"))
        out = top if out is None else out.unionByName(top)
    return out


@register("rank_table", _rank_sql_ctes() + "\nSELECT * FROM ranks")
def q_rank_table(spark, sf_dir):
    return _ranks(spark, sf_dir)


@register("rank_diff", _rank_sql_ctes() + "\nSELECT * FROM rdiff")
def q_rank_diff(spark, sf_dir):
    return similarity.rank_diff(_ranks(spark, sf_dir), BENCHMARK)


_DIFF_COLS = [name for name, *_ in RANK_MEASURES if name != BENCHMARK]


@register(
    "rank_variance",
    _rank_sql_ctes()
    + "\nSELECT metric, round(var_samp(v), 6) AS variance FROM (UNPIVOT rdiff ON "
    + ", ".join(_DIFF_COLS)
    + " INTO NAME metric VALUE v) GROUP BY metric",
)
def q_rank_variance(spark, sf_dir):
    d = similarity.rank_diff(_ranks(spark, sf_dir), BENCHMARK)
    v = counts.column_variance(d, _DIFF_COLS)
    return v.select("metric", _r("variance"))


@register(
    "rank_unpivot",
    _rank_sql_ctes()
    + "\nSELECT doc_num, approach, rank_difference FROM (UNPIVOT rdiff ON "
    + ", ".join(_DIFF_COLS)
    + " INTO NAME approach VALUE rank_difference)",
)
def q_rank_unpivot(spark, sf_dir):
    d = similarity.rank_diff(_ranks(spark, sf_dir), BENCHMARK)
    return d.unpivot(["doc_num"], _DIFF_COLS, "approach", "rank_difference")
