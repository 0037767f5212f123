"""Language identification by character-trigram naive Bayes.

Profiles are trigram counts per language learned from labelled text; a
document is scored against every language over the trigrams known in
any language, with add-one smoothing. All steps are explode, join and
grouped aggregation; the profile table is bounded by the number of
distinct trigrams times the number of languages and is broadcast only
behind a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_spaces
from .joins import checked_broadcast

HEAD_WORDS = 50
TRIGRAM = r"(?s)(?=(.{3}))"


def head_text(col: str, words: int | None = HEAD_WORDS):
    """First ``words`` single-space words (all of them for None), lower-cased."""
    if words is None:
        return F.lower(F.col(col))
    return F.lower(F.array_join(F.slice(split_spaces(col), 1, words), " "))


def _exploded(df: DataFrame, keep: str, text) -> DataFrame:
    # Every overlapping 3-character substring in one regex pass (a lookahead
    # group matches at each position; '.' with (?s) also takes newlines).
    return df.select(
        F.col(keep).alias("key"), F.explode_outer(F.regexp_extract_all(text, F.lit(TRIGRAM), 1)).alias("g")
    ).where(F.col("g").isNotNull())


def trigrams(df: DataFrame, key: str, text: str, words: int | None = HEAD_WORDS) -> DataFrame:
    """``(key, g, n)``: character trigram counts of the document head (of
    the whole text for ``words=None``)."""
    return _exploded(df, key, head_text(text, words)).groupBy("key", "g").agg(F.count(F.lit(1)).alias("n"))


def train_language_profiles(df: DataFrame, key: str, text: str, lang: str, words: int | None = None) -> DataFrame:
    """``(lang, g, logp)`` for every language and every trigram seen in any
    language: ``ln((c + 1) / (N_lang + V))``. Whole texts are counted unless
    ``words`` limits them to their first words."""
    # (languages x distinct trigrams) counts: small, and read three times
    # (vocabulary size, language list, profile), so written once.
    c = (
        _exploded(df, lang, head_text(text, words)).groupBy(F.col("key").alias("lang"), "g")
        .agg(F.count(F.lit(1)).alias("c")).checkpoint(eager=True)
    )
    totals = c.groupBy("lang").agg(F.sum("c").alias("N"))
    distinct = c.select("g").distinct()
    v = distinct.count()
    langs = [r[0] for r in totals.select("lang").collect()]
    full = distinct.select("g", F.explode(F.array(*[F.lit(x) for x in sorted(langs)])).alias("lang"))
    full = full.join(c, ["lang", "g"], "left").join(checked_broadcast(totals), "lang")
    return full.select(
        "lang", "g",
        F.log((F.coalesce(F.col("c"), F.lit(0)) + F.lit(1.0)) / (F.col("N") + F.lit(float(v)))).alias("logp"),
    ).checkpoint(eager=True)


def _best_language(tri: DataFrame, langs: list[str], packed: DataFrame) -> DataFrame:
    """``(key, lang, score)`` of the documents that hold a known trigram.

    ``tri`` is ``(key, g)``, a row for every occurrence: a document's rows stand
    together in one task and are summed there, so one row a document is shuffled."""
    scores = (
        tri.join(packed, "g").groupBy("key").agg(*[F.sum(F.col("lp")[i]).alias(f"s{i}") for i in range(len(langs))])
        .select("key", F.array(*[F.col(f"s{i}") for i in range(len(langs))]).alias("s"))
    )
    names = F.array(*[F.lit(x) for x in langs])
    # Best = largest score, earliest (alphabetical) language on a tie.
    best = F.array_max(F.zip_with("s", F.sequence(F.lit(0), F.lit(len(langs) - 1)),
                                  lambda sc, i: F.struct(sc.alias("score"), (-i).alias("neg"))))
    return scores.select("key", best.alias("b")).select(
        "key", F.element_at(names, -F.col("b.neg") + 1).alias("lang"), F.col("b.score").alias("score")
    )


def identify_language(df: DataFrame, key: str, text: str, profiles: DataFrame, words: int | None = HEAD_WORDS,
                      summary: str | None = None) -> DataFrame:
    """``(key, lang_pred, score)``: the best-scoring language (ties: language
    ascending). A document whose head (first ``words`` words) holds no known
    trigram is tried again by its distinct words, then by its ``summary``
    column if one is given; what is left is ``unknown``.

    Each trigram carries the log-probabilities of all languages as one
    array (languages sorted), so a document's trigram rows are summed to
    one score per language instead of being multiplied by their number. Texts
    stay where they are: only scores and keys are shuffled.
    """
    langs = sorted(r[0] for r in profiles.select("lang").distinct().collect())
    packed = checked_broadcast(profiles.groupBy("g").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lang", "logp"))), lambda e: e["logp"]).alias("lp")
    ))
    if not langs:
        return df.select(key, F.lit("unknown").alias("lang_pred"), F.lit(None).cast("double").alias("score"))
    picked = _best_language(_exploded(df, key, head_text(text, words)), langs, packed).checkpoint(eager=True)
    tries = [F.lower(F.array_join(F.array_distinct(split_spaces(text)), " "))]
    if summary is not None:
        tries.append(F.lower(F.col(summary)))
    for t in tries:
        # the keys are compared first, the texts are sought by the few that are left
        done = picked.select(F.col("key").alias("_done"))
        left = df.select(F.col(key).alias("_left")).join(done, F.col("_left") == F.col("_done"), "left_anti").distinct()
        left = checked_broadcast(left.checkpoint(eager=True))
        tri = _exploded(df.join(left, F.col(key) == F.col("_left"), "left_semi"), key, t)
        picked = picked.unionByName(_best_language(tri, langs, packed)).checkpoint(eager=True)
    out = df.select(F.col(key).alias("key")).join(picked, "key", "left")
    return out.select(
        F.col("key").alias(key),
        F.coalesce(F.col("lang"), F.lit("unknown")).alias("lang_pred"),
        "score",
    )
