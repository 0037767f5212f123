import datetime
import re

from pyspark.sql import functions as F

from textquarry.functions import text as T
from textquarry.functions.stopwords import CUSTOM_STOPWORDS, english_stopwords, full_stopwords


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_stopword_sets():
    assert len(CUSTOM_STOPWORDS) == len(set(CUSTOM_STOPWORDS)) == 103
    eng = english_stopwords()
    assert "the" in eng and len(eng) > 100
    full = set(full_stopwords())
    assert {"fig.", "al.", "!", "~"} <= full


def test_split_words_matches_python(spark):
    texts = ["a  b\tc\nd", "  lead", "x y z", "\x1cq\x1dw", ""]
    got = one(spark, [(t,) for t in texts], "t string", T.split_words("t"))
    assert got == [t.split() for t in texts]


def test_truncate_words(spark):
    rows = [("one two three",), ("a  b",), (None,)]
    got = one(spark, rows, "t string", T.truncate_words("t", 2))
    assert got == ["one two...", "a ...", None]


def test_summary_or_body(spark):
    df = spark.createDataFrame([("", "w1 w2 w3"), ("x y z", "b"), ("short", "b")], "a string, b string")
    got = [r[0] for r in df.select(T.summary_or_body("a", "b", 2)).collect()]
    assert got == ["w1 w2...", "x y...", "short"]


def test_abbreviate_list(spark):
    rows = [("Smith",), ("Smith;Lee",), ("Smith;Lee;Wong",), (None,)]
    got = one(spark, rows, "a string", T.abbreviate_list("a", ";", 2))
    assert got == ["Smith", "Smith. Lee", "Smith. Lee...", None]


def test_parse_pub_date(spark):
    rows = [("2020",), ("2020-03-05",), ("2020-3-5",), ("05/03/2020",), ("abc",), (None,), ("20",)]
    got = one(spark, rows, "d string", T.parse_pub_date("d"))
    assert got == [datetime.date(2020, 1, 1), datetime.date(2020, 3, 5), datetime.date(2020, 3, 5),
                   None, None, None, None]


def test_singularize_rules(spark):
    words = ["people", "women", "wives", "menus", "virus", "glass", "analysis", "it's", "studies", "cases", "cells", "data"]
    got = one(spark, [(w,) for w in words], "w string", T.singularize("w"))
    assert got == ["person", "woman", "wife", "menu", "virus", "glass", "analysis", "it's", "study", "case", "cell", "data"]


def test_tokenize_filters(spark):
    text = "The Virus, SPREAD! fast; café 42abc ab naïve résumé Über x1y the"
    got = one(spark, [(text,)], "t string", T.tokenize("t", full_stopwords()))[0]
    # lower-cased, longer than two, ASCII-letter start, letters only, no stop words
    assert got == ["virus", "spread", "fast", "café", "naïve", "résumé"]


def test_strip_non_alnum(spark):
    got = one(spark, [("it's!",), ("--",), ("Éa1",)], "w string", F.lower(T.strip_non_alnum("w")))
    assert got == ["its", "", "a1"]


def test_identify_language_shuffles_no_trigrams(spark):
    from textquarry.operators import language

    train = spark.createDataFrame([(1, "the cat and the hat", "en"), (2, "le chat et le chapeau", "fr")],
                                  "id long, text string, lang string")
    prof = language.train_language_profiles(train, "id", "text", "lang")
    docs = spark.createDataFrame([(1, "the hat"), (2, "le chat"), (3, "zz"), (None, "the"), (4, "qq " * 60 + "chapeau"), (4, "the")],
                                 "id long, text string")
    out = language.identify_language(docs, "id", "text", prof)
    assert sorted((r.id or 0, r.lang_pred) for r in out.collect()) == [
        (0, "unknown"), (1, "en"), (2, "fr"), (3, "unknown"), (4, "en"), (4, "en")]
    # a trigram is a row where its document is, and summed there: no exchange by document and trigram
    plan = language._best_language(language._exploded(docs, "id", language.head_text("text")), ["en", "fr"],
                                   prof.groupBy("g").agg({"logp": "collect_list"}).toDF("g", "lp"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[key#\d+L?\],", text) and text.count("Aggregate [") == 2
