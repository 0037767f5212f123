"""Stop-word sets.

The full set is Spark's English stop-word list (the one
``StopWordsRemover.loadDefaultStopWords("english")`` returns), the
corpus-specific words below and every ASCII punctuation character. The
words are literals, so neither a JVM nor Spark's jar folder is needed.
"""

from __future__ import annotations

import functools
import string

# Corpus-specific stop words that must equal the reference set.
# First group: words found in most paper layouts; second group: general words.
CUSTOM_STOPWORDS = (
    "doi", "preprint", "copyright", "peer", "reviewed", "org", "https", "et", "al", "author", "figure",
    "rights", "reserved", "permission", "biorxiv", "medrxiv", "license", "fig", "fig.",
    "al.", "elsevier", "pmc", "czi",
    "a", "after", "all", "also", "an", "are", "and", "as", "at", "among", "am",
    "be", "been", "base", "between", "but", "by", "besides",
    "can", "cannot", "could",
    "did", "do", "does", "during",
    "either",
    "for", "from",
    "have", "has", "had", "however", "how",
    "in", "into", "is", "it", "its",
    "just",
    "less", "lot", "lots",
    "more", "most", "may", "much",
    "not", "no", "nor", "neither",
    "on", "or", "of", "our", "off",
    "put",
    "should", "still",
    "to", "that", "than", "the", "this", "these", "those", "there", "their",
    "use", "used", "using",
    "very",
    "was", "we", "were", "which", "with", "who", "where", "while", "would",
)

PUNCTUATION = tuple(string.punctuation)


# The English list published with Spark (Apache License 2.0).
ENGLISH_STOPWORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is are
    was were be been being have has had having do does did doing a an the and but if or because as until while
    of at by for with about against between into through during before after above below to from up down in out
    on off over under again further then once here there when where why how all any both each few more most
    other some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll
    she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
    you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
    shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's
    who's why's would
    """.split()
)


def english_stopwords() -> tuple[str, ...]:
    """Spark's default English stop words."""
    return ENGLISH_STOPWORDS


@functools.lru_cache(maxsize=None)
def full_stopwords() -> tuple[str, ...]:
    """English list ∪ custom list ∪ punctuation characters, sorted."""
    return tuple(sorted(set(english_stopwords()) | set(CUSTOM_STOPWORDS) | set(PUNCTUATION)))


def stopword_frame(spark, words=None):
    """The stop words as a one-column DataFrame ``word`` (small, broadcastable)."""
    words = full_stopwords() if words is None else tuple(words)
    return spark.createDataFrame([(w,) for w in sorted(set(words))], "word string")


def sql_list(words) -> str:
    """Words as a SQL list literal, for oracle SQL."""
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
