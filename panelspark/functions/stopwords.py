"""Stop words.

Spark's own English list (``StopWordsRemover.loadDefaultStopWords``) is the
default.  The same list is written out below as fixed values so that an
independent SQL check can inline it; a test asserts both are equal.
"""

from __future__ import annotations

# Spark 4.1.2 default English stop words, in Spark's order.
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's",
    "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't",
    "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't",
    "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could",
    "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
)


def spark_default_stop_words(language: str = "english") -> list[str]:
    """Spark's list; the fixed copy above where the JVM gateway is not
    reachable from Python (Spark Connect) and the language is English."""
    try:
        from pyspark.ml.feature import StopWordsRemover
        return list(StopWordsRemover.loadDefaultStopWords(language))
    except Exception:  # noqa: BLE001
        if language == "english":
            return list(ENGLISH_STOP_WORDS)
        raise


def stop_words_frame(spark, words=None, col: str = "word"):
    """A one-column DataFrame of stop words (default: Spark's list).

    Built as an exploded literal array, so it is a local table on the JVM
    (no Python worker, no RDD)."""
    from pyspark.sql import functions as F
    words = list(words) if words is not None else spark_default_stop_words()
    return spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in words])).alias(col))
