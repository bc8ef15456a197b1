"""Quality rules, line first.

Every line is held against rules on its own: too many symbols, shouting
punctuation, navigation (separators, or a short list entry without an end of
sentence) and boilerplate phrases.  Failing lines are removed, and a document
that loses more than ``MAX_LOSS`` of its word characters is rejected.  The
base counts of the whole text come with it.

Repeated 3-word windows are found without leaving the row: the windows' hashes
are sorted with their positions, so equal windows stand side by side.

Edge cases: blanks at a line's end, a carriage return too, do not count; a null
text has no words; texts without three words have no
window; every row is judged on its own, so repeated rows, ids of any kind and
extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import BLANK_CHARS, BLANKS, words

MIN_WORDS, MAX_REPEAT_PCT, MAX_LOSS = 50, 50, 0.5
SYMBOLS = "#*$%&|<>"
SYMBOL_RATIO = 0.2     # symbols per word of a line
SHOUT_RATIO = 0.5      # ! and ? per word of a line
SEPARATOR_RATIO = 0.2  # separators per word of a line
MENU_WORDS = 3         # a line of so few words without an end of sentence is a menu entry
# Phrases of licence, consent and script notices.
NOTICES = ("all rights reserved", "licensed under", "released under the", "terms of use", "privacy policy",
           "cookie policy", "enable javascript", "copyright (c)", "copyright ©", "lorem ipsum")
SEPARATORS = "|»›•·"


def _n_chars(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _n_words(text: Column) -> Column:
    return F.size(words(text))


def line_fails(line: Column) -> Column:
    """Whether a line with a word breaks one of the rules."""
    n = _n_words(line)
    notice = F.lit(False)
    for phrase in NOTICES:
        notice = notice | F.contains(F.lower(line), F.lit(phrase))
    menu = (n <= MENU_WORDS) & ~F.rtrim(line, F.lit(BLANK_CHARS)).rlike(r"[.!?:;,\"'…”»)]\z")
    return ((_n_chars(line, SYMBOLS) > SYMBOL_RATIO * n) | (_n_chars(line, "!?") > SHOUT_RATIO * n)
            | (_n_chars(line, SEPARATORS) > SEPARATOR_RATIO * n) | menu | notice)


def clean_text(text: Column) -> Column:
    """The text without its failing lines; blank lines stay."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: (_n_words(x) == 0) | ~line_fails(x)), "\n")


def quality_rules(docs: DataFrame, text_col: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``kept`` and
    ``clean_text``; columns of ``docs`` with these names are replaced."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split("__t", "\n", -1), lambda x: _n_words(x) > 0)
    counted = (docs.withColumn("__t", text).withColumns({"__w": words(F.col("__t")), "__l": lines})
               .withColumns({
                   "n_words": F.size("__w").cast("bigint"),
                   "word_chars": F.char_length(F.regexp_replace("__t", BLANKS, "")).cast("bigint"),
                   "n_symbols": _n_chars(F.col("__t"), SYMBOLS).cast("bigint"),
                   "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint"),
                   "__h": F.when(F.size("__w") >= 3, F.transform(
                       F.sequence(F.lit(0), F.size("__w") - 3),
                       lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))),
               }))
    # sorted only where a window repeats; equal hashes then stand side by side
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    ranked = counted.withColumn("__s", F.when(repeats, F.sort_array(F.transform(
        "__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = lambda x, j: (x["h"].eqNullSafe(F.get("__s", j - 1)["h"])
                         | x["h"].eqNullSafe(F.get("__s", j + 1)["h"]))
    at = F.sort_array(F.transform(F.filter("__s", twin), lambda x: x["i"]))
    covered = F.aggregate(at, F.struct(F.lit(-3).alias("p"), F.lit(0).cast("bigint").alias("n")),
                          lambda a, i: F.struct(i.alias("p"), (a["n"] + F.least(F.lit(3), i - a["p"])).alias("n")),
                          lambda a: a["n"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    left = F.char_length(F.regexp_replace("clean_text", BLANKS, ""))
    return (ranked.withColumns({"n_repeat_words": F.coalesce(covered, F.lit(0)).cast("bigint"),
                                "clean_text": clean_text(F.col("__t"))})
            .withColumns({"base_failed": failed,
                          "kept": ~failed & (left >= (1 - max_loss) * F.col("word_chars"))})
            .drop("__t", "__w", "__l", "__h", "__s"))
