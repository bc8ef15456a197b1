"""Text jobs: token tables and word counts (K11), marker-delimited item
extraction (K6, X11 + R5)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.dates import long_label
from panelspark.functions.text import cut_between, drop_control, strip_fragments, strip_spans
from panelspark.operators.aggregate import count_by
from panelspark.operators.joins import drop_keys
from panelspark.operators.reshape import split_to_rows, tokenize
from panelspark.operators.select import between_dates

# Fragments deleted from headline text before tokenizing.
NOISE_FRAGMENTS = ("t.co", "trump", "https")


def clean_text(df: DataFrame, text: str, fragments: Sequence[str] = NOISE_FRAGMENTS) -> DataFrame:
    """Drop the greedy <...> span, then literal noise fragments."""
    return df.withColumn(text, strip_fragments(strip_spans(F.col(text)), list(fragments)))


def token_table(df: DataFrame, text: str, out: str = "word",
                fragments: Sequence[str] = NOISE_FRAGMENTS) -> DataFrame:
    """K11 first half: cleaned text -> one lower-case word per row, other
    columns kept."""
    return tokenize(clean_text(df, text, fragments), text, out)


def word_counts(tokens: DataFrame, stop_words: DataFrame, word: str = "word",
                date: str | None = None, lo: _dt.date | None = None, hi: _dt.date | None = None,
                exclude: Sequence[str] = ("trump",)) -> DataFrame:
    """K11 second half: optional date range (F3), stop-word anti join (J4),
    an excluded-word filter (F10), count per word (A6), most frequent first
    (ties by word).

    The planner broadcasts the stop-word list where its size allows; the
    counts are a hash aggregate with partial aggregation (a word holding a
    third of all tokens is summed map-side)."""
    t = tokens
    if date is not None and (lo is not None or hi is not None):
        t = between_dates(t, date, lo, hi)
    t = drop_keys(t.select(word), stop_words.select(word), [word], null_safe=False)
    if exclude:
        t = t.filter(~F.col(word).isin(list(exclude)))
    return count_by(t, word)


def marked_items(df: DataFrame, text: str, start: str | None, end: str | None,
                 delimiter: str, crlf_as_delimiter: bool = False, keep: Sequence[str] = (),
                 out: str = "item") -> DataFrame:
    """K6: the text between the last ``start`` marker and the first ``end``
    marker after it, tabs/newlines removed (CRLF optionally turned into the
    delimiter first), split into non-empty items, one row each."""
    body = cut_between(F.col(text), start, end)
    body = drop_control(body, delimiter if crlf_as_delimiter else None)
    return split_to_rows(df.withColumn("_body", body), "_body", delimiter, out, keep)


# The three headline lists of a day page -- (type, start
# marker, end marker).
HEADLINE_SECTIONS = (
    ("topTweets", "Most liked, retweeted and popular Tweets", "What happened on"),
    ("topNewsHeadlines", "Top news stories on this day", "Trended on Twitter"),
    ("topTrendingOnSm", "Trended on Twitter, the Internet and Social Media on", "Major Sports events"),
)


def headline_lists(pages: DataFrame, text: str = "text", date: str = "date",
                   sections=HEADLINE_SECTIONS) -> DataFrame:
    """K6: (headlines, date, type) rows from the text of day pages.

    * tweets: tabs/newlines dropped, split wherever the page's own date
      ('January 5, 2020') occurs;
    * news: CRLF becomes the '|' delimiter, then split on '|';
    * trending: as news, after cutting through the last ' <year>|'.
    Empty items are dropped.  All patterns are built per row from the date
    column, so every page is handled in one pass."""
    (t_type, t_start, t_end), (n_type, n_start, n_end), (s_type, s_start, s_end) = sections
    t, d = F.col(text), F.col(date)
    quoted_day = F.concat(F.lit("\\Q"), long_label(d), F.lit("\\E"))
    tweets = drop_control(cut_between(t, t_start, t_end))
    news = drop_control(cut_between(t, n_start, n_end), "|")
    trend = drop_control(cut_between(t, s_start, s_end), "|")
    trend = F.regexp_replace(trend, F.concat(F.lit("^.* "), F.year(d).cast("string"), F.lit("\\|")),
                             F.lit(""))

    def items(body, kind):
        parts = F.split(body, quoted_day) if kind == t_type else F.split(body, "\\|")
        return F.struct(F.lit(kind).alias("type"),
                        F.filter(parts, lambda x: x != F.lit("")).alias("items"))

    # one pass over the pages: three typed lists per page, exploded once
    lists = F.array(items(tweets, t_type), items(news, n_type), items(trend, s_type))
    per_type = pages.select(d.alias("date"), F.inline(lists))
    return per_type.select(F.explode("items").alias("headlines"), "date", "type")
