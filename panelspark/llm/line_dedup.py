"""Line deduplication by site-relative frequency.

Per host, the pages that contain a line (once per page, however often it
repeats there) are divided by all pages of the host; lines above ``max_ratio``
on at least ``min_pages`` pages are boilerplate and are dropped.  Lines are
compared without surrounding blanks; blank lines are neither counted nor
dropped.  The lines go whatever share of a page they are; only a page of which
no line would be left, a copy of other pages, stays as it is (near-duplicate
stages tell copies).  ``max_loss`` can spare pages that would lose more than
that share of their characters.

The counts are one pre-aggregated shuffle of 16-byte line keys.  A host has at
most (lines per page / max_ratio) boilerplate lines, so each host's list is
one small row; the lists are written and measured first, up to ``LIST_KEYS``
lines in all are broadcast and texts stay where they are, beyond that the rows
are joined by host with skew splitting.  Texts are never exploded back together.

Edge cases: null and empty texts stay; a null host is a host of its own; every
row counts as a page, repeated rows and ids included; an empty table gives an
empty result.  All other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import BLANK_CHARS, stored

MAX_RATIO, MIN_PAGES = 0.10, 5
LIST_KEYS = 1 << 20  # boilerplate lines (16-byte keys) that may be broadcast


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, for tables that have pages and no host column."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK_CHARS))


def _line_key(line: Column) -> Column:
    return F.unhex(F.md5(_trim(line).cast("binary")))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, keys)``: the keys of each host's boilerplate lines."""
    pages = docs.select(F.col(host_col).alias("host"), F.col(text_col).cast("string").alias("text"))
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: _trim(x) != ""), _line_key))
    counts = (pages.select("host", F.explode(keys).alias("key")).groupBy("host", "key")
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).withColumnRenamed("host", "h")
    return (counts.join(totals, F.col("host").eqNullSafe(F.col("h")))
            .where(F.col("n") > max_ratio * F.col("pages"))
            .groupBy("host").agg(F.collect_list("key").alias("keys")))


def drop_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text",
               max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, max_loss: float | None = None,
               counts: bool = False) -> DataFrame:
    """``docs`` with the boilerplate lines cut from ``text_col``; with
    ``counts`` also ``n_lines`` and ``n_dropped`` (columns of ``docs`` with
    these names are then replaced)."""
    lists = stored(boilerplate(docs, host_col, text_col, max_ratio, min_pages).select(
        F.col("host").alias("__host"), F.col("keys").alias("__keys")), "boilerplate")
    names = docs.columns
    text = F.col(text_col).cast("string")
    if (lists.agg(F.sum(F.size("__keys"))).first()[0] or 0) <= LIST_KEYS:
        lists = F.broadcast(lists)
    joined = docs.join(lists, F.col(host_col).eqNullSafe(F.col("__host")), "left")
    kept = F.filter(_lines(text), lambda x: (_trim(x) == "") | ~F.array_contains(F.col("__keys"), _line_key(x)))
    cut = joined.withColumn("__kept", F.when(F.col("__keys").isNotNull(), kept))
    new = F.array_join("__kept", "\n")
    # line breaks do not count, so that a page is measured by its lines alone
    size = lambda t: F.char_length(F.translate(t, "\n", ""))
    if max_loss is None:
        enough = F.exists("__kept", lambda x: _trim(x) != "")
    else:
        enough = size(new) >= (1 - max_loss) * size(text)
    keep = F.col("__kept").isNotNull() & enough
    out = cut.withColumn("__new", F.when(keep, new).otherwise(text))
    cols = [F.col("__new").alias(c) if c == text_col else F.col(c) for c in names
            if not counts or c not in ("n_lines", "n_dropped")]
    if counts:
        n = F.when(text.isNull(), F.lit(0)).otherwise(F.size(_lines(text)))
        cols += [n.cast("bigint").alias("n_lines"),
                 F.when(keep, n - F.size("__kept")).otherwise(F.lit(0)).cast("bigint").alias("n_dropped")]
    return out.select(*cols)
