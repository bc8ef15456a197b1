"""Date parsing, formatting and arithmetic as built-in expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelspark.functions.semantics import col_

EPOCH = _dt.date(1970, 1, 1)


# Fixed value: two-digit years at or above this are read as 19xx (the
# POSIX %y rule the source's date parser follows: 69-99 -> 1969-1999).
TWO_DIGIT_PIVOT = 69


_MDY = r"^(\d{1,2})/(\d{1,2})/(\d{2}|\d{4})$"


def parse_mdy(c) -> Column:
    """Header dates such as '1/22/20', '1/22/2020' or 'X1.22.20' (either
    year width; a leading X and dots, as left by some CSV writers, are
    accepted); anything else, or an impossible date, is NULL.

    Replaces the source's fix-up that rewrote '2020' as '20': every year is
    read, and two-digit years follow the %y rule (69-99 -> 19xx,
    00-68 -> 20xx).  One regex extraction and integer arithmetic, so the
    expression stays small inside wide projections."""
    s = F.regexp_replace(F.regexp_replace(col_(c).cast("string"), "^X", ""), r"\.", "/")
    month, day, yy = (F.regexp_extract(s, _MDY, i) for i in (1, 2, 3))
    y = yy.try_cast("int")
    century = F.when(F.length(yy) == 2, F.when(y >= TWO_DIGIT_PIVOT, 1900).otherwise(2000)).otherwise(0)
    return F.try_to_date(F.concat_ws("-", (y + century).cast("string"), month, day), "yyyy-M-d")


def parse_ymd(c) -> Column:
    """yyyymmdd numbers or text (JSON sources) to a date."""
    return F.try_to_date(col_(c).cast("string"), "yyyyMMdd")


def parse_iso(c) -> Column:
    return F.to_date(col_(c))


def day_of(c) -> Column:
    """Calendar day of a timestamp (or date) column."""
    return F.to_date(col_(c))


def day_number_to_date(n, origin: _dt.date = EPOCH) -> Column:
    """Day count since ``origin`` to a date."""
    return F.date_add(F.lit(origin), col_(n).cast("int"))


def long_label(c) -> Column:
    """'January 5, 2020'."""
    return F.date_format(col_(c), "MMMM d, yyyy")


def month_name(c) -> Column:
    return F.date_format(col_(c), "MMMM")


def compact_text(c) -> Column:
    """'20200105'."""
    return F.date_format(col_(c), "yyyyMMdd")


def date_spine(lo, hi) -> Column:
    """Inclusive array of days from lo to hi; empty (not descending) when
    lo > hi."""
    lo, hi = col_(lo), col_(hi)
    return F.when(lo <= hi, F.sequence(lo, hi, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>"))
