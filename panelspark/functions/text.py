"""Text expressions: marker cuts, delimiter splits, span stripping, words.

Regex note: the source's regex dialect lets '.' match a newline; Java's
does not, so patterns that must cross lines carry the (?s) flag.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelspark.functions.semantics import col_

# Word breaks of the Unicode rules (UAX 29): letters, digits and connectors
# stay together; between two letters one mark such as . : ' or ’ does not
# break, between two digits one mark such as . , ; or ' does not.
_LETTER, _DIGIT, _JOIN = r"[\p{L}\p{M}]", r"\p{Nd}", r"[_‿⁀]"
_MID_LETTER, _MID_NUMBER = "[.:'’·․‘﹒＇．]", "[.,;'’․‘﹒＇．，；]"
_UNIT = rf"(?:{_LETTER}|{_DIGIT}|{_JOIN})"
# characters that break a word wherever they stand, and all inner marks
ALWAYS_BREAK = r"[^\p{L}\p{M}\p{Nd}_‿⁀.:'’·․‘﹒＇．,;，；]+"
INNER_MARKS = ".:'’·․‘﹒＇．,;，；"
WORD_PATTERN = (rf"{_UNIT}(?:{_UNIT}|(?<={_LETTER}){_MID_LETTER}(?={_LETTER})"
                rf"|(?<={_DIGIT}){_MID_NUMBER}(?={_DIGIT}))*+")


def cut_between(c, start: str | None, end: str | None) -> Column:
    """Keep the text after the LAST ``start`` marker and before the FIRST
    following ``end`` marker.  A marker that is absent leaves the text
    uncut on that side.  Markers are literal text."""
    out = col_(c)
    if start:
        out = F.regexp_replace(out, "(?s)^.*" + re.escape(start), "")
    if end:
        out = F.regexp_replace(out, "(?s)" + re.escape(end) + ".*$", "")
    return out


def drop_control(c, crlf_as: str | None = None) -> Column:
    """Remove tabs, CR and LF; optionally turn each CRLF into ``crlf_as``
    first (so line breaks become item delimiters)."""
    out = col_(c)
    if crlf_as is not None:
        out = F.regexp_replace(out, r"\r\n", crlf_as.replace("\\", "\\\\").replace("$", "\\$"))
    return F.regexp_replace(out, r"[\t\n\r]", "")


def split_items(c, delimiter: str, literal: bool = True) -> Column:
    """Split to an array of non-empty items.

    Empty input gives no items and empty pieces (leading, doubled or
    trailing delimiters) are dropped."""
    pat = re.escape(delimiter) if literal else delimiter
    parts = F.split(col_(c), pat)
    return F.filter(parts, lambda s: s != F.lit(""))


def strip_spans(c, open_: str = "<", close: str = ">") -> Column:
    """Greedy removal from the first ``open_`` to the last ``close`` after
    it, across lines -- the match of ``(?s)<.*>``.

    Computed with two linear scans (instr, and instr on the reversed text)
    instead of a backtracking regex, so text with many unmatched ``open_``
    characters stays O(n)."""
    c = col_(c)
    first = F.instr(c, open_)
    last = F.length(c) - F.instr(F.reverse(c), close[::-1]) - F.lit(len(close)) + F.lit(2)
    has = (first > 0) & (F.instr(F.reverse(c), close[::-1]) > 0) & (last >= first + F.lit(len(open_)))
    cut = F.concat(F.substring(c, F.lit(1), first - F.lit(1)),
                   F.substring(c, last + F.lit(len(close)), F.length(c)))
    return F.when(has, cut).otherwise(c)


def strip_fragments(c, fragments: list[str]) -> Column:
    """Delete literal fragments (case-sensitive)."""
    return F.regexp_replace(col_(c), "|".join(re.escape(f) for f in fragments), "")


def strip_tags(c) -> Column:
    """Remove every <...> tag (non-greedy, one tag at a time)."""
    return F.regexp_replace(col_(c), "<[^>]*>", "")


def words(c) -> Column:
    """Lower-cased word tokens as an array."""
    return F.regexp_extract_all(F.lower(col_(c)), F.lit(WORD_PATTERN), 0)
