"""HTML sources (S10, S11) over landed pages (page_id, url, html).

Parsing HTML needs a real parser, so this is the one place Python runs on
the executors: ``mapInPandas`` with the standard-library ``html.parser``,
one Arrow batch at a time.  Each page is parsed independently inside its
partition; nothing is collected.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Tables(HTMLParser):
    """Collect <table> rows as lists of cell texts.  End tags of cells and
    rows may be omitted: the next cell, row, section or the end of the table
    (or page) closes what is open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self._depth = 0
        self._row: list[str] | None = None
        self._cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self._depth += 1
            if self._depth == 1:
                self.tables.append([])
        elif self._depth == 1 and tag in ("tr", "thead", "tbody", "tfoot"):
            self._end_row()
            self._row = [] if tag == "tr" else None
        elif self._depth == 1 and tag in ("td", "th"):
            self._end_cell()
            self._row = [] if self._row is None else self._row
            self._cell = []

    def handle_endtag(self, tag):
        if tag == "table":
            if self._depth == 1:
                self._end_row()
            self._depth = max(0, self._depth - 1)
        elif self._depth == 1 and tag in ("td", "th"):
            self._end_cell()
        elif self._depth == 1 and tag in ("tr", "thead", "tbody", "tfoot"):
            self._end_row()

    def _end_cell(self):
        if self._cell is not None:
            self._row.append(" ".join("".join(self._cell).split()))
            self._cell = None

    def _end_row(self):
        self._end_cell()
        if self._row:
            self.tables[-1].append(self._row)
        self._row = None

    def close(self):
        super().close()
        if self._depth:
            self._end_row()

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)


class _NodeText(HTMLParser):
    """Text content of every element with a given tag; an element that is
    never closed ends with the page."""

    def __init__(self, tag: str):
        super().__init__(convert_charrefs=True)
        self.tag = tag
        self.texts: list[str] = []
        self._open = 0
        self._buf: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            if self._open == 0:
                self._buf = []
            self._open += 1

    def handle_endtag(self, tag):
        if tag == self.tag and self._open:
            self._open -= 1
            if self._open == 0:
                self.texts.append("".join(self._buf))

    def handle_data(self, data):
        if self._open:
            self._buf.append(data)

    def close(self):
        super().close()
        if self._open:
            self.texts.append("".join(self._buf))
            self._open = 0


def _parse_tables(html: str) -> list[list[list[str]]]:
    p = _Tables()
    p.feed(html or "")
    p.close()
    return p.tables


def html_tables(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Every table row of every page, cells as text."""

    def fn(batches):
        for pdf in batches:
            rows = []
            for pid, html in zip(pdf[id_col], pdf[html_col]):
                for t, table in enumerate(_parse_tables(html)):
                    for r, cells in enumerate(table):
                        rows.append((pid, t, r, cells))
            yield pd.DataFrame(rows, columns=["page_id", "table_no", "row_no", "cells"])

    id_type = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInPandas(
        fn, f"page_id {id_type}, table_no int, row_no int, cells array<string>")


def first_table(tables: DataFrame, columns: list[str], drop_first_col: bool = True,
                header_rows: int = 1) -> DataFrame:
    """The first table of each page as typed-later text columns; the
    first column (a rank) dropped, header row skipped."""
    t = tables.filter((F.col("table_no") == 0) & (F.col("row_no") >= header_rows))
    start = 1 if drop_first_col else 0
    # F.get: NULL (not an error under ANSI) for a short row, e.g. a footer
    return t.select("page_id", *[F.get(F.col("cells"), start + i).alias(c) for i, c in enumerate(columns)])


def node_text(pages: DataFrame, tag: str, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Text of every ``tag`` element of every page (entities decoded)."""

    def fn(batches):
        for pdf in batches:
            rows = []
            for pid, html in zip(pdf[id_col], pdf[html_col]):
                p = _NodeText(tag)
                p.feed(html or "")
                p.close()
                rows.extend((pid, i, t) for i, t in enumerate(p.texts))
            yield pd.DataFrame(rows, columns=["page_id", "node_no", "text"])

    id_type = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInPandas(fn, f"page_id {id_type}, node_no int, text string")
