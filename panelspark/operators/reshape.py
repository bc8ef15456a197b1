"""Reshape (R-family): wide <-> long, text -> rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.semantics import na_text
from panelspark.functions.text import ALWAYS_BREAK, INNER_MARKS, WORD_PATTERN, split_items


def wide_to_long(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str],
                 name_col: str, value_col: str) -> DataFrame:
    """One row per (ids, column name) with the cell value.  Missing
    cells are kept as NULL rows (the panel needs them for gap filling).
    Names are quoted, so headers such as 'X1.22.20' stay single columns."""
    q = [F.col(f"`{c}`") for c in ids]
    v = [F.col(f"`{c}`") for c in value_cols]
    return df.unpivot(q, v, name_col, value_col)


def long_to_wide(df: DataFrame, ids: Sequence[str], names_from: str, values_from: str,
                 values: Sequence[str] | None = None, agg: str = "first") -> DataFrame:
    """One column per distinct ``names_from`` value.  Passing the value
    list fixes the output schema and saves Spark the job that would look the
    values up; a name outside that list is an error, never dropped."""
    if values is not None:
        name = F.col(names_from)
        df = df.withColumn(names_from, F.when(name.isin(list(values)), name).otherwise(
            F.raise_error(F.concat(F.lit(f"{names_from} outside the given list: "), na_text(name))).cast("string")))
    g = df.groupBy(*ids).pivot(names_from, list(values) if values is not None else None)
    fn = {"first": lambda c: F.first(c, ignorenulls=True), "sum": F.sum,
          "max": F.max, "min": F.min}[agg]
    return g.agg(fn(F.col(values_from)))


def columns_to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str],
                    relabel: Mapping[str, str] | None = None,
                    name_col: str = "type", value_col: str = "value") -> DataFrame:
    """Chosen columns to (type, value) with some type labels renamed."""
    out = df.unpivot(list(ids), list(cols), name_col, value_col)
    if relabel:
        lab = F.col(name_col)
        expr = None
        for k, v in relabel.items():
            expr = (F.when(lab == k, F.lit(v)) if expr is None else expr.when(lab == k, F.lit(v)))
        out = out.withColumn(name_col, expr.otherwise(lab))
    return out


def split_to_rows(df: DataFrame, text_col: str, delimiter: str, out: str = "item",
                  keep: Sequence[str] = ()) -> DataFrame:
    """One row per non-empty delimited item."""
    return df.select(*keep, F.explode(split_items(F.col(text_col), delimiter)).alias(out))


def tokenize(df: DataFrame, text_col: str, out: str = "word") -> DataFrame:
    """One lower-case word per row; other columns are kept.  Texts are cut
    at the characters that always break; a mark at an end never belongs to a
    word, so only pieces with an inner mark need the full rule."""
    rest = [c for c in df.columns if c != text_col]
    pieces = df.select(*rest, F.explode(F.split(F.lower(F.col(text_col)), ALWAYS_BREAK)).alias("_piece"))
    pieces = pieces.withColumn("_piece", F.btrim("_piece", F.lit(INNER_MARKS))).where("_piece <> ''")
    piece = F.col("_piece")
    marked = F.translate(piece, INNER_MARKS, "") != piece
    found = F.when(marked, F.regexp_extract_all(piece, F.lit(WORD_PATTERN), 0)).otherwise(F.array(piece))
    return pieces.select(*rest, F.explode(found).alias(out))
