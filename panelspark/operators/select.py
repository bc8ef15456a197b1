"""Projections, filters and sorts (P-, F- and O-families)."""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.operators.joins import keep_keys

# An anchored header-date pattern ('1/22/20', 'X1.22.20', '1/22/2020').
DATE_HEADER = r"^X?\d{1,2}[./]\d{1,2}[./]\d{2,4}$"


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    """Column names matching a regex."""
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.search(c)]


def columns_present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted names that exist (absent ones are tolerated)."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def drop_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Drop columns by 0-based position."""
    names = [c for i, c in enumerate(df.columns) if i not in set(positions)]
    return df.select(*names)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace all (or the leading) column names."""
    names = list(names) + df.columns[len(names):]
    return df.toDF(*names)


def with_stages(df: DataFrame, *stages: dict) -> DataFrame:
    """P5: sequential derived columns.  Each stage is one ``withColumns``;
    a later stage sees the earlier stage's (re)assigned values."""
    for st in stages:
        df = df.withColumns(st)
    return df


def clean_columns(df: DataFrame, cols: Sequence[str], fn) -> DataFrame:
    """Apply one column cleaner to many columns."""
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def filter_in(df: DataFrame, c: str, values: Sequence | DataFrame | None) -> DataFrame:
    """keep rows whose key is selected; ``None`` selects everything.
    A short literal list becomes an IN predicate (pushed to the scan); a
    DataFrame of keys becomes a semi join."""
    if values is None:
        return df
    if isinstance(values, DataFrame):
        return keep_keys(df, values.select(c), c)
    return df.filter(F.col(c).isin(list(values)))


def positive(df: DataFrame, c: str) -> DataFrame:
    """value present and > 0."""
    return df.filter(F.col(c) > 0)


def complete_rows(df: DataFrame) -> DataFrame:
    """rows with no missing cell."""
    return df.na.drop("any")


def between_dates(df: DataFrame, c: str, lo: _dt.date | None, hi: _dt.date | None) -> DataFrame:
    """inclusive date range from optional bounds.  On a timestamp
    column the bounds are written as timestamp comparisons so the
    predicate reaches the Parquet scan (PushedFilters)."""
    dtype = df.schema[c].dataType
    col = F.col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # bounds built from text: wall-clock midnight, independent of the
        # Python process's time zone (session time zone for TIMESTAMP)
        cast = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
        if lo is not None:
            df = df.filter(col >= F.lit(f"{lo.isoformat()} 00:00:00").cast(cast))
        if hi is not None:
            nxt = hi + _dt.timedelta(days=1)
            df = df.filter(col < F.lit(f"{nxt.isoformat()} 00:00:00").cast(cast))
        return df
    if lo is not None:
        df = df.filter(col >= F.lit(lo))
    if hi is not None:
        df = df.filter(col <= F.lit(hi))
    return df


def rows_at_max(df: DataFrame, c: str) -> DataFrame:
    """rows at the table's latest value of ``c`` (a scalar subquery,
    not an unpartitioned window)."""
    return df.filter(F.col(c) == df.select(F.max(c)).scalar())


def sort_desc_last(*cols: str, tiebreak: Sequence[str] = ()) -> list[Column]:
    """O2: descending, missing values last, then stable tie-breakers."""
    return [F.desc_nulls_last(c) for c in cols] + [F.asc_nulls_last(t) for t in tiebreak]


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First n rows of a sort (distributed top-k: each partition
    keeps n, then one merge of n x partitions rows)."""
    return df.orderBy(*order).limit(n)


def best_and_worst(df: DataFrame, label: str, value: str, prefix=("best", "worst"),
                   extra: dict | None = None) -> DataFrame:
    """O3: first and last row of ``df`` sorted by ``value`` descending
    (stable: ties go to the smaller label for 'best', the larger for
    'worst'; rows without a value are ignored).  One global aggregate
    (partial per partition) instead of a global sort; ``extra`` adds more
    aggregates to the same pass."""
    present = F.col(value).isNotNull()
    packed = F.when(present, F.struct((-F.col(value)).alias("k"), F.col(label).alias("l"),
                                      F.col(value).alias("v")))     # rows without a value: ignored
    b, w = prefix
    extra = extra or {}
    return df.agg(F.min(packed).alias("_b"), F.max(packed).alias("_w"),
                  *[c.alias(n) for n, c in extra.items()]).select(
        F.col("_b.l").alias(f"{b}_{label}"), F.col("_b.v").alias(f"{b}_{value}"),
        F.col("_w.l").alias(f"{w}_{label}"), F.col("_w.v").alias(f"{w}_{value}"), *extra)
