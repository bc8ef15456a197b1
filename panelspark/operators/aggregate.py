"""Aggregations (the A-family).  All are hash aggregations with map-side
partial aggregation, so a key that holds a third of all rows is reduced
before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.semantics import col_, safe_div, sum0


def rollup_sum0(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A1: roll sub-entities up to ``keys`` with null-skipping sums; an
    all-missing group sums to 0."""
    return df.groupBy(*keys).agg(*[sum0(m).alias(m) for m in measures])


def totals_by(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """A2: per-key totals, ``{out_name: column}``."""
    return df.groupBy(*keys).agg(*[sum0(c).alias(o) for o, c in measures.items()])


def exact_sum(c, scale: int = 6) -> Column:
    """Order-independent sum of a double column known to carry at most
    ``scale`` decimals (e.g. a population in millions), as double."""
    return F.sum(col_(c).cast(f"decimal(28,{scale})")).cast("double")


def ratio_of_sums(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str],
                  denominator: str, exact_scale: int | None = 6) -> DataFrame:
    """A3: sum(x) / sum(denominator) per key.  The numerator keeps rows
    whose denominator is missing, the denominator skips them (as the
    source does); a zero denominator gives NULL.  With ``exact_scale`` the
    denominator is summed exactly (partition-order independent)."""
    den = exact_sum(denominator, exact_scale) if exact_scale is not None else F.sum(col_(denominator))
    return df.groupBy(*keys).agg(*[safe_div(sum0(c), den).alias(o) for o, c in measures.items()])


def count_by(df: DataFrame, c: str, out: str = "n") -> DataFrame:
    """Occurrences of each value, most frequent first (ties by value)."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), F.asc(c))


def distinct_count(c) -> Column:
    """Exact distinct count (it drives a branch, so it must be exact)."""
    return F.count_distinct(col_(c))


def scalar_max(df: DataFrame, c: str) -> Column:
    """The table's max of ``c`` as a scalar-subquery column (evaluated
    once; no driver round trip, no unpartitioned window)."""
    return df.select(F.max(c)).scalar()


def missing_cells(df: DataFrame) -> Column:
    """Number of NULL cells over all columns (one expression per column)."""
    parts = [F.sum(col_(c).isNull().cast("long")) for c in df.columns]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return F.coalesce(total, F.lit(0))


def refresh_guard(df: DataFrame) -> Column:
    """Scalar boolean -- the batch has rows and fewer missing cells
    than rows."""
    return df.select(
        ((missing_cells(df) < F.count(F.lit(1))) & (F.count(F.lit(1)) > 0)).alias("ok")).scalar()


def sum_max_by(df: DataFrame, key: Column, measures: Mapping[str, str],
               maxima: Mapping[str, str], key_name: str = "key") -> DataFrame:
    """Sums and maxima per derived key."""
    return df.groupBy(key.alias(key_name)).agg(
        *[sum0(c).alias(o) for o, c in measures.items()],
        *[F.max(c).alias(o) for o, c in maxima.items()])
