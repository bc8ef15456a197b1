"""Set operations (U-family).  Unions match columns by name (the source
binds rows by name and pads missing columns)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from panelspark.operators.joins import drop_keys


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Union all, by name, missing columns padded with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """Union by name, then distinct rows (hash aggregate with partial
    aggregation, so repeated rows collapse before the shuffle)."""
    return union_by_name(*dfs).distinct()


def replace_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U3 + U1: old rows whose key is not in ``new``, plus all of ``new``
    (new wins).  Keys match null-safely."""
    return union_by_name(drop_keys(old, new, keys, null_safe=True), new)
