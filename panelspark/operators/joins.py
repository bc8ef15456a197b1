"""Joins (the J-family).

Broadcast policy: an explicit broadcast hint is used only for inputs whose
size is bounded by construction (a fixed word list, k selected keys).
Everything else is left to the planner: the static size estimate plus AQE's
runtime check (``spark.sql.adaptive.autoBroadcastJoinThreshold``) turn a
join into a broadcast only when the finished stage really is small, and
otherwise keep the sort-merge join (with AQE skew splitting).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.dates import date_spine


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (<=>); output keeps
    one copy of each key column (the left one)."""
    l, r = left.alias("_l"), right.alias("_r")
    cond = reduce(lambda a, b: a & b,
                  [F.col("_l." + k).eqNullSafe(F.col("_r." + k)) for k in keys])
    rest = [F.col("_r." + c) for c in right.columns if c not in keys]
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return l.join(r, cond, how).select(*[F.col("_l." + c) for c in left.columns])
    return l.join(r, cond, how).select(*[F.col("_l." + c) for c in left.columns], *rest)


def join_dim(fact: DataFrame, dim: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join a dimension or a second series on equal keys.  The
    planner picks broadcast vs sort-merge from measured sizes."""
    return fact.join(dim, keys, how)


def keep_keys(df: DataFrame, keys_df: DataFrame, keys, bounded: bool = False) -> DataFrame:
    """Rows whose key appears in ``keys_df``.  ``bounded=True``
    states that ``keys_df`` has a fixed small size (e.g. k chosen rows), so
    it is broadcast explicitly."""
    k = F.broadcast(keys_df) if bounded else keys_df
    return df.join(k, keys, "left_semi")


def drop_keys(df: DataFrame, keys_df: DataFrame, keys, null_safe: bool = True,
              bounded: bool = False) -> DataFrame:
    """Rows whose key is NOT in ``keys_df`` (never NOT IN: a NULL
    key must still match a NULL key)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    k = F.broadcast(keys_df) if bounded else keys_df
    if null_safe:
        return null_safe_join(df, k.select(*keys), keys, "left_anti")
    return df.join(k, keys, "left_anti")


def missing_days(landed: DataFrame, key: str, date: str) -> DataFrame:
    """J6 without a grid: per entity the days of the table's range (S16) less
    the days that landed; only the difference becomes rows."""
    span = landed.select(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi"))).scalar()
    days = landed.groupBy(key).agg(F.collect_set(date).alias("_days")).withColumn("_span", span)
    spine = date_spine(F.col("_span.lo"), F.col("_span.hi"))
    return days.select(key, F.explode(F.array_except(spine, F.col("_days"))).alias(date))


def missing_pairs(expected: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(entity, date) pairs of the expected grid that did not arrive."""
    return expected.select(*keys).join(landed.select(*keys).distinct(), list(keys), "left_anti")
