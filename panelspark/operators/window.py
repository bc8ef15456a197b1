"""Ordered per-entity operators (the W-family).

Every window names its ``orderBy``; the source relied on row order.
All operators of one panel share ``partitionBy(keys).orderBy(date)`` so
Spark plans a single exchange + sort for the whole chain.

Scale note: these operators are applied to data already aggregated to the
(entity, date) grain, so one window partition holds at most one row per
day of one entity -- a hot entity does not make a hot task.  Operators on
raw rows that can be skewed (latest rows, first row per key) are written
as aggregations instead, which Spark pre-aggregates map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.semantics import col_, flag, rround, safe_div


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def ordered(keys, order) -> Window:
    """partitionBy(keys).orderBy(order) -- the shared panel window."""
    order = [order] if isinstance(order, (str, Column)) else list(order)
    return Window.partitionBy(*_keys(keys)).orderBy(*order)


def running(keys, order) -> Window:
    """Running frame: first row of the entity up to the current row."""
    return ordered(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(keys) -> Window:
    """Whole-entity frame, no order (for min/max of the entity)."""
    return Window.partitionBy(*_keys(keys))


# ---- column-level window expressions -------------------------------------

def running_sum(c, keys, order) -> Column:
    return F.sum(col_(c)).over(running(keys, order))


def new_keep_first(c, keys, order) -> Column:
    """Per-period change; the entity's first row keeps its level."""
    c = col_(c)
    return F.coalesce(c - F.lag(c, 1).over(ordered(keys, order)), c)


def new_zero_first(c, keys, order) -> Column:
    """Per-period change; the entity's first row is 0."""
    c = col_(c)
    return F.coalesce(c - F.lag(c, 1).over(ordered(keys, order)), F.lit(0))


def threshold_days(c, keys, order, threshold=100) -> Column:
    """Running count of rows whose value is at or above ``threshold``
    (the 'base day' counter)."""
    return F.sum(flag(col_(c) >= F.lit(threshold))).over(running(keys, order))


def row_index(keys, order) -> Column:
    """1-based row number within the entity."""
    return F.row_number().over(ordered(keys, order))


def return_factor(c, keys, order) -> Column:
    """(x - prev) / prev + 1; 1 on the entity's first row."""
    c = col_(c)
    prev = F.lag(c, 1).over(ordered(keys, order))
    return F.when(prev.isNull(), F.lit(1.0)).otherwise(safe_div(c - prev, prev) + F.lit(1.0))


def cumulative_return(c, keys, order) -> Column:
    """Product of return factors minus 1.  The product telescopes to
    x / first(x), which is what is computed (no rounding drift)."""
    c = col_(c)
    first = F.first(c).over(running(keys, order))
    return safe_div(c, first) - F.lit(1.0)


def latest_flag(date, keys) -> Column:
    """W8 on a panel: 1 on every row at the entity's latest date (ties kept)."""
    d = col_(date)
    return flag(d == F.max(d).over(whole(keys)))


def carry_forward(c, keys, order) -> Column:
    """Last non-missing value so far."""
    return F.last(col_(c), ignorenulls=True).over(running(keys, order))


def zero_at_first_date(c, date, keys) -> Column:
    """A missing value on the entity's first date becomes 0."""
    c, d = col_(c), col_(date)
    return F.when(c.isNull() & (d == F.min(d).over(whole(keys))), F.lit(0)).otherwise(c)


def per_unit(c, population, scale: int | None = None) -> Column:
    """Value per population unit, NULL on a 0/missing population;
    rounded half-to-even when ``scale`` is given."""
    v = safe_div(col_(c), col_(population))
    return rround(v, scale) if scale is not None else v


# ---- DataFrame-level operators --------------------------------------------

def gap_fill(df: DataFrame, keys, date: str, measures: Sequence[str]) -> DataFrame:
    """K9: zero-fill each measure on the entity's first date (W10), then
    carry the last value forward (W9).  Two select stages because the
    second reads the first's output (sequential mutate semantics)."""
    keys = _keys(keys)
    stage1 = df.withColumns({m: zero_at_first_date(m, date, keys) for m in measures})
    return stage1.withColumns({m: carry_forward(m, keys, date) for m in measures})


def latest_rows(df: DataFrame, keys, date: str) -> DataFrame:
    """W8 on raw rows: every row at its entity's latest date, ties kept.

    Written as max-per-key (pre-aggregated map-side) + semi join on
    (keys, date) instead of a window, so a hot entity is never gathered
    into one task; AQE broadcasts the per-key maxima when they are small."""
    keys = _keys(keys)
    latest = df.groupBy(*keys).agg(F.max(date).alias("_latest")).alias("_m")
    d = df.alias("_d")
    cond = F.col("_d." + date) == F.col("_m._latest")
    for k in keys:                       # a missing key is an entity too
        cond = cond & F.col("_d." + k).eqNullSafe(F.col("_m." + k))
    return d.join(latest, cond, "left_semi").select(*[F.col("_d." + c) for c in df.columns])


def first_per_key(df: DataFrame, keys, order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order`` (ties broken by the
    remaining columns, so the result is deterministic).

    An aggregation over a struct, not a window: partial aggregation keeps a
    hot key from landing whole in one task."""
    keys = _keys(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    return (df.groupBy(*keys).agg(packed)
              .select(*keys, *[F.col("_first." + c).alias(c) for c in order + rest])
              .select(*df.columns))
