"""Running state of ordered entities, spread over tasks: a segmented prefix
scan (W4, W9, W10, K9 on raw rows).

A window per entity puts all rows of an entity into one task.  Here the rows
are range-partitioned by (entity, order) instead, so a hot entity covers many
segments.  Each segment scans its own rows; the state in which a segment leaves
an entity (last value, sum so far, ...) is one small row, the states before a
segment are combined, and the combination is applied to the segment's rows.

A segment is entered by at most one entity from the segment before it, so the
combined states are at most one row per segment: they are broadcast.

``order`` must be a total order within the entity (add a unique column last).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.semantics import col_, flag
from panelspark.sources.tables import stored

SEGMENT = "_segment"


@dataclass(frozen=True)
class Scan:
    """One running column: its value within a segment, the state the segment
    leaves behind, how states add up over earlier segments, and how the sum of
    the earlier ones joins the value within."""

    local: object       # window of the rows so far -> Column
    state: object       # order columns -> aggregate
    before: object      # (state column, window of earlier segments) -> Column
    combine: object     # (local, before) -> Column


def running_sum(c) -> Scan:
    """Null-skipping sum of the rows so far."""
    c = col_(c)
    return Scan(lambda so_far, _: F.sum(c).over(so_far), lambda _: F.sum(c), lambda s, w: F.sum(s).over(w),
                lambda own, past: F.coalesce(own + past, own, past))


def running_count(cond: Column) -> Scan:
    """How many of the rows so far meet the condition."""
    return running_sum(flag(cond).cast("bigint"))


def running_min(c) -> Scan:
    c = col_(c)
    return Scan(lambda so_far, _: F.min(c).over(so_far), lambda _: F.min(c), lambda s, w: F.min(s).over(w),
                lambda own, past: F.least(own, past))


def last_value(c) -> Scan:
    """The last non-missing value so far."""
    c = col_(c)
    return Scan(lambda so_far, _: F.last(c, ignorenulls=True).over(so_far),
                lambda order: F.max(F.when(c.isNotNull(), F.struct(*order, c.alias("_v"))))["_v"],
                lambda s, w: F.last(s, ignorenulls=True).over(w), lambda own, past: F.coalesce(own, past))


def previous_value(c) -> Scan:
    """The value of the row before, missing or not."""
    c = col_(c)
    boxed = F.struct(c.alias("_v"))  # tells a missing value from no row
    return Scan(lambda _, rows: F.lag(boxed, 1).over(rows),
                lambda order: F.max(F.struct(*order, boxed.alias("_b")))["_b"],
                lambda s, w: F.last(s).over(w), lambda own, past: F.coalesce(own, past)["_v"])


def spread(df: DataFrame, keys: Sequence[str], order: Sequence[str], segments: int | None = None) -> DataFrame:
    """``df`` cut into ordered segments, written once (so that a lost executor
    cannot move a cut)."""
    cols = [*keys, *order]
    parts = df.repartitionByRange(segments, *cols) if segments else df.repartitionByRange(*cols)
    return stored(parts.withColumn(SEGMENT, F.spark_partition_id()), "segments")


def scanned(parts: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Mapping[str, Scan]) -> DataFrame:
    """``parts`` (from ``spread``) with the running columns."""
    keys, order = list(keys), list(order)
    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys],
                               F.lit(True))
    names = list(columns)
    # only the first entity of a segment can come from an earlier one
    first = (parts.groupBy(SEGMENT).agg(F.min(F.struct(*keys, F.lit(0).alias("_z"))).alias("k"))
             .select("k.*").drop("_z").distinct())
    entering = parts.alias("p").join(F.broadcast(first.alias("f")), same("p", "f"), "left_semi")
    states = entering.groupBy(*keys, SEGMENT).agg(
        *[s.state([F.col(o) for o in order]).alias(f"_s{i}") for i, s in enumerate(columns.values())])
    past = Window.partitionBy(*keys).orderBy(SEGMENT)
    earlier = past.rowsBetween(Window.unboundedPreceding, -1)
    before = (states.withColumns({f"_b{i}": s.before(F.col(f"_s{i}"), earlier) for i, s in enumerate(columns.values())}
                                 | {"_nth": F.row_number().over(past)})
              .where("_nth > 1").select(*keys, SEGMENT, *[f"_b{i}" for i in range(len(names))]))
    rows = Window.partitionBy(*keys, SEGMENT).orderBy(*order)
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = parts.withColumns({f"_l{i}": s.local(so_far, rows) for i, s in enumerate(columns.values())})
    joined = own.alias("o").join(F.broadcast(before.alias("b")),  # at most one row per segment
                                 (F.col(f"o.{SEGMENT}") == F.col(f"b.{SEGMENT}")) & same("o", "b"), "left")
    out = [F.col(f"o.`{c}`") for c in parts.columns if c not in names]
    return joined.select(*out, *[s.combine(F.col(f"_l{i}"), F.col(f"_b{i}")).alias(n)
                                 for i, (n, s) in enumerate(columns.items())])


def running_state(df: DataFrame, keys, order: Sequence[str], columns: Mapping[str, Scan],
                  segments: int | None = None) -> DataFrame:
    """``df`` with running columns per entity; equal to the window form."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return scanned(spread(df, keys, order, segments), keys, order, columns).drop(SEGMENT)


def gap_fill_rows(df: DataFrame, keys, date: str, measures: Sequence[str], order: Sequence[str] = (),
                  segments: int | None = None) -> DataFrame:
    """K9 on existing rows: a missing measure on the entity's first date is 0
    (W10), then the last value is carried forward (W9)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [date, *order]
    parts = spread(df, keys, order, segments)
    dated = scanned(parts, keys, order, {"_first": running_min(date)})
    zeroed = dated.withColumns({m: F.when(F.col(m).isNull() & (F.col(date) == F.col("_first")), F.lit(0))
                               .otherwise(F.col(m)) for m in measures})
    filled = scanned(zeroed, keys, order, {m: last_value(m) for m in measures})
    return filled.select(*df.columns)
