"""Deterministic incremental refreshes of stored panel tables (K3-K5).

Each refresh is a lazy plan: the watermark (max date of the stored table)
and the batch guard are scalar subqueries evaluated on the cluster, not
values pulled into driver-side control flow.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.aggregate import refresh_guard, scalar_max
from panelspark.operators.joins import drop_keys, missing_pairs
from panelspark.operators.select import positive
from panelspark.operators.setops import replace_keys, union_by_name, union_distinct
from panelspark.operators.window import first_per_key


def watermark(old: DataFrame, date: str = "date") -> "F.Column":
    """The stored table's latest date, as a scalar column."""
    return scalar_max(old, date)


def _window(old: DataFrame, source: DataFrame, date: str, overlap_days: int, late: str) -> DataFrame:
    """The rows of the source that a trailing refresh takes: all of them
    (``late='keep'``, for landed files) or those from the watermark minus
    the overlap on (``late='window'``, for a source that is re-fetched)."""
    if late not in ("keep", "window"):
        raise ValueError(late)
    if late == "keep":
        return source
    start = F.date_sub(watermark(old, date), overlap_days)
    return source.filter(start.isNull() | (F.col(date) >= start))   # empty store: all is new


def late_rows(old: DataFrame, source: DataFrame, date: str = "date", overlap_days: int = 1) -> DataFrame:
    """Rows of the source before the trailing window: what a refresh with
    ``late='window'`` leaves out."""
    return source.filter(F.col(date) < F.date_sub(watermark(old, date), overlap_days))


def replace_trailing_dates(old: DataFrame, source: DataFrame, keys: Sequence[str], date: str = "date",
                           overlap_days: int = 1, late: str = "keep") -> DataFrame:
    """K3: replace the (entity, date) pairs that arrived; a pair that failed
    to arrive keeps its old row.  ``late='window'`` re-reads the source from
    (watermark - overlap_days) on only, for a source that is fetched again."""
    new = _window(old, source, date, overlap_days, late)
    return union_by_name(drop_keys(old, new, list(keys) + [date], null_safe=True), new)


def missing_after_refresh(expected: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J6 report: expected (entity, date) pairs absent from the landed batch."""
    return missing_pairs(expected, landed, keys)


def upsert(old: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
           value: str | None = None) -> DataFrame:
    """K4: key-based upsert where the new batch wins.

    1. first row per key inside the batch (W11, deterministic by ``order``);
    2. guard (A12): the batch has rows and fewer missing cells than rows --
       otherwise the stored table is returned unchanged (step 4 included);
    3. old rows with a key in the batch are dropped (F5), the batch is
       appended (U1);
    4. rows without a positive ``value`` are dropped (F2)."""
    fresh = first_per_key(batch, keys, order).drop(*[o for o in order if o not in old.columns])
    ok = refresh_guard(fresh)
    fresh = fresh.filter(ok)
    out = union_by_name(drop_keys(old, fresh, keys, null_safe=True), fresh)
    # F2 is part of the refresh: a rejected batch leaves the table as it was
    return out.filter(~ok | (F.col(value) > 0)) if value else out


def append_new_days(old: DataFrame, source: DataFrame, date: str = "date", late: str = "keep") -> DataFrame:
    """K5: the rows of the source appended, then distinct over all columns
    (U2) so a re-run adds nothing.  ``late='window'`` takes only rows after
    the stored watermark; when none is new the stored table stays as it is."""
    if late == "keep":
        return union_distinct(old, source)
    wm = watermark(old, date)
    new = source.filter(wm.isNull() | (F.col(date) > wm))          # empty store: all is new
    # nothing new: the stored table stays exactly as it is, decided in the plan
    some = new.select((F.count(F.lit(1)) > 0).alias("some")).scalar()
    return union_by_name(union_distinct(old, new).filter(some), old.filter(~some))


# ---- partitioned store: only touched months are read and rewritten --------

MONTH = "month"


def with_month(df: DataFrame, date: str = "date", col: str = MONTH) -> DataFrame:
    """Partition column: first day of the row's month."""
    return df.withColumn(col, F.trunc(F.col(date), "month"))


def refresh_partitioned(spark, path: str, batch: DataFrame, mode: str, keys: Sequence[str] = (),
                        order: Sequence[str] = (), date: str = "date", value: str | None = None,
                        overlap_days: int = 1, staging_root: str | None = None,
                        late: str = "keep") -> DataFrame:
    """K3/K4/K5 against a month-partitioned Parquet store.

    The months a refresh can change are computed from the batch (and, for
    trailing-date replacement, from the watermark); only those partitions
    of the store are read (a semi join on the partition column, so the
    scan is pruned) and only they are rewritten.  An upsert key must
    contain the date (it decides the partition).  Returns a fresh read of
    the refreshed store.
    """
    from panelspark.session import checkpoint_dir
    from panelspark.sources.tables import guard_passes, overwrite_partitions, write_observed

    if mode == "upsert" and date not in keys:
        raise ValueError("a month-partitioned upsert needs the date in the key")
    try:
        old = spark.read.parquet(path)
    except AnalysisException as e:           # first load, or every month emptied
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        old = None
    stored = set(old.columns) if old is not None else set(keys) | {date}
    cols = [c for c in batch.columns if c not in order or c in stored]
    if old is None:
        old = with_month(spark.createDataFrame([], batch.select(*cols).schema), date)
    new = batch
    if mode == "append_distinct" and late == "window":
        wm = watermark(old, date)
        new = batch.filter(wm.isNull() | (F.col(date) > wm))
    elif mode == "replace_dates":
        new = _window(old, batch, date, overlap_days, late)
    touched = with_month(new.select(date)).select(MONTH).distinct()
    old_part = old.join(touched, MONTH, "left_semi").drop(MONTH)
    if mode == "upsert":
        # the batch is written once; the guard reads what the write counted
        stage = f"{(staging_root or checkpoint_dir(spark) + '/staging').rstrip('/')}/batch-{uuid.uuid4().hex}"
        fresh = first_per_key(batch, keys, order).select(*cols)
        figures = write_observed(fresh, stage, date)
        if not guard_passes(figures):        # rejected: the store stays as it was
            return old
        fresh = spark.read.schema(fresh.schema).parquet(stage)
        out = union_by_name(drop_keys(old_part, fresh, keys, null_safe=True), fresh)
        out = out.filter(F.col(value) > 0) if value else out
    elif mode == "replace_dates":
        # ``new`` is already cut at the store-wide watermark: replace pairs
        out = replace_keys(old_part, new, list(keys) + [date])
    elif mode == "append_distinct":
        out = union_distinct(old_part, new)
    else:
        raise ValueError(mode)
    out = with_month(out.select(*cols), date)
    pk = [] if mode == "append_distinct" else (list(keys) if date in keys else list(keys) + [date])
    overwrite_partitions(spark, out, path, [MONTH], staging_root or f"{checkpoint_dir(spark)}/staging",
                         keys=pk, touched=touched)
    return spark.read.schema(out.schema).parquet(path)
