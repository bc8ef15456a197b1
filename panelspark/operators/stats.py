"""Quantile breaks, quantile buckets and correlation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelspark.functions.semantics import col_, rround
from panelspark.operators.selection import BOUND, interpolated, values_at, wanted_ranks
from panelspark.sources.tables import literal_table, stored

# The 20 breakpoint probabilities 0, 0.05, ..., 0.95 and the
# colour ramp that runs from 255 down to 40 over the 21 buckets.
DEFAULT_PROBS = tuple(round(0.05 * i, 2) for i in range(20))
RAMP_TOP, RAMP_BOTTOM = 255, 40


def quantile_breaks(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = DEFAULT_PROBS,
                    approx: bool = False, accuracy: int = 10000, bound: int = BOUND) -> DataFrame:
    """One row, one array<double> of breakpoints per column.

    Exact (linear interpolation, NULLs skipped) by default and of any size:
    the columns are written once and counted on the way, then the wanted ranks
    are found by distributed selection (``operators/selection.py``); no task
    reads more than ``bound`` values at once.  ``approx=True`` uses one
    ``percentile_approx`` pass with bounded memory instead."""
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if approx:
        return df.agg(*[F.percentile_approx(F.col(c).cast("double"), arr, accuracy).alias(c)
                        for c in cols])
    cols = list(cols)
    seen = Observation()
    kept = stored(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]).observe(
        seen, *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(cols)]), "quantile-input")
    figures = seen.get  # counted while writing
    rows = {c: figures[f"n{i}"] for i, c in enumerate(cols)}
    pairs = kept.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").alias("v")) for c in cols]))).where("v is not null")
    found = values_at(pairs, {c: wanted_ranks(rows[c], probs) for c in cols}, rows, probs, bound)
    breaks = [[interpolated(found, c, rows[c], p) for p in probs] if rows[c] else None for c in cols]
    return literal_table(df.sparkSession, [tuple(breaks)], ", ".join(f"`{c}` array<double>" for c in cols))


def bucket_of(x, breaks: Column, n_breaks: int | None = None) -> Column:
    """Number of breakpoints strictly below x (0..len(breaks)).

    With ``n_breaks`` given the count is a plain sum of comparisons (no
    higher-order function), which also works when ``breaks`` is a scalar
    subquery."""
    x = col_(x)
    if n_breaks is None:
        return F.size(F.filter(breaks, lambda b: x > b))
    terms = [(x > breaks[i]).cast("int") for i in range(n_breaks)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def ramp_level(bucket, n_breaks: int = len(DEFAULT_PROBS)) -> Column:
    """The colour level of a bucket on an even ramp 255 -> 40."""
    step = (RAMP_TOP - RAMP_BOTTOM) / n_breaks
    return rround(F.lit(float(RAMP_TOP)) - F.lit(step) * col_(bucket), 0).cast("int")


def with_buckets(df: DataFrame, cols: Sequence[str], breaks: DataFrame,
                 n_breaks: int = len(DEFAULT_PROBS)) -> DataFrame:
    """Add ``<col>_bucket`` and ``<col>_level`` for every column.  The
    breaks row is read as scalar subqueries (one small job, no join)."""
    # all breaks: one scalar subquery that holds a struct of arrays
    with_br = df.withColumn("_br", breaks.select(F.struct(*cols)).scalar())
    out = with_br.withColumns({c + "_bucket": bucket_of(c, F.col("_br").getField(c), n_breaks) for c in cols})
    out = out.drop("_br")
    return out.withColumns({c + "_level": ramp_level(c + "_bucket", n_breaks) for c in cols})


def correlation_long(df: DataFrame, cols: Sequence[str], digits: int = 6,
                     full: bool = False) -> DataFrame:
    """A10: Pearson correlation of every pair of columns as long rows
    (a, b, r), rounded to ``digits`` places; a constant column gives NULL.

    The column means come first, as one row; then each partition sums the
    cross products of its centred rows as matrices (pairwise-complete rows
    only) and the partial sums are added per pair, so the plan has the same
    size for any number of columns.  ``full=False`` returns each pair once
    (a before b in column order); ``full=True`` returns the whole matrix:
    both orders and the diagonal (1, or NULL for a constant or too-short
    column), which is symmetric by construction."""
    k = len(cols)
    values = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    means = df.select(F.array(*[F.avg(F.col(c).cast("double")) for c in cols]).alias("m")).select("m").scalar()

    def run(batches):
        total, mean = np.zeros((6, k, k)), None
        for b in batches:
            if not b.num_rows:
                continue
            x = np.array(b.column(0).flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(-1, k)
            if mean is None:
                mean = np.array(b.column(1)[0].as_py(), dtype=float)
            there = ~np.isnan(x)
            x = np.where(there, x - mean, 0.0)
            m = there.astype(float)
            total += np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i, j, *total[:, i, j])],
                                         ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    parts = values.withColumn("m", means).mapInArrow(
        run, "i long, j long, n double, sx double, sy double, sxx double, syy double, sxy double")
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    spread = lambda s, ss: F.col(ss) - F.try_divide(F.col(s) * F.col(s), F.col("n"))
    # what is left of a constant column after rounding is no spread
    vx, vy = spread("sx", "sxx"), spread("sy", "syy")
    mean = lambda i: F.coalesce(F.get(F.col("mean"), F.col(i).cast("int")), F.lit(0.0))
    real = ((F.col("n") > 1) & (vx > F.lit(1e-24) * F.col("n") * mean("i") * mean("i"))
            & (vy > F.lit(1e-24) * F.col("n") * mean("j") * mean("j")) & (vx > 0) & (vy > 0))
    r = F.when(real, F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(
        F.round((F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / F.sqrt(vx * vy), digits)))
    name = lambda i: F.get(F.array(*[F.lit(c) for c in cols]), F.col(i).cast("int"))
    cells = sums.withColumn("mean", means).select("i", "j", name("i").alias("a"), name("j").alias("b"), r.alias("r"))
    once = cells.where("i < j").select("a", "b", "r")
    if not full:
        return once
    return cells.where("i <= j").select(F.inline(F.when(F.col("i") == F.col("j"), F.array(F.struct("a", "b", "r")))
        .otherwise(F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r")))))
