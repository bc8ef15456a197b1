"""Stored roll-ups that answer brushed date ranges.

**Counts.**  Days are rolled up to blocks of 1, 2, 4, ... days.  Any range of
days is the union of at most two blocks per level, so a report reads O(log
days) blocks and never the rows.  Counts of a block add up: new days append
partial counts, and a read sums what is there.

**Moments.**  Correlations are kept as mergeable moments (rows, means and
centred products per pair of columns) per period of some days.  Ranges of
periods merge by the parallel-variance rule, without reading the series again;
new days append moments of their own.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.dates import EPOCH
from panelspark.operators.joins import drop_keys

LEVELS = 14  # blocks of up to 2^13 days
COUNT_SCHEMA = "block bigint, key string, n bigint, level int"


def _day(date: str):
    return F.datediff(F.col(date), F.lit(EPOCH)).cast("bigint")


def add_counts(rows: DataFrame, path: str, date: str, key: str, levels: int = LEVELS) -> None:
    """Roll ``rows`` up by day and key and append their blocks to the store.
    One pre-aggregated shuffle; higher blocks are summed from daily counts."""
    daily = (rows.where(F.col(date).isNotNull()).groupBy(_day(date).alias("day"), F.col(key).alias("key"))
             .agg(F.count(F.lit(1)).alias("n")))
    blocks = F.inline(F.array(*[F.struct(F.lit(j).alias("level"), F.shiftright("day", j).alias("block"))
                                for j in range(levels)]))
    rolled = (daily.select("key", "n", blocks).groupBy("level", "block", "key").agg(F.sum("n").alias("n")))
    # files hold few blocks each, so that a filter on the block skips the others
    (rolled.repartitionByRange("level", "block", "key").sortWithinPartitions("level", "block")
     .select("block", "key", "n", "level").write.mode("append").partitionBy("level").parquet(path))


def day_blocks(lo: int, hi: int, levels: int = LEVELS) -> list[tuple[int, int]]:
    """The (level, block) pieces that make up the days ``lo`` .. ``hi``."""
    out, level = [], 0
    while lo <= hi:
        if level == levels - 1:
            out += [(level, b) for b in range(lo, hi + 1)]
            break
        if lo & 1:
            out.append((level, lo))
            lo += 1
        if not hi & 1:
            out.append((level, hi))
            hi -= 1
        lo, hi, level = lo >> 1, hi >> 1, level + 1
    return sorted(set(out))


def range_counts(spark: SparkSession, path: str, lo: _dt.date, hi: _dt.date, levels: int = LEVELS) -> DataFrame:
    """``(key, n)`` over the days ``lo`` .. ``hi`` from the roll-ups alone."""
    store = spark.read.schema(COUNT_SCHEMA).parquet(path)
    pieces = day_blocks((lo - EPOCH).days, (hi - EPOCH).days, levels)
    wanted = F.lit(False)
    for level in sorted({j for j, _ in pieces}):
        wanted = wanted | ((F.col("level") == level) & F.col("block").isin([b for j, b in pieces if j == level]))
    return store.where(wanted).groupBy("key").agg(F.sum("n").alias("n"))


def word_counts_between(spark: SparkSession, path: str, stop_words: DataFrame, lo: _dt.date, hi: _dt.date,
                        exclude: Sequence[str] = (), word: str = "word") -> DataFrame:
    """K11 for a brushed range: as ``plans.text.word_counts``, from roll-ups."""
    counted = range_counts(spark, path, lo, hi).withColumnRenamed("key", word)
    kept = drop_keys(counted, stop_words.select(word), [word], null_safe=False)
    if exclude:
        kept = kept.filter(~F.col(word).isin(list(exclude)))
    return kept.orderBy(F.desc("n"), F.asc(word))


# ---- moments ------------------------------------------------------------------

MOMENTS = "period bigint, i int, j int, n double, mx double, my double, cxx double, cyy double, cxy double"


def _partial_moments(df: DataFrame, cols: Sequence[str], period) -> DataFrame:
    """Moments per period and column pair of each partition's rows, as matrix
    products; a pair counts the rows where both values are present."""
    k = len(cols)

    def moments(x):
        there = ~np.isnan(x)
        m = there.astype(float)
        n = m.T @ m
        # centred per column first, so that large levels do not cancel
        mid = np.where(there.any(axis=0), np.nansum(x, axis=0) / np.maximum(1, there.sum(axis=0)), 0.0)
        x = np.where(there, x - mid, 0.0)
        size = np.maximum(n, 1)
        sx, sy = x.T @ m, m.T @ x
        xx, yy, xy = (x * x).T @ m, m.T @ (x * x), x.T @ x
        return np.stack([n, mid[:, None] + sx / size, mid[None, :] + sy / size, xx - sx * sx / size,
                         yy - sy * sy / size, xy - sx * sy / size])

    def run(batches):
        i, j = np.triu_indices(k)
        for b in batches:
            if not b.num_rows:
                continue
            when = b.column(0).to_numpy(zero_copy_only=False)
            x = np.array(b.column(1).flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(-1, k)
            for p in np.unique(when):
                t = moments(x[when == p])[:, i, j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(i.size, p)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                     *(pa.array(v) for v in t)],
                    ["period", "i", "j", "n", "mx", "my", "cxx", "cyy", "cxy"])

    values = df.select(period.cast("bigint").alias("period"),
                       F.array(*[F.col(c).cast("double") for c in cols]).alias("x")).where("period is not null")
    return values.mapInArrow(run, MOMENTS)


def merged_moments(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row of moments per ``by``: the centres are found first, then every
    part's products are moved to the common centre."""
    by = list(by)
    rows = parts.where("n > 0")
    centre = rows.groupBy(*by).agg((F.sum(F.col("n") * F.col("mx")) / F.sum("n")).alias("_x"),
                                   (F.sum(F.col("n") * F.col("my")) / F.sum("n")).alias("_y"))
    dx, dy = F.col("mx") - F.col("_x"), F.col("my") - F.col("_y")
    return rows.join(centre, by).groupBy(*by).agg(
        F.sum("n").alias("n"), F.first("_x").alias("mx"), F.first("_y").alias("my"),
        F.sum(F.col("cxx") + F.col("n") * dx * dx).alias("cxx"),
        F.sum(F.col("cyy") + F.col("n") * dy * dy).alias("cyy"),
        F.sum(F.col("cxy") + F.col("n") * dx * dy).alias("cxy"))


def period_of(date: str, days: int):
    return F.floor(_day(date) / F.lit(days)).cast("bigint")


def add_moments(df: DataFrame, path: str, date: str, cols: Sequence[str], days: int) -> None:
    """Append the moments of the rows' periods of ``days`` days to the store."""
    parts = _partial_moments(df, cols, period_of(date, days))
    merged = merged_moments(parts, ["period", "i", "j"])
    merged.select(*[c.split()[0] for c in MOMENTS.split(", ")]).write.mode("append").parquet(path)


def stored_correlation(spark: SparkSession, path: str, cols: Sequence[str], lo: int | None = None,
                       hi: int | None = None, digits: int = 6) -> DataFrame:
    """A10 from the stored moments of the periods ``lo`` .. ``hi``: the full
    matrix as rows (a, b, r), as ``correlation_long(full=True)``."""
    parts = spark.read.schema(MOMENTS).parquet(path)
    if lo is not None:
        parts = parts.where(F.col("period") >= lo)
    if hi is not None:
        parts = parts.where(F.col("period") <= hi)
    m = merged_moments(parts, ["i", "j"])
    real = ((F.col("n") > 1) & (F.col("cxx") > F.lit(1e-24) * F.col("n") * F.col("mx") * F.col("mx"))
            & (F.col("cyy") > F.lit(1e-24) * F.col("n") * F.col("my") * F.col("my"))
            & (F.col("cxx") > 0) & (F.col("cyy") > 0))
    r = F.when(real, F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(
        F.round(F.col("cxy") / F.sqrt(F.col("cxx") * F.col("cyy")), digits)))
    name = lambda i: F.get(F.array(*[F.lit(c) for c in cols]), F.col(i))
    cells = m.select("i", "j", name("i").alias("a"), name("j").alias("b"), r.alias("r"))
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("a", "b", "r"))).otherwise(
        F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r")))
    return cells.select(F.inline(both))
