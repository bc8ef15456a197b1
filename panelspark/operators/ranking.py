"""Row numbers of a whole table in a total order.

No unpartitioned window: rows are range-partitioned and sorted, numbered within
their partition, and each partition's rows are counted; the counts before a
partition are its offset.  Any rank is found this way, without a top-k as long
as the largest rank.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.sources.tables import stored

_PLACE_BITS = 33  # monotonically_increasing_id: partition above, place in it below


def row_numbers(df: DataFrame, order: Sequence[Column | str], out: str = "row_no",
                partitions: int | None = None) -> DataFrame:
    """``df`` with the 1-based position of each row in ``order`` (a total order:
    rows that are equal in it are numbered in any order)."""
    parts = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    numbered = stored(parts.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranks")
    part = F.shiftright("_at", _PLACE_BITS)
    # one row per partition, on the driver
    counts = sorted(map(tuple, numbered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()))
    starts = [0, *accumulate(n for _, n in counts)]
    offsets = df.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(counts, starts)], "_part long, _start long")
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    joined = numbered.join(F.broadcast(offsets), part == F.col("_part"))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != out],
                         (F.col("_start") + place + F.lit(1)).alias(out))


def rows_at_ranks(df: DataFrame, order: Sequence[Column | str], ranks: Sequence[int], out: str = "row_no",
                  partitions: int | None = None) -> DataFrame:
    """the rows at the given 1-based ranks, whatever their size."""
    return row_numbers(df, order, out, partitions).where(F.col(out).isin([int(r) for r in ranks]))
