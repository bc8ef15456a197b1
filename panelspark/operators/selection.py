"""Distributed selection: the values at given ranks of many columns, exact,
without sorting a column or gathering it (A9).

Every wanted rank lies in a value range of its column.  A round lays cuts
through each range (a bounded sketch of the values inside) and counts the rows
at and between the cuts; the counts tell which cut is the wanted value, or
between which two cuts it lies.  Ranges shrink by the number of cuts each
round; one with at most ``bound`` rows left is read out, so no task holds more
than ``bound`` values whatever the input.  A value that repeats more often than
that becomes a cut and is never read row by row.

The driver sees ranges and counts, a few dozen numbers per column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.sources.tables import literal_table, stored

BOUND, CUTS, ACCURACY = 100_000, 128, 10_000


@dataclass
class _Range:
    """Rows of one column strictly between two values (None: open)."""

    column: str
    lo: float | None
    hi: float | None
    first: int          # rank of the least row inside
    rows: int
    ranks: list[int]


def _inside(values: DataFrame, ranges: Sequence[_Range], numbers: Sequence[list], kind: str) -> DataFrame:
    """Rows of ``values(c, v)`` in one of the ranges, with its number and its
    own list of ``numbers``.  At most one range per column and wanted rank."""
    rows = [(i, r.column, r.lo, r.hi, list(x)) for i, (r, x) in enumerate(zip(ranges, numbers))]
    table = F.broadcast(literal_table(values.sparkSession, rows,
                                      f"_i int, _c string, _lo double, _hi double, _x array<{kind}>"))
    here = ((F.col("c") == F.col("_c")) & (F.col("_lo").isNull() | (F.col("v") > F.col("_lo")))
            & (F.col("_hi").isNull() | (F.col("v") < F.col("_hi"))))
    return values.join(table, here).select("_i", "c", "v", "_x")


def _narrowed(values: DataFrame, ranges: Sequence[_Range], marks: Sequence[float], found: dict) -> list[_Range]:
    """One round: ranks that fall on a cut go to ``found``; the ranges between
    two cuts that hold the others come back."""
    none: list[list] = [[] for _ in ranges]
    cuts = list(none)
    marks = F.array(*[F.lit(float(m)) for m in marks])
    for r in (_inside(values, ranges, none, "double").groupBy("_i")
              .agg(F.percentile_approx("v", marks, ACCURACY).alias("q")).collect()):
        cuts[r["_i"]] = sorted(set(r["q"]))
    below = F.size(F.filter("_x", lambda x: x < F.col("v")))
    cell = 2 * below + F.array_contains("_x", F.col("v")).cast("int")
    counts = {(r["_i"], r["cell"]): r["n"] for r in
              _inside(values, ranges, cuts, "double").groupBy("_i", cell.alias("cell"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    out = []
    for i, r in enumerate(ranges):
        at, own = r.first, cuts[i]
        for k in range(2 * len(own) + 1):
            n = counts.get((i, k), 0)
            here = [x for x in r.ranks if at <= x < at + n]
            if here and k % 2:
                found.update({(r.column, x): own[k // 2] for x in here})
            elif here:
                out.append(_Range(r.column, own[k // 2 - 1] if k else r.lo,
                                  own[k // 2] if k < 2 * len(own) else r.hi, at, n, here))
            at += n
    return out


def _read_out(values: DataFrame, ranges: Sequence[_Range], found: dict) -> None:
    """The wanted values of ranges of at most ``bound`` rows each."""
    wanted = [[k - r.first for k in r.ranks] for r in ranges]
    per_value = _inside(values, ranges, wanted, "bigint").groupBy("_i", "_x", "v").agg(F.count(F.lit(1)).alias("n"))
    listed = per_value.groupBy("_i", "_x").agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("l"))
    start = F.struct(F.lit(0).cast("bigint").alias("s"), F.array().cast("array<double>").alias("q"))
    # one walk: each value is put down as often as wanted ranks fall on it
    walk = F.aggregate("l", start, lambda a, x: F.struct(
        (a["s"] + x["n"]).alias("s"),
        F.concat(a["q"], F.transform(F.filter("_x", lambda k: (k >= a["s"]) & (k < a["s"] + x["n"])),
                                     lambda _: x["v"])).alias("q")))
    for r in listed.select("_i", walk["q"].alias("q")).collect():
        own = ranges[r["_i"]]
        found.update({(own.column, k): v for k, v in zip(own.ranks, r["q"])})


def values_at(values: DataFrame, ranks: dict[str, Sequence[int]], rows: dict[str, int],
              marks: Sequence[float] = (), bound: int = BOUND) -> dict[tuple[str, int], float]:
    """``{(column, rank): value}`` for 0-based ``ranks`` of ``values(c string,
    v double)``, which has no missing values; ``rows`` counts each column's
    rows.  ``marks`` are fractions near which most ranks lie."""
    found: dict[tuple[str, int], float] = {}
    left = [_Range(c, None, None, 0, rows[c], sorted(set(r))) for c, r in ranks.items() if rows.get(c) and r]
    near = sorted({min(1.0, max(0.0, m + d / ACCURACY)) for m in marks for d in (-2, 0, 2)})
    even = [i / CUTS for i in range(CUTS + 1)]
    first = True
    while left:
        small, large = [r for r in left if r.rows <= bound], [r for r in left if r.rows > bound]
        if small:
            _read_out(values, small, found)
        if not large:
            break
        left = _narrowed(values, large, near if first and near else even, found)
        if first and left:  # later rounds read the rows of the ranges only
            values = stored(_inside(values, left, [[] for _ in left], "int").select("c", "v"), "selection")
        first = False
    return found


def interpolated(found: dict, column: str, rows: int, prob: float) -> float | None:
    """The quantile between the two ranks around ``prob``, linearly."""
    if not rows:
        return None
    at = prob * (rows - 1)
    lo, hi = math.floor(at), math.ceil(at)
    a, b = found[column, lo], found[column, hi]
    return a if lo == hi else (hi - at) * a + (at - lo) * b


def wanted_ranks(rows: int, probs: Sequence[float]) -> list[int]:
    return sorted({f(p * (rows - 1)) for p in probs for f in (math.floor, math.ceil)}) if rows else []
