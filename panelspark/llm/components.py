"""Connected components of an edge table, by alternating large-star and
small-star steps.  No edge, node or label is ever collected; each step is a
pre-aggregated minimum per node and one join, written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("k"), F.least("a", "m").alias("m"))
    return (both.where("b > a").join(low, F.col("a") == F.col("k"))
            .select(F.col("m").alias("a"), "b").where("a < b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a < b; each b links its smaller neighbours to the least."""
    low = edges.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "k")
    moved = (edges.join(low, F.col("b") == F.col("k"))
             .select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b"))
    return moved.unionByName(low.select(F.col("m").alias("a"), F.col("k").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of comparable ids -> ``(node, label)`` for every node of
    an edge, label the least node reachable.  Ends when no edge changes, so
    the result is exact; ``max_rounds`` only guards against an endless loop."""
    cur = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"),
                                              F.greatest("a", "b").alias("b")).distinct(), "edges")
    state = _state(cur)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        nxt = stored(_small_star(_large_star(cur)), "edges", rows=state[0])  # a step adds no edge
        new = _state(nxt)
        cur = nxt
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not converge")
    return (cur.select(F.col("b").alias("node"), F.col("a").alias("label"))
            .unionByName(cur.select(F.col("a").alias("node"), F.col("a").alias("label"))).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003),
                              F.bit_xor(F.xxhash64("a", "b"))).first())
