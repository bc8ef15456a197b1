"""Roll-ups of brushed ranges and mergeable correlations, against direct ones."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.functions.dates import EPOCH
from panelspark.operators.stats import correlation_long
from panelspark.plans import rollups as R

DAY = dt.date(2020, 1, 29)


def test_ranges_are_few_blocks_without_overlap():
    rnd = random.Random(2)
    for _ in range(300):
        lo = rnd.randint(-500, 30_000)
        hi = lo + rnd.randint(0, 5000)
        pieces = R.day_blocks(lo, hi)
        days = [d for level, b in pieces for d in range(b << level, (b + 1) << level)]
        assert sorted(days) == list(range(lo, hi + 1))
        assert len(pieces) <= 2 * R.LEVELS
    assert R.day_blocks(5, 4) == []
    assert len(R.day_blocks(0, 100, levels=3)) == 26  # beyond the top level: its blocks


def words(spark, n=900):
    rnd = random.Random(1)
    rows = [(DAY + dt.timedelta(days=rnd.randint(0, 70)), rnd.choice("abcdefgh")) for _ in range(n)]
    return spark.createDataFrame(rows + [(None, "a")], "date date, word string")


def test_counts_of_ranges_with_days_appended(spark, scratch):
    df, store = words(spark), f"{scratch}/counts"
    cut = F.col("date") <= DAY + dt.timedelta(days=30)
    R.add_counts(df.where(cut), store, "date", "word")
    R.add_counts(df.where(~cut), store, "date", "word")
    stop = spark.createDataFrame([("c",)], "word string")
    for a, b in ((0, 70), (3, 3), (17, 52), (-90, 400), (60, 20)):
        lo, hi = DAY + dt.timedelta(days=a), DAY + dt.timedelta(days=b)
        want = {r.word: r.n for r in df.where(F.col("date").between(lo, hi)).where("word not in ('c', 'd')")
                .groupBy("word").agg(F.count("*").alias("n")).collect()}
        got = R.word_counts_between(spark, store, stop, lo, hi, exclude=("d",)).collect()
        assert {r.word: r.n for r in got} == want
        assert [r.n for r in got] == sorted((r.n for r in got), reverse=True)


def test_a_range_reads_its_blocks_only(spark, scratch):
    store = f"{scratch}/counts"
    R.add_counts(words(spark), store, "date", "word")
    got = R.range_counts(spark, store, DAY, DAY + dt.timedelta(days=63))
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert plan.count("FileScan") == 1 and "level" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "block" in scan.split("PushedFilters: ")[1]


def series(spark, n, holes=True):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(n, 4)).cumsum(axis=0) + 1e6
    x[:, 3] = 7.0  # a constant column
    rows = []
    for i in range(n):
        v = [float(y) for y in x[i]]
        if holes and i % 5 == 0:
            v[1] = None
        rows.append((DAY + dt.timedelta(days=i), *v))
    return spark.createDataFrame(rows, "date date, a double, b double, c double, k double")


def cells(df):
    return {(r.a, r.b): r.r for r in df.collect()}


@pytest.mark.parametrize("days", [1, 7, 30])
def test_correlation_of_appended_days_and_ranges(spark, scratch, days):
    df, store, cols = series(spark, 140), f"{scratch}/m{days}", ["a", "b", "c", "k"]
    for lo, hi in ((0, 60), (61, 61), (62, 139)):
        span = F.col("date").between(DAY + dt.timedelta(days=lo), DAY + dt.timedelta(days=hi))
        R.add_moments(df.where(span).repartition(3), store, "date", cols, days)
    assert cells(R.stored_correlation(spark, store, cols)) == cells(correlation_long(df, cols, full=True))
    first = ((DAY - EPOCH).days + 40) // days
    some = df.where(F.floor(F.datediff("date", F.lit(EPOCH)) / days).between(first, first + 3))
    assert cells(R.stored_correlation(spark, store, cols, first, first + 3)) == cells(correlation_long(some, cols, full=True))


def test_the_series_is_not_read_again(spark, scratch):
    store = f"{scratch}/m"
    R.add_moments(series(spark, 30), store, "date", ["a", "b"], 7)
    plan = R.stored_correlation(spark, store, ["a", "b"], 0, 9)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "period" in plan.split("PushedFilters")[1]
