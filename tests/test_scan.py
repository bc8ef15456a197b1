"""Running state over segments, global ranks: equal to the window forms."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.operators.ranking import row_numbers, rows_at_ranks
from panelspark.operators.scan import (
    SEGMENT, gap_fill_rows, last_value, previous_value, running_count, running_min, running_state, running_sum, spread,
)
from panelspark.operators.window import gap_fill
from panelspark.plans.reports import selected_keys


def frame(spark, n=600, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        e = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", "c", None])
        rows.append((e, rnd.randint(0, 40), i, rnd.choice([None, None, 1.0, 2.5, -3.0])))
    return spark.createDataFrame(rows, "e string, d int, id int, v double")


def rows(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("segments", [1, 3, 16])
def test_running_columns_equal_windows(spark, segments):
    df = frame(spark)
    got = running_state(df, "e", ["d", "id"], {
        "s": running_sum("v"), "n": running_count(F.col("v") > 0), "l": last_value("v"), "p": previous_value("v"),
        "lo": running_min("v")}, segments)
    w = Window.partitionBy("e").orderBy("d", "id")
    far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumns({
        "s": F.sum("v").over(far), "n": F.coalesce(F.sum((F.col("v") > 0).cast("bigint")).over(far), F.lit(0)),
        "l": F.last("v", ignorenulls=True).over(far), "p": F.lag("v").over(w), "lo": F.min("v").over(far)})
    cols = ["e", "d", "id", "v", "s", "n", "l", "p", "lo"]
    assert rows(got, cols) == rows(want, cols)


def test_a_hot_entity_covers_many_segments(spark):
    parts = spread(frame(spark, 3000), ["e"], ["d", "id"], 12)
    per = {r[SEGMENT]: r.n for r in parts.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("n")).collect()}
    hot = parts.where("e = 'hot'").select(SEGMENT).distinct().count()
    assert hot >= 5 and max(per.values()) < 3000 / 3


@pytest.mark.parametrize("segments", [1, 9])
def test_gap_fill_of_existing_rows(spark, segments):
    df = frame(spark, 400, 3).where("e is not null")
    got = gap_fill_rows(df, "e", "d", ["v"], ["id"], segments)
    # the window form, ordered by (d, id) within the entity
    first = F.min("d").over(Window.partitionBy("e"))
    z = df.withColumn("v", F.when(F.col("v").isNull() & (F.col("d") == first), 0.0).otherwise(F.col("v")))
    w = Window.partitionBy("e").orderBy("d", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = z.withColumn("v", F.last("v", ignorenulls=True).over(w))
    assert rows(got, ["e", "d", "id", "v"]) == rows(want, ["e", "d", "id", "v"])
    assert got.count() == df.count()


def test_gap_fill_forms_agree_on_a_panel(spark):
    df = frame(spark, 400, 5).groupBy("e", "d").agg(F.max("v").alias("v")).where("e is not null")
    assert rows(gap_fill_rows(df, "e", "d", ["v"], segments=7), ["e", "d", "v"]) == rows(
        gap_fill(df, ["e"], "d", ["v"]), ["e", "d", "v"])


def test_scans_of_an_empty_table(spark):
    df = frame(spark, 10).where("id < 0")
    assert running_state(df, "e", ["d", "id"], {"s": running_sum("v")}).count() == 0
    assert row_numbers(df, ["id"]).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_row_numbers_of_a_whole_table(spark, partitions):
    df = frame(spark, 500)
    order = [F.desc_nulls_last("v"), F.asc("id")]
    got = row_numbers(df, order, partitions=partitions)
    want = df.withColumn("row_no", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)).cast("bigint"))
    assert rows(got, ["id", "v", "row_no"]) == rows(want, ["id", "v", "row_no"])
    assert [r.id for r in rows_at_ranks(df, order, [500, 2, 77, 900], partitions=partitions).orderBy("row_no").collect()] == [
        r.id for r in want.where("row_no in (2, 77, 500)").orderBy("row_no").collect()]


def test_row_numbers_need_no_unpartitioned_window(spark):
    plan = row_numbers(frame(spark, 50), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_large_ranks_are_selected_without_a_top_k(spark, monkeypatch):
    from panelspark.plans import reports
    monkeypatch.setattr(reports, "TOP_RANKS", 3)
    df = spark.range(40).selectExpr("id", "concat('k', id) as e")
    got = selected_keys(df, "e", [F.desc("id")], [2, 30])
    assert sorted(r.e for r in got.collect()) == ["k10", "k38"]
