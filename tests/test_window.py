"""Per-entity ordered operators (W-family)."""
import datetime as dt

from pyspark.sql import functions as F

from panelspark.operators.window import (
    carry_forward, cumulative_return, first_per_key, gap_fill, latest_flag, latest_rows,
    new_keep_first, new_zero_first, return_factor, row_index, threshold_days,
)

D = [dt.date(2020, 1, d) for d in range(1, 8)]


def series(spark):
    # entity a: rises past 100 and falls back (W4), level falls (negative new)
    data = [("a", D[0], 50), ("a", D[1], 120), ("a", D[2], 90), ("a", D[3], 130),
            ("b", D[2], 5), ("b", D[4], 7)]
    # rows deliberately out of order: every window names its own order
    return spark.createDataFrame(list(reversed(data)), "k string, date date, x long")


def test_first_row_rules(spark):
    df = series(spark).withColumns({
        "w1": new_keep_first("x", "k", "date"), "w2": new_zero_first("x", "k", "date")})
    got = {(r.k, r.date): (r.w1, r.w2) for r in df.collect()}
    assert got[("a", D[0])] == (50, 0)
    assert got[("a", D[2])] == (-30, -30)
    assert got[("b", D[2])] == (5, 0)


def test_sum_of_new_equals_last_level(spark):
    df = series(spark).withColumn("w1", new_keep_first("x", "k", "date"))
    s = dict(df.groupBy("k").agg(F.sum("w1")).collect())
    assert s == {"a": 130, "b": 7}


def test_change_of_change(spark):
    df = series(spark).withColumn("n", new_zero_first("x", "k", "date"))
    df = df.withColumn("nn", new_zero_first("n", "k", "date"))
    got = [r.nn for r in df.filter("k = 'a'").orderBy("date").collect()]
    assert got == [0, 70, -100, 70]


def test_threshold_counter_does_not_reset(spark):
    df = series(spark).withColumn("bd", threshold_days("x", "k", "date", 100))
    got = [r.bd for r in df.filter("k = 'a'").orderBy("date").collect()]
    assert got == [0, 1, 1, 2]


def test_latest_flag_keeps_ties(spark):
    df = spark.createDataFrame([("a", D[0]), ("a", D[1]), ("a", D[1])], "k string, date date")
    assert sum(r.f for r in df.select(latest_flag("date", "k").alias("f")).collect()) == 2
    assert latest_rows(df, ["k"], "date").count() == 2


def test_returns_telescoping_matches_product(spark):
    px = [("s", D[i], p) for i, p in enumerate([10.0, 11.0, 9.9, 12.0])]
    df = spark.createDataFrame(px, "symbol string, date date, adjusted double").withColumns({
        "obs": row_index("symbol", "date"),
        "f": return_factor("adjusted", "symbol", "date"),
        "cum": cumulative_return("adjusted", "symbol", "date")})
    rs = df.orderBy("date").collect()
    assert [r.obs for r in rs] == [1, 2, 3, 4] and rs[0].f == 1.0 and rs[0].cum == 0.0
    prod = 1.0
    for r in rs:
        prod *= r.f
        assert abs((prod - 1) - r.cum) < 1e-12


def test_gap_fill_zero_first_then_carry(spark):
    data = [("p", D[0], None), ("p", D[1], 3), ("p", D[2], None), ("p", D[3], 5), ("p", D[4], None),
            ("q", D[0], 2), ("q", D[1], None)]
    df = spark.createDataFrame(data, "loc string, date date, v long")
    out = gap_fill(df, ["loc"], "date", ["v"]).orderBy("loc", "date").collect()
    assert [r.v for r in out] == [0, 3, 3, 5, 5, 2, 2]
    assert all(r.v is not None for r in out)


def test_carry_forward_null_lat_groups_together(spark):
    df = spark.createDataFrame([(None, D[0], 1), (None, D[1], None)], "lat double, date date, v long")
    assert [r.v for r in df.select(carry_forward("v", ["lat"], "date").alias("v")).collect()] == [1, 1]


def test_first_per_key_is_deterministic(spark):
    batch = [("s", D[0], 3, 10.0), ("s", D[0], 1, 11.0), ("s", D[0], 1, 9.0), ("t", D[0], 2, 1.0)]
    df = spark.createDataFrame(batch, "symbol string, date date, src int, adjusted double")
    out = {r.symbol: (r.src, r.adjusted) for r in first_per_key(df, ["symbol", "date"], ["src"]).collect()}
    assert out == {"s": (1, 9.0), "t": (2, 1.0)}
