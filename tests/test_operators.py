"""Aggregates, joins, set operations, reshape, statistics."""
import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from panelspark.operators.aggregate import (
    count_by, exact_sum, ratio_of_sums, refresh_guard, rollup_sum0, scalar_max, sum_max_by,
)
from panelspark.operators.joins import drop_keys, keep_keys, missing_pairs, null_safe_join
from panelspark.operators.reshape import columns_to_long, long_to_wide, split_to_rows, tokenize, wide_to_long
from panelspark.operators.select import (
    best_and_worst, between_dates, columns_matching, complete_rows, filter_in, rows_at_max,
    sort_desc_last, top_n, with_stages,
)
from panelspark.operators.setops import replace_keys, union_by_name, union_distinct
from panelspark.operators.stats import bucket_of, correlation_long, quantile_breaks, ramp_level
from tests.conftest import rows

D = [dt.date(2020, 1, d) for d in range(1, 8)]


def test_rollup_all_missing_group_is_zero(spark):
    df = spark.createDataFrame([("c", "s1", D[0], None), ("c", "s2", D[0], None), ("c", "s1", D[1], 4)],
                               "country string, state string, date date, confirmed int")
    got = dict((r.date, r.confirmed) for r in rollup_sum0(df, ["country", "date"], ["confirmed"]).collect())
    assert got == {D[0]: 0, D[1]: 4}


def test_ratio_of_sums_skips_missing_denominator(spark):
    df = spark.createDataFrame([(D[0], 10, 1.5), (D[0], 5, None), (D[1], 3, 0.0)],
                               "date date, x long, population double")
    got = dict(ratio_of_sums(df, ["date"], {"r": "x"}, "population").collect())
    assert got == {D[0]: 10.0, D[1]: None}


def test_exact_sum_is_order_independent(spark):
    vals = [(0.000150,), (0.1,), (0.2,), (1e-6,)] * 50
    a = spark.createDataFrame(vals, "p double").agg(exact_sum("p")).first()[0]
    b = spark.createDataFrame(list(reversed(vals)), "p double").repartition(7).agg(exact_sum("p")).first()[0]
    assert a == b


def test_count_by_and_scalar_max(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",)], "word string")
    assert [tuple(r) for r in count_by(df, "word").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    d = spark.createDataFrame([(D[0],), (D[3],)], "date date")
    assert d.select(scalar_max(d, "date").alias("m")).first().m == D[3]


def test_refresh_guard(spark):
    ok = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    bad = spark.createDataFrame([(None, None)], "a int, b int")
    empty = spark.createDataFrame([], "a int, b int")
    assert ok.select(refresh_guard(ok)).first()[0] is True
    assert bad.select(refresh_guard(bad)).first()[0] is False
    assert ok.select(refresh_guard(empty)).first()[0] is False


def test_null_safe_join_matches_null_keys(spark):
    a = spark.createDataFrame([("s", None, 1), ("t", 2.0, 2)], "k string, lat double, x int")
    b = spark.createDataFrame([("s", None, 10)], "k string, lat double, y int")
    got = rows(null_safe_join(a, b, ["k", "lat"], "left"))
    assert got == [("s", None, 1, 10), ("t", 2.0, 2, None)]
    assert rows(drop_keys(a, b, ["k", "lat"])) == [("t", 2.0, 2)]


def test_keep_keys_and_missing_pairs(spark):
    df = spark.createDataFrame([("a", D[0]), ("b", D[0]), ("a", D[1])], "k string, date date")
    assert keep_keys(df, spark.createDataFrame([("a",)], "k string"), "k", bounded=True).count() == 2
    grid = spark.createDataFrame([(k, d) for k in "ab" for d in D[:2]], "k string, date date")
    assert rows(missing_pairs(grid, df, ["k", "date"])) == [("b", D[1])]


def test_union_by_name_pads_and_distinct(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, id int")
    c = spark.createDataFrame([(3,)], "id int")
    assert rows(union_by_name(a, b, c)) == [(1, "x"), (2, "y"), (3, None)]
    assert union_distinct(a, a, b).count() == 2


def test_replace_keys_new_wins(spark):
    old = spark.createDataFrame([("s", D[0], 1.0), ("s", D[1], 2.0)], "symbol string, date date, v double")
    new = spark.createDataFrame([("s", D[1], 9.0), ("s", D[2], 3.0)], "symbol string, date date, v double")
    assert rows(replace_keys(old, new, ["symbol", "date"])) == [("s", D[0], 1.0), ("s", D[1], 9.0), ("s", D[2], 3.0)]


def test_wide_long_round_trip(spark):
    long = spark.createDataFrame([(D[0], "aa", 1.0), (D[0], "bb", 2.0), (D[1], "aa", 3.0)],
                                 "date date, symbol string, adjusted double")
    wide = long_to_wide(long, ["date"], "symbol", "adjusted", ["aa", "bb"])
    back = wide_to_long(wide, ["date"], ["aa", "bb"], "symbol", "adjusted").filter("adjusted is not null")
    assert rows(back) == rows(long)
    assert complete_rows(wide).count() == 1


def test_columns_to_long_relabel(spark):
    df = spark.createDataFrame([(D[0], 5.0, 1.0)], "date date, positive double, zm double")
    got = rows(columns_to_long(df, ["date"], ["positive", "zm"], {"positive": "Confirmed Cases"}))
    assert got == [(D[0], "Confirmed Cases", 5.0), (D[0], "zm", 1.0)]


def test_split_and_tokenize(spark):
    df = spark.createDataFrame([(1, "a|b||c|")], "id int, t string")
    assert [r.item for r in split_to_rows(df, "t", "|", keep=["id"]).collect()] == ["a", "b", "c"]
    tk = tokenize(spark.createDataFrame([(D[0], "Hello, World")], "date date, h string"), "h")
    assert rows(tk) == [(D[0], "hello"), (D[0], "world")]


def test_selection_helpers(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", None), ("c", 5.0), ("d", 5.0)], "k string, v double")
    assert [r.k for r in df.orderBy(*sort_desc_last("v", tiebreak=["k"])).collect()] == ["c", "d", "a", "b"]
    assert [r.k for r in top_n(df, sort_desc_last("v", tiebreak=["k"]), 2).collect()] == ["c", "d"]
    assert filter_in(df, "k", None).count() == 4 and filter_in(df, "k", ["a"]).count() == 1
    assert columns_matching(spark.createDataFrame([(1, 2, 3)], "`1/22/20` int, X1_2 int, `X1.23.20` int"),
                            r"^X?\d{1,2}[./]\d{1,2}[./]\d{2,4}$") == ["1/22/20", "X1.23.20"]
    st = with_stages(df, {"w": F.col("v") * 2}, {"w": F.col("w") + 1})
    assert st.filter("k = 'a'").first().w == 7.0
    bw = best_and_worst(df.na.drop(), "k", "v").first()
    assert (bw.best_k, bw.worst_k) == ("c", "a")
    assert rows_at_max(df, "v").count() == 2


def test_between_dates_pushes_timestamp_filter(spark, scratch):
    ts = [(dt.datetime(2024, 1, d, 12),) for d in range(1, 10)]
    spark.createDataFrame(ts, "ts timestamp_ntz").write.parquet(scratch + "/t")
    df = spark.read.parquet(scratch + "/t")
    out = between_dates(df, "ts", dt.date(2024, 1, 3), dt.date(2024, 1, 5))
    assert out.count() == 3
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in out._jdf.queryExecution().executedPlan().toString()


def test_quantiles_match_numpy_linear(spark):
    vals = [float(v) for v in np.random.default_rng(1).normal(size=101).round(2)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    br = quantile_breaks(df, ["x"]).first().x
    expect = np.percentile(vals, [5 * i for i in range(20)], method="linear")
    assert np.allclose(br, expect, atol=1e-12)
    b = df.select(bucket_of("x", F.array(*[F.lit(v) for v in br]), len(br)).alias("b"))
    assert {r.b for r in b.collect()} <= set(range(21))


def test_ramp_levels(spark):
    df = spark.range(21).select(ramp_level(F.col("id")).alias("c"))
    got = [r.c for r in df.collect()]
    assert got[0] == 255 and got[-1] == 40 and got[2] == 234


def test_correlation_long_symmetric_and_constant(spark):
    data = [(float(i), float(2 * i + (i % 3)), 1.0) for i in range(10)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in correlation_long(df, ["a", "b", "c"]).collect()}
    assert got[("a", "c")] is None and got[("b", "c")] is None
    assert abs(got[("a", "b")] - np.corrcoef([d[0] for d in data], [d[1] for d in data])[0, 1]) < 1e-6


def test_sum_max_by_base_name(spark):
    df = spark.createDataFrame([("France – Paris", 3.0, D[0]), ("France", 2.0, D[1]), ("Chad", 1.0, D[0])],
                               "country string, tests double, date date")
    key = F.btrim(F.regexp_replace("country", " – .*$", ""))
    got = rows(sum_max_by(df, key, {"tests": "tests"}, {"date": "date"}, "country"))
    assert got == [("Chad", 1.0, D[0]), ("France", 5.0, D[1])]


def test_review_fixes_null_handling(spark):
    from panelspark.functions import safe_corr
    from panelspark.operators.window import latest_rows
    # latest rows keep an entity whose key is missing
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", 1)], "k string, d int")
    assert rows(latest_rows(df, ["k"], "d")) == [("x", 1), (None, 2)]
    # best/worst ignore rows without a value
    bw = best_and_worst(spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0)], "k string, v double"),
                        "k", "v").first()
    assert (bw.best_k, bw.best_v, bw.worst_k, bw.worst_v) == ("c", 3.0, "a", 1.0)
    # correlation over pairwise-complete rows, like corr
    data = [(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (4.0, None), (None, 100.0), (5.0, 10.2)]
    d2 = spark.createDataFrame(data, "a double, b double")
    ours = d2.agg(safe_corr("a", "b")).first()[0]
    spark_corr = d2.agg(F.corr("a", "b")).first()[0]
    assert abs(ours - spark_corr) < 1e-12


def test_buckets_with_other_break_counts(spark):
    from panelspark.operators.stats import with_buckets
    df = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    br = quantile_breaks(df, ["x"], probs=(0.0, 0.25, 0.5, 0.75))
    out = with_buckets(df, ["x"], br, n_breaks=4).collect()
    levels = {r.x_bucket: r.x_level for r in out}
    assert min(levels.values()) == 40 and max(levels.values()) == 255 and len(levels) == 5


def test_no_nested_loop_join_for_null_safe_semi(spark):
    from panelspark.operators.window import latest_rows
    df = spark.createDataFrame([(None, 1), ("x", 2)], "k string, d int")
    p = latest_rows(df, ["k"], "d")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_projection_helpers(spark):
    from panelspark.operators.select import columns_present, drop_positions, rename_all
    df = spark.createDataFrame([(1, "a", 2.0)], "rank int, Country string, Population double")
    assert drop_positions(df, [0]).columns == ["Country", "Population"]
    assert rename_all(drop_positions(df, [0]), ["country", "population"]).columns == ["country", "population"]
    assert rename_all(df, ["r"]).columns == ["r", "Country", "Population"]
    assert columns_present(df, ["date", "Country", "positive", "rank"]) == ["Country", "rank"]


def test_correlation_full_matrix_symmetric_unit_diagonal(spark):
    data = [(float(i), float((i * 7) % 5), float(i * i), 2.0) for i in range(12)]
    df = spark.createDataFrame(data, "a double, b double, c double, k double")
    m = {(r.a, r.b): r.r for r in correlation_long(df, ["a", "b", "c", "k"], full=True).collect()}
    assert len(m) == 16
    for x in "abck":
        for y in "abck":
            assert m[(x, y)] == m[(y, x)]
    assert m[("a", "a")] == 1.0 and m[("k", "k")] is None and m[("a", "k")] is None


def test_pivot_fails_outside_its_list(spark):
    import pytest
    df = spark.createDataFrame([(1, "a", 2.0), (1, "other", 3.0)], "k int, t string, v double")
    with pytest.raises(Exception, match="outside the given list: other"):
        long_to_wide(df, ["k"], "t", "v", ["a"], agg="sum").collect()


def test_words_follow_the_unicode_breaks(spark):
    text = "Don’t pay 1,000.50 or 3.14 for snake_case in the U.S. a.b.c x.1 1.x 'quoted' e-mail naïve 12:30"
    df = spark.createDataFrame([(text,)], "t string")
    assert [r.word for r in tokenize(df, "t").collect()] == [
        "don’t", "pay", "1,000.50", "or", "3.14", "for", "snake_case", "in", "the", "u.s", "a.b.c", "x", "1", "1", "x",
        "quoted", "e", "mail", "naïve", "12", "30"]


def test_correlation_of_many_columns(spark):
    rng = np.random.default_rng(5)
    data = rng.standard_normal((60, 200)) + 1000.0
    data[:, 7] = 0.1
    names = [f"c{i}" for i in range(200)]
    df = spark.createDataFrame([[float(x) for x in r] for r in data], names)
    got = {(r.a, r.b): r.r for r in correlation_long(df, names).collect()}
    want = np.corrcoef(data[:, 3], data[:, 150])[0, 1]
    assert len(got) == 200 * 199 // 2 and abs(got["c3", "c150"] - want) < 1e-6 and got["c0", "c7"] is None


def test_quantiles_of_skewed_values_in_small_parts(spark):
    rng = np.random.default_rng(6)
    vals = np.concatenate([np.full(3000, 5.0), rng.exponential(10, 4000).round(1), [-1e9, 1e9]])
    df = spark.createDataFrame([(float(v), None if i % 2 else float(-v)) for i, v in enumerate(vals)], "x double, y double")
    br = quantile_breaks(df, ["x", "y"]).first()
    q = [5 * i for i in range(20)]
    assert np.allclose(br.x, np.percentile(vals, q), atol=1e-9) and np.allclose(br.y, np.percentile(-vals[::2], q), atol=1e-9)
