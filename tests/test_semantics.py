"""The semantic rules (null/NaN, rounding, white space, text, dates)."""
import datetime as dt

from pyspark.sql import functions as F

from panelspark.functions import (
    date_spine, empty_if_null, na_text, parse_mdy, parse_ymd, rround, safe_corr, safe_div, sum0,
    to_number, trim_ws,
)
from panelspark.functions.text import cut_between, drop_control, split_items, strip_spans, words


def one(spark, expr, data=None, schema="x double"):
    df = spark.createDataFrame(data or [(1.0,)], schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (4, 2), (None, 1)], "a int, b int")
    assert [r.v for r in df.select(safe_div("a", "b").alias("v")).collect()] == [None, None, 2.0, None]


def test_sum_of_all_missing_is_zero(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("y", 3)], "k string, v int")
    got = dict(df.groupBy("k").agg(sum0("v").alias("s")).collect())
    assert got == {"x": 0, "y": 3}


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (0.125,), (-2.5,)], "x double")
    assert [r.v for r in df.select(rround("x", 0).alias("v")).collect()] == [0.0, 2.0, 2.0, 0.0, -2.0]
    assert df.select(rround("x", 2).alias("v")).collect()[3].v == 0.12


def test_trim_all_whitespace_and_empty_text(spark):
    df = spark.createDataFrame([(" \tUS\r\n",), (None,), ("",)], "s string")
    assert [r.v for r in df.select(trim_ws("s").alias("v")).collect()] == ["US", None, ""]
    assert [r.v for r in df.select(empty_if_null("s").alias("v")).collect()][1:] == ["", ""]


def test_to_number(spark):
    df = spark.createDataFrame([("1,439,323,776",), ("0.39 %",), ("N.A.",), (None,)], "s string")
    assert [r.v for r in df.select(to_number("s").alias("v")).collect()] == [1439323776.0, 0.39, None, None]


def test_corr_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 1.0)], "a double, b double")
    assert df.agg(safe_corr("a", "b")).first()[0] is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "a double, b double")
    assert abs(df2.agg(safe_corr("a", "b")).first()[0] - 0.9986) < 1e-3


def test_na_text(spark):
    df = spark.createDataFrame([(None,), (3,)], "x int")
    assert [r.v for r in df.select(na_text("x").alias("v")).collect()] == ["NA", "3"]


def test_parse_mdy_both_widths_and_two_digit_rule(spark):
    df = spark.createDataFrame([("1/22/20",), ("1/22/2020",), ("12/31/99",), ("3/1/68",), ("bad",)], "s string")
    got = [r.v for r in df.select(parse_mdy("s").alias("v")).collect()]
    assert got == [dt.date(2020, 1, 22), dt.date(2020, 1, 22), dt.date(1999, 12, 31),
                   dt.date(2068, 3, 1), None]


def test_parse_ymd_number(spark):
    df = spark.createDataFrame([(20200105,), (None,)], "n long")
    assert [r.v for r in df.select(parse_ymd("n").alias("v")).collect()] == [dt.date(2020, 1, 5), None]


def test_date_spine_inclusive_and_empty_when_reversed(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2020, 1, 3)),
                                (dt.date(2020, 1, 3), dt.date(2020, 1, 1))], "a date, b date")
    got = [r.v for r in df.select(date_spine("a", "b").alias("v")).collect()]
    assert got == [[dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 1, 3)], []]


def test_split_items_drops_empty_pieces(spark):
    df = spark.createDataFrame([("a|b|",), ("",), ("|a||b",), (None,)], "s string")
    got = [r.v for r in df.select(split_items(F.col("s"), "|").alias("v")).collect()]
    assert got == [["a", "b"], [], ["a", "b"], None]


def test_cut_between_last_start_first_end(spark):
    df = spark.createDataFrame([("x S1 a S1 b E c E d",), ("no markers",)], "s string")
    got = [r.v for r in df.select(cut_between(F.col("s"), "S1", "E").alias("v")).collect()]
    assert got == [" b ", "no markers"]


def test_cut_crosses_lines_and_crlf_delimiter(spark):
    df = spark.createDataFrame([("head\nSTART\r\none\r\ntwo\t\nEND\ntail",)], "s string")
    body = drop_control(cut_between(F.col("s"), "START", "END"), "|")
    assert df.select(split_items(body, "|").alias("v")).first().v == ["one", "two"]


def test_strip_spans_greedy_over_lines(spark):
    df = spark.createDataFrame([("keep <a>\n drop </a> tail",)], "s string")
    assert df.select(strip_spans(F.col("s")).alias("v")).first().v == "keep  tail"


def test_words_lower_unicode_apostrophes(spark):
    df = spark.createDataFrame([("Don't STOP: Élan 42x, l'été!",)], "s string")
    assert df.select(words(F.col("s")).alias("v")).first().v == ["don't", "stop", "élan", "42x", "l'été"]


def test_strip_spans_equals_greedy_regex(spark):
    import random
    import re
    random.seed(7)
    cases = ["".join(random.choice("ab<>\n ") for _ in range(random.randint(0, 12))) for _ in range(1500)]
    cases += ["", "<", ">", "<>", "><", "a<b>c<d>e", "x>y<z", "<<>>"]
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = [r.v for r in df.select(strip_spans(F.col("t")).alias("v")).collect()]
    assert got == [re.sub(r"(?s)(<.*>)", "", t) for t in cases]


def test_num_text_prints_like_the_source(spark):
    from panelspark.functions import num_text
    vals = [0.07 * 100, 0.0, -0.0, 12.5, 100.0, 1e-05, 100 / 3, 100000.0, 123456.0, 0.0001, 0.00012, 1e15, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.t for r in df.select(num_text("x").alias("t")).collect()]
    assert got == ["7", "0", "0", "12.5", "100", "1e-05", "33.3333333333333", "1e+05", "123456",
                   "1e-04", "0.00012", "1e+15", "NA"]
    ints = spark.createDataFrame([(123456,), (None,)], "n long")
    assert [r.t for r in ints.select(num_text("n").alias("t")).collect()] == ["123456", "NA"]


def test_pretty_num(spark):
    from panelspark.functions import pretty_num
    vals = [12345.0, 1234567.891, 123.456789, 123456789.0, -9876.5, 0.5, None, 1e-9]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.t for r in df.select(pretty_num("x").alias("t")).collect()]
    assert got == ["12,345", "1,234,568", "123.4568", "123,456,789", "-9,876.5", "0.5", "NA", "1e-09"]


def test_pretty_num_rounds_halves_to_even(spark):
    """As the source prints 2329192.5 with seven digits: not away from zero."""
    from panelspark.functions import num_text, pretty_num
    vals = [2329192.5, 2329193.5, -2329192.5, 12345678.5, 9999999.5, 999999.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.t for r in df.select(pretty_num("x").alias("t")).collect()]
    assert got == ["2,329,192", "2,329,194", "-2,329,192", "12,345,678", "1e+07", "999,999.5"]
    wide = spark.createDataFrame([(100000000000000.5,), (999999999999999.9,), (0.1 + 0.2,)], "x double")
    assert [r.t for r in wide.select(num_text("x").alias("t")).collect()] == ["100000000000000", "1e+15", "0.3"]
