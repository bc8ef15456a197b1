"""Skew: one key holding a third of all rows (derived from the events
table in this test only) -- results must equal a brute-force pandas
computation, with nothing dropped or capped."""
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.functions.semantics import money_sum
from panelspark.operators.aggregate import rollup_sum0
from panelspark.operators.window import first_per_key, gap_fill, latest_rows

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def skewed(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    return ev.select("event_id", "ts", hot.alias("user_id"), "event_type", "value",
                     F.to_date("ts").alias("date"))


def test_hot_key_is_a_third(skewed):
    n = skewed.count()
    assert skewed.filter("user_id = 0").count() >= n // 3


def test_latest_rows_under_skew(spark, skewed):
    pdf = skewed.toPandas()
    mx = pdf.groupby("user_id")["date"].transform("max")
    expect = sorted(pdf[pdf["date"] == mx]["event_id"].tolist())
    got = sorted(r.event_id for r in latest_rows(skewed, ["user_id"], "date").select("event_id").collect())
    assert got == expect


def test_first_per_key_under_skew(spark, skewed):
    pdf = skewed.toPandas().sort_values(["ts", "event_id"])
    expect = pdf.groupby(["user_id", "date"], as_index=False).first()
    got = first_per_key(skewed.select("user_id", "date", "ts", "event_id"), ["user_id", "date"], ["ts"]).toPandas()
    m = expect.merge(got, on=["user_id", "date"], suffixes=("_e", "_g"))
    assert len(m) == len(expect) == len(got) and (m["event_id_e"] == m["event_id_g"]).all()


def test_rollup_and_gap_fill_under_skew(spark, skewed):
    daily = rollup_sum0(skewed.select("user_id", "date", F.lit(1).alias("n")), ["user_id", "date"], ["n"])
    pdf = skewed.toPandas()
    expect = pdf.groupby(["user_id", "date"]).size()
    got = daily.toPandas().set_index(["user_id", "date"])["n"]
    assert got.sort_index().tolist() == expect.sort_index().tolist()
    hot_days = (skewed.filter("user_id = 0").groupBy("user_id", "date")
                      .agg(money_sum("value").alias("v")))
    filled = gap_fill(hot_days, ["user_id"], "date", ["v"]).toPandas()
    assert filled["v"].notna().all() and len(filled) == pdf[pdf.user_id == 0]["date"].nunique()
