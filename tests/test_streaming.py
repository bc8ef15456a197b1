"""Incremental refresh driven by a file stream (availableNow)."""
import json
import os

from pyspark.sql import types as T

from panelspark.streaming.refresh import run_refresh
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()),
                       T.StructField("adjusted", T.DoubleType()), T.StructField("src", T.IntegerType())])
STORE = T.StructType([f for f in SCHEMA.fields if f.name != "src"])


def land(folder, name, recs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def test_stream_upsert_processes_only_new_files(spark, scratch):
    landing, root, ckpt = f"{scratch}/landing", f"{scratch}/tables", f"{scratch}/ckpt"
    spark.sql("DROP TABLE IF EXISTS stock_stream")
    kw = dict(mode="upsert", keys=["symbol", "date"], order=["src"], value="adjusted",
              checkpoint=ckpt, table_schema=STORE, partitioned=False)
    land(landing, "b1.json", [{"symbol": "zm", "date": "2020-03-02", "adjusted": 1.0, "src": 1},
                              {"symbol": "zm", "date": "2020-03-02", "adjusted": 7.0, "src": 2},
                              {"symbol": "f", "date": "2020-03-02", "adjusted": 2.0, "src": 1}])
    run_refresh(spark, landing, SCHEMA, "stock_stream", root, **kw)
    assert [(r.symbol, r.adjusted) for r in spark.table("stock_stream").orderBy("symbol").collect()] == \
        [("f", 2.0), ("zm", 1.0)]
    land(landing, "b2.json", [{"symbol": "zm", "date": "2020-03-02", "adjusted": 3.0, "src": 1},
                              {"symbol": "zm", "date": "2020-03-03", "adjusted": 4.0, "src": 1},
                              {"symbol": "f", "date": "2020-03-03", "adjusted": -1.0, "src": 1}])
    run_refresh(spark, landing, SCHEMA, "stock_stream", root, **kw)
    got = [(r.symbol, str(r.date), r.adjusted) for r in spark.table("stock_stream").collect()]
    assert sorted(got) == [("f", "2020-03-02", 2.0), ("zm", "2020-03-02", 3.0), ("zm", "2020-03-03", 4.0)]
    # nothing new landed: a re-run changes nothing
    run_refresh(spark, landing, SCHEMA, "stock_stream", root, **kw)
    assert sorted((r.symbol, str(r.date), r.adjusted) for r in spark.table("stock_stream").collect()) == sorted(got)


def test_stream_append_distinct(spark, scratch):
    schema = T.StructType([T.StructField("headlines", T.StringType()), T.StructField("date", T.DateType()),
                           T.StructField("type", T.StringType())])
    landing = f"{scratch}/hl"
    spark.sql("DROP TABLE IF EXISTS headline_stream")
    land(landing, "d1.json", [{"headlines": "a", "date": "2020-03-01", "type": "t"}] * 2)
    run_refresh(spark, landing, schema, "headline_stream", f"{scratch}/tables", mode="append_distinct",
                checkpoint=f"{scratch}/ck2", partitioned=False)
    land(landing, "d2.json", [{"headlines": "a", "date": "2020-03-01", "type": "t"},
                              {"headlines": "b", "date": "2020-03-02", "type": "t"}])
    run_refresh(spark, landing, schema, "headline_stream", f"{scratch}/tables", mode="append_distinct",
                checkpoint=f"{scratch}/ck2", partitioned=False)
    assert rows(spark.table("headline_stream").select("headlines")) == [("a",), ("b",)]


def test_stream_into_partitioned_store(spark, scratch):
    landing, root = f"{scratch}/land3", f"{scratch}/tables3"
    kw = dict(mode="upsert", keys=["symbol", "date"], order=["src"], value="adjusted",
              checkpoint=f"{scratch}/ck3")
    land(landing, "b1.json", [{"symbol": "zm", "date": "2020-02-28", "adjusted": 1.0, "src": 1},
                              {"symbol": "zm", "date": "2020-03-02", "adjusted": 2.0, "src": 1}])
    run_refresh(spark, landing, SCHEMA, "px", root, **kw)
    land(landing, "b2.json", [{"symbol": "zm", "date": "2020-03-02", "adjusted": 5.0, "src": 1}])
    run_refresh(spark, landing, SCHEMA, "px", root, **kw)
    got = sorted((str(r.date), r.adjusted) for r in spark.read.parquet(f"{root}/px").collect())
    assert got == [("2020-02-28", 1.0), ("2020-03-02", 5.0)]


def test_stream_replace_dates_catalog_table(spark, scratch):
    schema = T.StructType([T.StructField("state", T.StringType()), T.StructField("date", T.DateType()),
                           T.StructField("positive", T.IntegerType())])
    landing = f"{scratch}/sd"
    spark.sql("DROP TABLE IF EXISTS state_stream")
    kw = dict(mode="replace_dates", keys=["state"], checkpoint=f"{scratch}/ck4", partitioned=False)
    land(landing, "d1.json", [{"state": "IL", "date": "2020-03-01", "positive": 1},
                              {"state": "IL", "date": "2020-03-02", "positive": 2}])
    run_refresh(spark, landing, schema, "state_stream", f"{scratch}/t4", **kw)
    land(landing, "d2.json", [{"state": "IL", "date": "2020-03-02", "positive": 20},
                              {"state": "IL", "date": "2020-03-03", "positive": 30}])
    run_refresh(spark, landing, schema, "state_stream", f"{scratch}/t4", **kw)
    got = sorted((str(r.date), r.positive) for r in spark.table("state_stream").collect())
    assert got == [("2020-03-01", 1), ("2020-03-02", 20), ("2020-03-03", 30)]


def test_replayed_batch_leaves_the_same_table(spark, scratch):
    from panelspark.streaming.refresh import _apply
    old = spark.createDataFrame([("zm", "2020-03-01", 1.0)], "symbol string, date string, adjusted double") \
        .selectExpr("symbol", "to_date(date) as date", "adjusted")
    batch = spark.createDataFrame([("zm", "2020-03-01", 2.0, 1), ("f", "2020-03-02", 3.0, 1)],
                                  "symbol string, date string, adjusted double, src int") \
        .selectExpr("symbol", "to_date(date) as date", "adjusted", "src")
    for mode in ("upsert", "replace_dates", "append_distinct"):
        b = batch if mode == "upsert" else batch.drop("src")
        keys = ["symbol", "date"] if mode == "upsert" else ["symbol"]
        once = _apply(mode, old, b, keys, ["src"], "date", "adjusted", 1)
        twice = _apply(mode, once, b, keys, ["src"], "date", "adjusted", 1)
        assert rows(once) == rows(twice), mode
