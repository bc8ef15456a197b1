"""Tables of manifests: crashes, conflicts, typed read-back, and upserts that
leave other files alone; load figures from the write itself."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.plans import refresh as RF
from panelspark.sources import manifest as M
from panelspark.sources import tables as TB

SCHEMA = "k int, d date, v double, n bigint"


def table(spark, ks, v=1.0):
    return spark.createDataFrame([(k, dt.date(2020, 1, 1) + dt.timedelta(days=k % 9), float(v), k) for k in ks], SCHEMA)


def content(df):
    return sorted(map(tuple, df.collect()))


def paths(spark, m):
    return {r.path for r in spark.read.parquet(m.files).collect()}


def test_replace_and_read(spark, scratch):
    root = f"{scratch}/t"
    assert M.current(spark, root) is None
    one = M.replace(spark, table(spark, range(50)), root, ["k"], zones=4)
    two = M.replace(spark, table(spark, range(5), 2.0).withColumn("w", F.lit("new")), root, ["k"])
    assert (one.version, one.rows, two.version, two.rows) == (1, 50, 2, 5)
    assert M.read(spark, root).columns == ["k", "d", "v", "n", "w"]  # the schema changed with its version
    assert content(M.read(spark, root, one)) == content(table(spark, range(50)))
    M.replace(spark, table(spark, []), root, ["k"])
    assert M.read(spark, root).count() == 0 and M.read(spark, root).columns == ["k", "d", "v", "n"]


def test_a_crash_between_any_two_steps_keeps_the_version(spark, scratch, monkeypatch):
    root = f"{scratch}/t"
    M.replace(spark, table(spark, range(20)), root, ["k"], zones=3)
    before = content(M.read(spark, root))

    def broken(*a, **k):
        raise OSError("gone")
    for step in ("_written", "_check", "_indexed", "_kept", "commit"):
        with monkeypatch.context() as patch:
            patch.setattr(M, step, broken)
            with pytest.raises(OSError):
                M.replace(spark, table(spark, range(3), 9.0), root, ["k"])
            if step != "_check":
                with pytest.raises(OSError):
                    M.upsert(spark, root, table(spark, [3, 77], 5.0), ["n"])
        assert content(M.read(spark, root)) == before
    # a manifest that was cut off is no version, and its number is not used again
    p, fs = M._path(spark, f"{root}/manifests/v{9:020d}.json")
    out = fs.create(p, False)
    out.write(bytearray(b'{"version": 9, "sch'))
    out.close()
    assert content(M.read(spark, root)) == before
    assert M.replace(spark, table(spark, [1]), root, ["k"]).version == 10


def test_two_writers_cannot_both_win(spark, scratch):
    root = f"{scratch}/t"
    m = M.replace(spark, table(spark, [1]), root, ["k"])
    with pytest.raises(M.Conflict):
        M.commit(spark, root, m)
    assert M.current(spark, root) == m


def test_keys_and_types_are_checked(spark, scratch):
    root = f"{scratch}/t"
    for bad in (table(spark, [1, 1]), table(spark, [2]).withColumn("k", F.lit(None).cast("int"))):
        with pytest.raises(ValueError):
            M.replace(spark, bad, root, ["k"])
    assert M.current(spark, root) is None
    TB.replace_table(spark, table(spark, [1, 2]), "typed_back", f"{scratch}/tables")
    assert TB.read_back_check(spark, "typed_back", table(spark, [1, 2]))["schema_ok"]
    assert not TB.read_back_check(spark, "typed_back", table(spark, [1, 2]).withColumn("n", F.col("n").cast("int")))["schema_ok"]
    spark.sql("DROP TABLE typed_back")


def test_an_upsert_leaves_other_files_unread_and_unwritten(spark, scratch, monkeypatch):
    root = f"{scratch}/t"
    old = M.replace(spark, table(spark, range(0, 400, 2)), root, ["k"], zones=8)
    read = []
    files = M.read_files
    monkeypatch.setattr(M, "read_files", lambda s, m, p: read.append(list(p)) or files(s, m, p))
    new = M.upsert(spark, root, table(spark, [10, 11], 5.0), ["n"])
    assert len(read[0]) == 1 and len(paths(spark, old)) == 8
    assert len(paths(spark, old) & paths(spark, new)) == 7 and read[0][0] not in paths(spark, new)
    want = {k: 1.0 for k in range(0, 400, 2)} | {10: 5.0, 11: 5.0}
    assert {r.k: r.v for r in M.read(spark, root).collect()} == want and new.rows == 201
    # keys that no file can hold: nothing is read, all files stay
    read.clear()
    last = M.upsert(spark, root, table(spark, [-5, 399, 1001], 7.0), ["n"])
    assert sum(map(len, read)) <= 1 and len(paths(spark, last) & paths(spark, new)) >= 7
    M.upsert(spark, root, table(spark, [-5, 1001, 3], 8.0), ["n"])  # found again in their zones
    want |= {399: 7.0, -5: 8.0, 1001: 8.0, 3: 8.0}
    assert {r.k: r.v for r in M.read(spark, root).collect()} == want


def test_upserts_equal_the_whole_table_form(spark, scratch):
    root = f"{scratch}/t"
    old = table(spark, range(60))
    M.replace(spark, old, root, ["d", "k"], zones=5)
    batch = table(spark, [5, 5, 61, 20], 3.0).unionByName(table(spark, [7, 8], -1.0))
    want = content(RF.upsert(old, batch, ["d", "k"], ["n"], value="v"))
    M.upsert(spark, root, batch, ["n"], value="v")
    assert content(M.read(spark, root)) == want
    holes = batch.withColumns({"v": F.lit(None).cast("double")})
    m = M.upsert(spark, root, holes, ["n"])  # the guard rejects it
    assert content(M.read(spark, root)) == want and m == M.current(spark, root)


def test_load_figures_come_from_the_write(spark, scratch):
    df = table(spark, range(30)).withColumn("v", F.when(F.col("k") % 3 != 0, F.col("v")))
    figures = TB.write_observed(df, f"{scratch}/w", "d")
    assert figures == {"rows": 30, "max_date": dt.date(2020, 1, 9), "missing_cells": 10}
    log = TB.log_load(spark, f"{scratch}/log", "t", figures, now=dt.datetime(2021, 1, 1))
    assert log.select("table", "rows", "max_date").first() == ("t", 30, dt.date(2020, 1, 9))
    assert TB.write_observed(df.where("k < 0"), f"{scratch}/e", "d") == {"rows": 0, "max_date": None, "missing_cells": 0}
    counted, seen = TB.observed(df, "d")
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    counted.write.parquet(f"{scratch}/once")
    assert TB.load_figures(seen)["rows"] == 30
