"""Sources and sinks on small landed files written to a temp folder."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from panelspark.sources import csv as C
from panelspark.sources import html as H
from panelspark.sources import json as J
from panelspark.sources import tables as TB
from tests.conftest import rows


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_wide_csv_files_to_long(spark, scratch):
    hdr = "Province/State,Country/Region,Lat,Long,1/22/20,1/23/20\n"
    write(f"{scratch}/c.csv", hdr + ",  US\t,1.5,2.5,1,3\nOntario,Canada,,,0,\nQuebec,Canada,4,5,2,4\n")
    write(f"{scratch}/d.csv", hdr + ",US,1.5,2.5,0,1\nOntario,Canada,,,0,0\n")
    write(f"{scratch}/r.csv", "Province/State,Country/Region,Lat,Long,1/22/2020,1/23/2020\n"
                              ",US,1.5,2.5,0,2\n,Canada,,,9,9\n")
    out = C.country_series(spark, {"confirmed": f"{scratch}/c.csv", "deaths": f"{scratch}/d.csv",
                                   "recovered": f"{scratch}/r.csv"})
    got = rows(out)
    d1, d2 = dt.date(2020, 1, 22), dt.date(2020, 1, 23)
    assert ("", "US", 1.5, 2.5, d1, 1, 0, 0) in got and ("", "US", 1.5, 2.5, d2, 3, 1, 2) in got
    # missing Lat/Lng match each other; the coarse Canada row of the third file is not added
    assert ("Ontario", "Canada", None, None, d2, None, 0, None) in got
    assert ("Quebec", "Canada", 4.0, 5.0, d1, 2, None, None) in got
    assert len(got) == 6


def test_state_population_csv(spark, scratch):
    write(f"{scratch}/sp.csv", "stateLong,state,Pop,Growth,Pop2018,Pop2010,growthSince2010,Percent,density\n"
                               "Avalonia,AV,1234567,0.0100,1220000,1100000,0.1223,0.0040,51.0\n"
                               "East Borduria,EB,765432,-0.0200,780000,800000,-0.0432,0.0025,12.5\n")
    df = C.read_state_population(spark, f"{scratch}/sp.csv")
    assert rows(df.select("state", "Pop")) == [("AV", 1234567), ("EB", 765432)]
    assert TB.duplicate_keys(df, ["state"]).count() == 0


def test_prices_and_symbols(spark, scratch):
    write(f"{scratch}/px/a.csv", "symbol,date,open,high,low,close,volume,adjusted\n"
                                 "aapl,2020-03-02,1,1,1,1,100,1.5\nzm,2020-03-02,1,1,1,1,5,2.5\n"
                                 "zm,2020-02-01,1,1,1,1,5,2.0\n")
    members = spark.createDataFrame([("aapl",)], "symbol string")
    px = C.read_prices(spark, f"{scratch}/px", members, start=dt.date(2020, 3, 1))
    assert rows(px.select("symbol", "djia", "ticker")) == [("aapl", 1, "aapl"), ("zm", 0, "zm")]
    syms = C.symbol_list(members, spark.createDataFrame([("zm",), ("aapl",)], "symbol string"))
    assert rows(syms) == [("aapl",), ("zm",)]


def test_json_fields_and_arrays(spark, scratch):
    df = spark.createDataFrame([(1, '{"date": 20200301, "state": "IL", "positive": 5, "extra": 1}'),
                                (2, '{"state": "NY"}'), (3, "not json")], "id int, js string")
    out = J.json_fields(df, "js", "date long, state string, positive int, death int")
    assert rows(out) == [(1, 20200301, "IL", 5, None), (2, None, "NY", None, None), (3, None, None, None, None)]
    arr = spark.createDataFrame([('[{"state":"IL","name":"Illinois","fips":"17","x":1},'
                                  '{"state":"AK","name":"Alaska","fips":"02"}]',)], "js string")
    md = J.json_array_rows(arr, "js", "state string, name string, fips string")
    assert rows(md.orderBy("fips")) == [("AK", "Alaska", "02"), ("IL", "Illinois", "17")]
    write(f"{scratch}/j/a.json", '[{"state":"IL","positive":1},{"state":"NY"}]')
    assert J.read_json_files(spark, f"{scratch}/j", "state string, positive int").count() == 2


def test_html_tables_and_node_text(spark):
    page = ("<html><body><table><tr><th>#</th><th>Country</th><th>Population</th></tr>"
            "<tr><td>1</td><td>China</td><td>1,439,323,776</td></tr>"
            "<tr><td>2</td><td>India</td><td>N.A.</td></tr></table>"
            "<table><tr><td>ignored</td></tr></table><p>Top &amp; news</p></body></html>")
    pages = spark.createDataFrame([(7, "u", page)], "page_id long, url string, html string")
    t = H.html_tables(pages)
    assert t.filter("table_no = 1").count() == 1
    first = H.first_table(t, ["country", "population"])
    assert rows(first.select("country", "population")) == [("China", "1,439,323,776"), ("India", "N.A.")]
    assert H.node_text(pages, "p").first().text == "Top & news"


def test_replace_table_versions_and_key_check(spark, scratch):
    TB.create_database(spark, "panel_test_db")
    df = spark.createDataFrame([("2020-03-01", "IL", 5, 1, None, 0), ("2020-03-01", None, 1, 1, 1, 1)],
                               "date string, state string, positive long, negative long, recovered long, death long")
    v1 = TB.replace_table(spark, df, "state_data", scratch, TB.STATE_SCHEMA, TB.STATE_KEY, text_keys=["state"])
    back = TB.read_table(spark, "state_data")
    assert dict((f.name, f.dataType.simpleString()) for f in back.schema)["positive"] == "int"
    assert rows(back.select("state")) == [("",), ("IL",)]
    check = TB.read_back_check(spark, "state_data", TB.conform(df, TB.STATE_SCHEMA))
    assert check == {"schema_ok": True, "rows": 2, "expected_rows": 2}
    # replacing from the table itself works (new version, then swap)
    v2 = TB.replace_table(spark, back.filter("state = 'IL'"), "state_data", scratch, TB.STATE_SCHEMA, TB.STATE_KEY)
    assert v2 != v1 and spark.table("state_data").count() == 1
    dup = spark.createDataFrame([("2020-03-01", "IL", 1, 1, 1, 1)] * 2,
                                "date string, state string, positive long, negative long, recovered long, death long")
    with pytest.raises(ValueError):
        TB.replace_table(spark, dup, "state_data", scratch, TB.STATE_SCHEMA, TB.STATE_KEY)
    assert spark.table("state_data").count() == 1   # failed replace leaves the current version


def test_load_log_and_literal_table(spark, scratch):
    lit = TB.literal_table(spark, [("cc", "confirmed"), ("cd", "deaths")], "df_name string, value_col string")
    assert rows(lit) == [("cc", "confirmed"), ("cd", "deaths")]
    d = spark.createDataFrame([(dt.date(2021, 2, 22),), (dt.date(2021, 2, 23),)], "date date")
    log = TB.log_load(spark, f"{scratch}/log", "stateData", d, now=dt.datetime(2021, 2, 23, 0, 1, 37))
    r = log.first()
    assert (r.table, r.rows, r.max_date) == ("stateData", 2, dt.date(2021, 2, 23))


def test_compressed_roundtrip(spark, scratch):
    df = spark.createDataFrame([("2020-03-01", 1)], "date string, x int")
    TB.write_compressed(df, f"{scratch}/rds")
    back = TB.read_table(spark, f"{scratch}/rds")
    assert back.first().date == dt.date(2020, 3, 1)


def test_read_tables_list(spark, scratch):
    spark.createDataFrame([("2020-03-01", 1)], "date string, x int").write.parquet(f"{scratch}/a")
    spark.createDataFrame([(5,)], "y int").write.parquet(f"{scratch}/b")
    got = TB.read_tables(spark, {"a": f"{scratch}/a", "b": f"{scratch}/b"})
    assert got["a"].first().date == dt.date(2020, 3, 1) and got["b"].first().y == 5


def test_first_table_short_rows_are_null(spark):
    page = ("<table><tr><th>#</th><th>Country</th><th>Population</th></tr>"
            "<tr><td>1</td><td>Chad</td><td>16,425,864</td></tr><tr><td>Total</td></tr></table>")
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    got = rows(H.first_table(H.html_tables(pages), ["country", "population"]).select("country", "population"))
    assert got == [("Chad", "16,425,864"), (None, None)]


def test_html_tables_with_omitted_end_tags(spark):
    from panelspark.sources.html import html_tables, node_text
    html = "<table><thead><tr><th>#<th>Name<tbody><tr><td>1<td>A <b>x</b><tr><td>2<td>B</table><p>t<footer>open text"
    pages = spark.createDataFrame([("k1", html)], "page_id string, html string")
    got = sorted((r.page_id, r.row_no, r.cells) for r in html_tables(pages).collect())
    assert got == [("k1", 0, ["#", "Name"]), ("k1", 1, ["1", "A x"]), ("k1", 2, ["2", "B"])]
    assert [tuple(r) for r in node_text(pages, "footer").collect()] == [("k1", 0, "open text")]
    nested = "<table><tr><td>a<table><tr><td>in</table><td>b"
    assert [r.cells for r in html_tables(pages.selectExpr("page_id", f"'{nested}' html")).collect()][0][-1] == "b"


def test_typed_cells_fit_or_fail(spark):
    import pytest
    from panelspark.functions.semantics import money_sum
    from panelspark.sources.csv import wide_file_to_long
    from panelspark.sources.tables import conform
    from pyspark.sql import types as T
    wide = spark.createDataFrame([("", "A", "1", "2", "12.0", "N.A.")],
                                 ["Province/State", "Country/Region", "Lat", "Long", "1/22/20", "1/23/20"])
    assert sorted((str(r.date), r.n) for r in wide_file_to_long(wide, "n").collect()) == [
        ("2020-01-22", 12), ("2020-01-23", None)]
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    assert conform(spark.createDataFrame([("7",), ("x",), (None,)], "n string"), schema).where("n is null").count() == 2
    for cell in ("3000000000", "12.5"):
        with pytest.raises(Exception, match="does not fit int"):
            conform(spark.createDataFrame([(cell,)], "n string"), schema).collect()
    small = spark.createDataFrame([(0.004,)] * 3, "x double")
    assert small.agg(money_sum("x").alias("s")).first().s == 0.012


def test_wide_files_with_headers_of_their_own(spark, scratch):
    head = "Province/State,Country/Region,Lat,Long"
    files = {"g0": [f"{head},1/22/20,1/23/20", ",US,1.5,2,3,4", '"A, ""b""",Italy ,,,5,'],
             "g1": [f"{head},1/22/2020,1/23/20,X1.24.20,note", ",US,1.5,2,3,4,9,x", ",Short,0,0,1", ",Long,0,0,1,2,3,y,8,9", ""],
             "g2": [",No header,0,0,1"]}
    for name, lines in files.items():
        spark.createDataFrame([("\r\n".join(lines),)], "v string").coalesce(1).write.text(f"{scratch}/{name}")
    lines = C.read_wide_lines(spark, [f"{scratch}/{n}" for n in files])
    parsed = C.wide_lines(lines.withColumn("file", F.regexp_extract("file", "/(g[0-9])/", 1)))
    report = {(r.file, r.kind): r.n for r in C.line_report(parsed).collect()}
    assert report == {("g1", "short"): 1, ("g1", "long"): 1, ("g2", "no header"): 1}
    got = {(r.state, r.country, str(r.date)): r.n for r in C.wide_cells(parsed.where("file = 'g1'"), "n").collect()}
    assert got[("", "US", "2020-01-24")] == 9 and len(got) == 9  # 'note' is no date
    assert got[("", "Short", "2020-01-22")] == 1 and got[("", "Short", "2020-01-24")] is None
    first = C.wide_cells(parsed.where("file = 'g0'"), "n")
    assert {(r.state, r.country, r.Lat, str(r.date), r.n) for r in first.collect()} == {
        ("", "US", 1.5, "2020-01-22", 3), ("", "US", 1.5, "2020-01-23", 4),
        ('A, "b"', "Italy", None, "2020-01-22", 5), ('A, "b"', "Italy", None, "2020-01-23", None)}


def test_line_form_equals_the_per_file_form(spark, scratch):
    head = "Province/State,Country/Region,Lat,Long"
    text = [f"{head},1/22/20,1/23/20", ",US,1.5,2,3,4", "P,Italy,,,5,", ",Peru,7,8,12.0,"]
    spark.createDataFrame([("\n".join(text),)], "v string").coalesce(1).write.text(f"{scratch}/w")
    whole = C.wide_file_to_long(C.read_wide(spark, f"{scratch}/w"), "n")
    lines = C.wide_cells(C.wide_lines(C.read_wide_lines(spark, f"{scratch}/w")), "n")
    key = lambda r: str(tuple(r))
    assert sorted(whole.collect(), key=key) == sorted(lines.select(whole.columns).collect(), key=key)
