"""Composite jobs on hand-made fixtures (traps from the fixture notes)."""
import datetime as dt

from pyspark.sql import functions as F

from panelspark.functions.stopwords import ENGLISH_STOP_WORDS, spark_default_stop_words, stop_words_frame
from panelspark.plans import panel as P
from panelspark.plans import prices as PR
from panelspark.plans import refresh as RF
from panelspark.plans import reports as RP
from panelspark.plans import text as TX
from tests.conftest import rows

D = [dt.date(2020, 3, d) for d in range(1, 8)]


def ccdr(spark):
    data = [
        # Country A: two provinces; NULL measure first/middle/end; crosses 100 and drops back
        ("p1", " A\t", 1.0, 2.0, D[0], None, 0, None), ("p2", "A", 3.0, 4.0, D[0], 60, 0, 1),
        ("p1", "A", 1.0, 2.0, D[1], 50, 1, 2), ("p2", "A", 3.0, 4.0, D[1], 70, 2, 3),
        ("p1", "A", 1.0, 2.0, D[2], None, None, None), ("p2", "A", 3.0, 4.0, D[2], None, None, None),
        ("p1", "A", 1.0, 2.0, D[3], 40, 3, None), ("p2", "A", 3.0, 4.0, D[3], 50, 3, 5),
        # Country B: zero confirmed and zero deaths; missing Lat/Lng
        ("", "B", None, None, D[2], 0, 0, 0), ("", "B", None, None, D[3], 0, 0, None),
    ]
    return spark.createDataFrame(data, "state string, country string, Lat double, Lng double, "
                                       "date date, confirmed int, deaths int, recovered int")


def test_country_panel(spark):
    pop = spark.createDataFrame([("A", 2_000_000), ("B", None)], "country string, population long")
    panel = P.country_panel(ccdr(spark), population=pop)
    a = {r.date: r for r in panel.filter("country = 'A'").collect()}
    assert a[D[0]].confirmed == 60 and a[D[0]].new_confirmed == 60            # first keeps level
    assert a[D[2]].confirmed == 0 and a[D[2]].new_confirmed == -120           # all-missing -> 0
    assert [a[d].base_day for d in D[:4]] == [0, 1, 1, 1]                     # >=100 counted once
    assert a[D[1]].confirmed_per_mil == 60.0 and a[D[1]].population == 2.0
    assert a[D[3]].most_recent == 1 and a[D[0]].most_recent == 0
    assert a[D[1]].death_rate == 0.02                                         # 0.025 -> half-even
    b = panel.filter("country = 'B'").collect()
    assert all(r.death_rate is None for r in b) and all(r.population is None for r in b)
    latest = P.most_recent(panel, "new_confirmed", ["country"])
    assert [r.country for r in latest.collect()] == ["A", "B"]


def test_state_panel_first_rows_zero(spark):
    sd = spark.createDataFrame([(D[0], "IL", 100, 50, None, 1), (D[1], "IL", 150, 60, 5, 3),
                                (D[2], "IL", 180, 80, 6, 4), (D[0], "ZZ", 0, 0, 0, 0)],
                               "date date, state string, positive int, negative int, recovered int, death int")
    pop = spark.createDataFrame([("IL", 12_000_000)], "state string, population long")
    sp = {(r.state, r.date): r for r in P.state_panel(sd, population=pop).collect()}
    il0, il1, il2 = sp[("IL", D[0])], sp[("IL", D[1])], sp[("IL", D[2])]
    assert (il0.new_positive, il0.new_positive_change, il0.recovered) == (0, 0, 0)
    assert (il1.new_positive, il2.new_positive, il2.new_positive_change) == (50, 30, -20)
    assert il1.total_test_results == 210 and il2.new_total == 50 and il0.base_day == 1
    z = sp[("ZZ", D[0])]
    assert z.pos_pct is None and z.population is None and z.death_rate is None


def test_fill_locations(spark):
    out = P.fill_locations(ccdr(spark), ["state", "country", "Lat", "Lng"], "date",
                           ["confirmed", "deaths", "recovered"], trim=["country"])
    p1 = [r.confirmed for r in out.filter("state = 'p1'").orderBy("date").collect()]
    assert p1 == [0, 50, 50, 40]
    assert out.filter("confirmed is null or deaths is null or recovered is null").count() == 0


def test_index_and_returns(spark):
    px = [("x", D[0], 10.0, 100, 1), ("y", D[0], 20.0, 200, 1), ("z", D[0], 5.0, 1, 0),
          ("x", D[1], 11.0, 100, 1), ("y", D[1], 22.0, 2 ** 31, 1), ("z", D[1], None, 1, 0),
          ("z", D[2], 6.0, 1, 0), ("w", D[2], -1.0, 1, 0)]
    prices = spark.createDataFrame(px, "symbol string, date date, adjusted double, volume long, djia int")
    s = PR.index_series(prices, divisor=0.5)
    idx = {r.date: (r.adjusted, r.volume) for r in s.filter("symbol = 'djia'").collect()}
    assert idx[D[0]] == (60.0, 300) and idx[D[1]] == (66.0, 100 + 2 ** 31)   # no int overflow
    assert s.filter("symbol = 'w'").count() == 0
    spd = PR.returns_panel(s)
    z = [(r.obs, r.adjusted_change, round(r.cum_change, 12)) for r in spd.filter("symbol='z'").orderBy("date").collect()]
    assert z == [(1, 1.0, 0.0), (2, 1.2, 0.2)]
    bw = PR.best_worst(spd).first()
    assert (bw.best_symbol, bw.worst_symbol) == ("z", "djia") and abs(bw.index_change - 0.1) < 1e-12


def test_word_counts_and_stop_words(spark):
    assert spark_default_stop_words() == list(ENGLISH_STOP_WORDS)
    h = spark.createDataFrame([(D[0], "The <b>bold</b> virus: virus spreads https t.co trump", "topTweets"),
                               (D[5], "virus later", "topTweets")], "date date, headlines string, type string")
    tokens = TX.token_table(h, "headlines")
    wc = TX.word_counts(tokens, stop_words_frame(spark), date="date", lo=D[0], hi=D[1])
    # greedy span removal drops '<b>bold</b>'; fragments and stop words go
    assert rows(wc) == [("spreads", 1), ("virus", 2)]


def test_marked_items_markers(spark):
    pages = spark.createDataFrame([
        (1, "junk Top news stories on this day\r\nA first\r\n\r\nB second\r\nTrended on Twitter rest"),
        (2, "no markers at all"),
        (3, "X Top news stories on this day old Top news stories on this day\tnew one\r\nTrended on Twitter"),
    ], "page_id long, html string")
    out = TX.marked_items(pages, "html", "Top news stories on this day", "Trended on Twitter", "|",
                          crlf_as_delimiter=True, keep=["page_id"])
    got = rows(out)
    assert got == [(1, "A first"), (1, "B second"), (2, "no markers at all"), (3, "new one")]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("s", D[0], 1.0, 10), ("s", D[1], 2.0, 10)],
                                "symbol string, date date, adjusted double, volume long")
    batch = spark.createDataFrame([("s", D[1], 9.0, 11, 2), ("s", D[1], 8.0, 12, 1), ("s", D[2], 0.0, 1, 1),
                                   ("t", D[2], 5.0, 1, 1)],
                                  "symbol string, date date, adjusted double, volume long, src int")
    once = RF.upsert(old, batch, ["symbol", "date"], ["src"], value="adjusted")
    assert rows(once) == [("s", D[0], 1.0, 10), ("s", D[1], 8.0, 12), ("t", D[2], 5.0, 1)]
    twice = RF.upsert(once, batch, ["symbol", "date"], ["src"], value="adjusted")
    assert rows(twice) == rows(once)
    bad = spark.createDataFrame([(None, None, None, None, None)],
                                "symbol string, date date, adjusted double, volume long, src int")
    assert rows(RF.upsert(old, bad, ["symbol", "date"], ["src"])) == rows(old)   # guard keeps old


def test_replace_trailing_dates_keeps_missing_pairs(spark):
    old = spark.createDataFrame([("IL", D[0], 1), ("IL", D[1], 2), ("NY", D[1], 3)], "state string, date date, positive int")
    src = spark.createDataFrame([("IL", D[0], 100), ("IL", D[1], 20), ("IL", D[2], 30)], "state string, date date, positive int")
    got = rows(RF.replace_trailing_dates(old, src, ["state"], "date", overlap_days=1, late="window"))
    # watermark D1, re-read from D0: arrived pairs replaced, NY (not re-sent) kept
    assert got == [("IL", D[0], 100), ("IL", D[1], 20), ("IL", D[2], 30), ("NY", D[1], 3)]


def test_append_distinct_rerun_adds_nothing(spark):
    old = spark.createDataFrame([("h1", D[0], "t"), ("h1", D[0], "t")], "headlines string, date date, type string")
    src = spark.createDataFrame([("h1", D[0], "t"), ("h2", D[1], "t")], "headlines string, date date, type string")
    once = RF.append_new_days(old, src)
    assert rows(once) == [("h1", D[0], "t"), ("h2", D[1], "t")]
    assert rows(RF.append_new_days(once, src)) == rows(once)


def test_reports(spark):
    panel = P.country_panel(ccdr(spark), population=spark.createDataFrame(
        [("A", 2_000_000), ("B", 1_000_000)], "country string, population long"))
    latest = P.most_recent(panel, "new_confirmed", ["country"], sort=False)
    k = RP.kpi_boxes(latest, ["confirmed", "deaths", "recovered"],
                     ["new_confirmed", "new_deaths", "new_recovered"]).first()
    assert k.total_confirmed == 90 and k.total_deaths == 6 and k.pct_deaths == 6.7
    assert k.text_deaths == "6 (6.7%)" and k.per_mil_confirmed == 30.0
    curve = RP.daily_curve(panel, "date", {"CONFIRMED": "new_confirmed"}, per_capita=True)
    assert {r.date: r.value for r in curve.collect()}[D[0]] == 30.0
    assert RP.cumulative_curve(panel, "country", "date", "confirmed", "lines").columns == ["country", "base_day", "date", "confirmed"]
    assert RP.cumulative_curve(panel, "country", "date", "confirmed", "total").columns == ["date", "confirmed"]
    keys = RP.selected_keys(latest, "country", [F.desc("new_confirmed"), F.asc("country")], 1)
    assert {r.country for r in RP.select_history(panel, keys, "country").collect()} == {"A"}
    line = RP.latest_line(RP.daily_curve(panel, "date", {"CONFIRMED": "new_confirmed", "DEATHS": "new_deaths"}),
                          labels={"CONFIRMED": "Confirmed", "DEATHS": "Deaths"}).first()
    assert line.subtitle == "Yesterday: Confirmed = 90, Deaths = 6"
    pts = RP.latest_points(ccdr(spark).fillna(0, subset=["confirmed", "deaths"]), ["state", "country", "Lat", "Lng"],
                           "date", "state", "country", "confirmed", "deaths")
    b = pts.filter("country = 'B'").first()
    assert b.state == "State Not Given" and b.pct_died == 0.0
    assert b.popup == "<p>State Not Given, B</p></p>Confirmed: 0</p></p>Deaths: 0 (0%)</p>"
    ov = RP.overview_buckets(latest.select("country", "confirmed"), ["confirmed"]).collect()
    assert {r.confirmed_bucket for r in ov} == {0, 20}


def test_refresh_into_empty_store_takes_everything(spark):
    empty = spark.createDataFrame([], "state string, date date, positive int")
    src = spark.createDataFrame([("IL", D[0], 1), ("IL", D[0], 1)], "state string, date date, positive int")
    assert RF.append_new_days(empty, src).count() == 1
    assert RF.replace_trailing_dates(empty, src, ["state"], "date").count() == 2


def test_selected_keys_by_arbitrary_ranks(spark):
    latest = spark.createDataFrame([(c, float(v)) for c, v in zip("abcdef", [5, 9, 1, 7, 3, 8])],
                                   "country string, new_confirmed double")
    order = [F.desc("new_confirmed"), F.asc("country")]
    assert [r.country for r in RP.selected_keys(latest, "country", order, 2).collect()] == ["b", "f"]
    got = {r.country for r in RP.selected_keys(latest, "country", order, [2, 5]).collect()}
    assert got == {"f", "e"}


def test_partitioned_refresh_rewrites_only_touched_months(spark, scratch):
    import os
    path = f"{scratch}/store"
    jan = [("IL", dt.date(2020, 1, d), d) for d in (1, 2)]
    mar = [("IL", dt.date(2020, 3, d), 10 + d) for d in (1, 2)]
    first = spark.createDataFrame(jan + mar, "state string, date date, positive int")
    RF.refresh_partitioned(spark, path, first, "replace_dates", keys=["state"], staging_root=scratch)
    jan_files = sorted(os.listdir(f"{path}/month=2020-01-01"))
    batch = spark.createDataFrame([("IL", dt.date(2020, 3, 2), 99), ("IL", dt.date(2020, 3, 3), 100),
                                   ("IL", dt.date(2020, 1, 1), -1)], "state string, date date, positive int")
    RF.refresh_partitioned(spark, path, batch, "replace_dates", keys=["state"], staging_root=scratch, late="window")
    got = rows(spark.read.parquet(path).select("state", "date", "positive"))
    # watermark 3/2, re-read from 3/1: Jan (incl. the stale 1/1 row in the batch) untouched
    assert got == [("IL", dt.date(2020, 1, 1), 1), ("IL", dt.date(2020, 1, 2), 2),
                   ("IL", dt.date(2020, 3, 1), 11), ("IL", dt.date(2020, 3, 2), 99),
                   ("IL", dt.date(2020, 3, 3), 100)]
    assert sorted(os.listdir(f"{path}/month=2020-01-01")) == jan_files   # January not rewritten
    up = spark.createDataFrame([("IL", dt.date(2020, 1, 2), 7, 1)], "state string, date date, positive int, src int")
    RF.refresh_partitioned(spark, path, up, "upsert", keys=["state", "date"], order=["src"], staging_root=scratch)
    assert spark.read.parquet(path).filter("date = '2020-01-02'").first().positive == 7
    assert spark.read.parquet(path).count() == 5


def test_partitioned_replace_across_month_boundary(spark, scratch):
    path = f"{scratch}/store2"
    first = spark.createDataFrame([("IL", dt.date(2020, 2, 29), 1), ("IL", dt.date(2020, 3, 1), 2)],
                                  "state string, date date, positive int")
    RF.refresh_partitioned(spark, path, first, "replace_dates", keys=["state"], staging_root=scratch)
    batch = spark.createDataFrame([("IL", dt.date(2020, 2, 29), 10), ("IL", dt.date(2020, 3, 1), 20)],
                                  "state string, date date, positive int")
    RF.refresh_partitioned(spark, path, batch, "replace_dates", keys=["state"], staging_root=scratch)
    assert rows(spark.read.parquet(path).select("date", "positive")) == [
        (dt.date(2020, 2, 29), 10), (dt.date(2020, 3, 1), 20)]


def test_headline_lists_three_sections(spark):
    page = ("menu Most liked, retweeted and popular Tweets\tMarch 5, 2020 tweet one\n"
            "March 5, 2020 tweet two What happened on March 5 ... Top news stories on this day\r\n"
            "Story A\r\n\r\nStory B\r\nTrended on Twitter, the Internet and Social Media on March 5, 2020\r\n"
            "Tag1\r\nTag2\r\nMajor Sports events tail")
    pages = spark.createDataFrame([(D[4], page), (D[5], "nothing here")], "date date, text string")
    got = rows(TX.headline_lists(pages).select("type", "headlines"))
    assert ("topTweets", " tweet one") in got and ("topTweets", " tweet two ") in got
    assert ("topNewsHeadlines", "Story A") in got and ("topNewsHeadlines", "Story B") in got
    assert ("topTrendingOnSm", "Tag1") in got and ("topTrendingOnSm", "Tag2") in got
    # a page without markers keeps its whole text in each list (markers absent = uncut)
    assert sum(1 for r in got if r[1] == "nothing here") == 3


def test_partitioned_refresh_rejects_duplicate_keys(spark, scratch):
    import pytest
    path = f"{scratch}/store3"
    first = spark.createDataFrame([("IL", dt.date(2020, 3, 1), 1)], "state string, date date, positive int")
    RF.refresh_partitioned(spark, path, first, "replace_dates", keys=["state"], staging_root=scratch)
    dup = spark.createDataFrame([("IL", dt.date(2020, 3, 2), 1), ("IL", dt.date(2020, 3, 2), 2)],
                                "state string, date date, positive int")
    with pytest.raises(ValueError):
        RF.refresh_partitioned(spark, path, dup, "replace_dates", keys=["state"], staging_root=scratch)
    assert rows(spark.read.parquet(path).select("state", "positive")) == [("IL", 1)]


def test_partitioned_upsert_needs_date_key_and_keeps_stored_order_columns(spark, scratch):
    import pytest
    path = f"{scratch}/store4"
    b = spark.createDataFrame([("s", dt.date(2020, 3, 1), 1.0)], "symbol string, date date, adjusted double")
    with pytest.raises(ValueError):
        RF.refresh_partitioned(spark, path, b, "upsert", keys=["symbol"], order=["adjusted"],
                               staging_root=scratch)
    # ordering by the date column (also stored) keeps it in the store
    RF.refresh_partitioned(spark, path, b, "append_distinct", order=["date"], staging_root=scratch)
    assert "date" in spark.read.parquet(path).columns


def test_partitioned_upsert_can_empty_a_month(spark, scratch):
    path = f"{scratch}/store5"
    first = spark.createDataFrame([("s", dt.date(2020, 2, 3), 1.0, 1), ("s", dt.date(2020, 3, 3), 2.0, 1)],
                                  "symbol string, date date, adjusted double, src int")
    RF.refresh_partitioned(spark, path, first, "upsert", keys=["symbol", "date"], order=["src"],
                           value="adjusted", staging_root=scratch)
    kill = spark.createDataFrame([("s", dt.date(2020, 2, 3), -1.0, 1), ("s", dt.date(2020, 3, 4), 5.0, 1)],
                                 "symbol string, date date, adjusted double, src int")
    RF.refresh_partitioned(spark, path, kill, "upsert", keys=["symbol", "date"], order=["src"],
                           value="adjusted", staging_root=scratch)
    got = rows(spark.read.parquet(path).select("date", "adjusted"))
    assert got == [(dt.date(2020, 3, 3), 2.0), (dt.date(2020, 3, 4), 5.0)]
    assert spark.read.parquet(path).filter("month = '2020-02-01'").count() == 0


def test_upsert_rejected_batch_keeps_nonpositive_rows(spark):
    old = spark.createDataFrame([("s", D[0], 0.0, 1)], "symbol string, date date, adjusted double, volume long")
    bad = spark.createDataFrame([(None, None, None, None, None)],
                                "symbol string, date date, adjusted double, volume long, src int")
    assert rows(RF.upsert(old, bad, ["symbol", "date"], ["src"], value="adjusted")) == rows(old)


def test_append_without_new_rows_keeps_duplicates(spark):
    old = spark.createDataFrame([("h", D[0], "t"), ("h", D[0], "t")], "headlines string, date date, type string")
    src = spark.createDataFrame([("h", D[0], "t")], "headlines string, date date, type string")
    assert RF.append_new_days(old, src, late="window").count() == 2


def test_dotted_header_dates(spark, scratch):
    import os
    from panelspark.sources.csv import country_series
    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/x.csv", "w") as f:
        f.write("Province/State,Country/Region,Lat,Long,X1.22.20,X1.23.20\n,US,1,2,3,4\n")
    got = rows(country_series(spark, {"confirmed": f"{scratch}/x.csv"}).select("date", "confirmed"))
    assert got == [(dt.date(2020, 1, 22), 3), (dt.date(2020, 1, 23), 4)]


def test_partitioned_upsert_emptying_the_only_touched_month(spark, scratch):
    path = f"{scratch}/store6"
    first = spark.createDataFrame([("s", dt.date(2020, 2, 3), 1.0, 1)], "symbol string, date date, adjusted double, src int")
    RF.refresh_partitioned(spark, path, first, "upsert", keys=["symbol", "date"], order=["src"],
                           value="adjusted", staging_root=scratch)
    RF.refresh_partitioned(spark, path, spark.createDataFrame([("s", dt.date(2020, 2, 3), -5.0, 1)],
                                                              "symbol string, date date, adjusted double, src int"),
                           "upsert", keys=["symbol", "date"], order=["src"], value="adjusted", staging_root=scratch)
    assert spark.read.parquet(path).count() == 0


def test_refresh_jobs_from_landed_inputs(spark, scratch):
    """K3-K6 from files to the stored table, late rows included."""
    import json
    import os

    from panelspark.plans import ingest
    st = lambda name: f"{scratch}/{name}"

    def land(name, text):
        os.makedirs(os.path.dirname(st(name)), exist_ok=True)
        with open(st(name), "w", encoding="utf-8") as f:
            f.write(text)
        return st(name)

    row = lambda d, s, p: {"date": d, "state": s, "positive": p}
    a = land("js/a.json", json.dumps([row(20200110, "NY", 5), row(20200115, "NY", "7.0")]))
    b = land("js/b.json", json.dumps([row(20200110, "NY", 6), row(20200116, "NY", 9)]))
    ingest.refresh_states(spark, a, st("states"), st("stage"))
    got = ingest.refresh_states(spark, b, st("states"), st("stage"))
    assert sorted((r.date.day, r.positive) for r in got.collect()) == [(10, 6), (15, 7), (16, 9)]

    members = spark.createDataFrame([("AA",)], "symbol string")
    head = "symbol,date,open,high,low,close,volume,adjusted\n"
    p1 = land("px/1.csv", head + "AA,2020-03-02,1,1,1,1,10,5\nZM,2020-03-02,1,1,1,1,10,8\n")
    p2 = land("px/2.csv", head + "AA,2020-03-02,1,1,1,1,10,6\nAA,2020-03-02,1,1,1,2,10,7\nAA,2020-03-03,1,1,1,1,1,0\n")
    empty = land("px/3.csv", head)
    ingest.refresh_prices(spark, p1, members, st("prices"), st("stage"))
    ingest.refresh_prices(spark, p2, members, st("prices"), st("stage"))
    got = ingest.refresh_prices(spark, empty, members, st("prices"), st("stage"))
    assert sorted((r.symbol, r.date.day, r.adjusted, r.djia) for r in got.collect()) == [("AA", 2, 6.0, 1), ("ZM", 2, 8.0, 0)]

    from panelspark.plans.text import HEADLINE_SECTIONS
    (_, n_start, n_end) = HEADLINE_SECTIONS[1]
    page = lambda d, t: (dt.date(2020, 4, d), f"{n_start}\r\n{t}\r\n{n_end}")
    pages = lambda *p: spark.createDataFrame(list(p), "date date, text string")
    news = lambda df: sorted((r.date.day, r.headlines) for r in df.where("type = 'topNewsHeadlines'").collect())
    ingest.refresh_headlines(spark, pages(page(5, "one")), st("heads"), st("stage"))
    got = ingest.refresh_headlines(spark, pages(page(5, "one"), page(5, "two"), page(3, "late")), st("heads"), st("stage"))
    assert news(got) == [(3, "late"), (5, "one"), (5, "two")]


def test_late_rows_are_listed(spark):
    old = spark.createDataFrame([(dt.date(2020, 1, 9), 1)], "date date, n int")
    src = spark.createDataFrame([(dt.date(2020, 1, d), d) for d in (5, 8, 9)], "date date, n int")
    assert [r.n for r in RF.late_rows(old, src).collect()] == [5]
    assert RF.append_new_days(old, src, late="keep").count() == 4
