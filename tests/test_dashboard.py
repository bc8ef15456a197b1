"""Dashboard build + views on small fixtures; K2 population ingest."""
import datetime as dt

from panelspark.plans import dashboard as DB
from panelspark.plans.ingest import country_population

D = [dt.date(2020, 3, d) for d in range(1, 6)]


def fixtures(spark):
    ccdr = spark.createDataFrame(
        [(s, c, lat, lng, d, conf + i * 60, i, None if i == 2 else i * 2)
         for (s, c, lat, lng, conf) in [("", "US", 1.0, 2.0, 50), ("Ontario", "Canada", None, None, 10),
                                        ("", "Chad", 3.0, 4.0, 0)]
         for i, d in enumerate(D)],
        "state string, country string, Lat double, Lng double, date date, confirmed int, deaths int, recovered int")
    state = spark.createDataFrame([(d, s, 100 * (i + 1), 50, None, i) for s in ("IL", "NY") for i, d in enumerate(D)],
                                  "date date, state string, positive int, negative int, recovered int, death int")
    stocks = spark.createDataFrame(
        [(sym, d, 10.0 + i + k, 100, member) for k, (sym, member) in enumerate([("aapl", 1), ("msft", 1), ("zm", 0)])
         for i, d in enumerate(D)], "symbol string, date date, adjusted double, volume long, djia int")
    heads = spark.createDataFrame([("Virus spreads fast", D[1], "topTweets"), ("Markets fall <i>x</i>", D[3], "topNewsHeadlines")],
                                  "headlines string, date date, type string")
    cpop = spark.createDataFrame([("US", 331_000_000.0), ("Canada", 38_000_000.0), ("Chad", None)],
                                 "country string, population double")
    spop = spark.createDataFrame([("IL", 12_600_000), ("NY", 19_400_000)], "state string, Pop long")
    return ccdr, state, stocks, heads, cpop, spop


def test_build_and_views(spark, scratch):
    tables = DB.build_tables(spark, *fixtures(spark), root=scratch)
    assert set(tables) == {"country_summary", "locations", "state_summary", "prices", "returns", "headline_tokens"}
    assert "panels/country_summary" in tables["country_summary"].inputFiles()[0]
    cv = DB.country_view(tables, selected=["US", "Canada"])
    k = cv["kpis"].first()
    assert k.total_confirmed == (50 + 240) + (10 + 240)
    assert set(cv["cumulative_curve"].columns) == {"country", "base_day", "date", "confirmed"}
    assert cv["map_points"].filter("state = 'State Not Given'").count() == 1
    assert cv["table"].count() == 3
    sv = DB.state_view(tables, per_capita=True)
    assert sv["kpis"].first().total_positive == 1000
    mv = DB.market_view(tables, ["djia", "zm"], lo=D[1], hi=D[4])
    bw = mv["best_worst"].first()
    assert bw.best_symbol is not None and bw.index_change is not None
    assert {r.word for r in mv["word_counts"].collect()} == {"virus", "spreads", "fast", "markets", "fall"}
    assert mv["cases_prices"].count() == 4
    assert mv["correlation"].count() == 3   # positive, djia, zm -> 3 pairs


def test_summary_report(spark, scratch):
    tables = DB.build_tables(spark, *fixtures(spark), root=scratch)
    rep = DB.summary_report(tables, selected=["US"])
    assert rep["table"].count() == 1
    line = rep["yesterday"].first().subtitle
    assert line.startswith("Yesterday: Confirmed = 60, Deaths = 1, Recovered = ")
    assert {r.country for r in rep["cumulative_curve"].collect()} == {"US"}


def test_country_population_from_html(spark):
    html = ("<table><tr><th>#</th><th>Country</th><th>Population</th><th>Yearly</th><th>Net</th><th>Density</th>"
            "<th>Land</th><th>Migrants</th><th>Fert</th><th>Age</th><th>Urban</th><th>Share</th></tr>"
            "<tr><td>1</td><td>United States</td><td>331,002,651</td><td>0.59 %</td><td>1,937,734</td><td>36</td>"
            "<td>9,147,420</td><td>954,806</td><td>1.8</td><td>38</td><td>83 %</td><td>4.25 %</td></tr>"
            "<tr><td>2</td><td>Holy See</td><td>801</td><td>0.25 %</td><td>2</td><td>2,003</td><td>0</td>"
            "<td>N.A.</td><td>N.A.</td><td>N.A.</td><td>N.A.</td><td>0 %</td></tr></table>")
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    cp = {r.country: r for r in country_population(pages).collect()}
    assert cp["US"].population == 331002651.0 and cp["US"].yearlyChangePct == 0.59
    assert cp["Holy See"].netMigrants is None and cp["Holy See"].urbanPopPct is None
