"""The operators applied to the driver's tables (events, orders, lineitem,
customer, nation, region, documents, pages).

Substitution used throughout (see README):
  entity      event_type / user_id (events), o_orderpriority (orders)
  date        calendar day of events.ts, month or day of orders.o_orderdate
  levels      running totals of per-day event counts
  population  distinct users (or customers) per entity
  prices      average order price per priority and day
  text        documents.text; HTML = pages.html

Every function takes (spark, sf_dir) and returns a lazy DataFrame over the
whole tables.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.dates import (
    compact_text, day_number_to_date, long_label, month_name, parse_ymd,
)
from panelspark.functions.names import map_names
from panelspark.functions.semantics import flag, money_sum, rround, to_number, trim_ws
from panelspark.functions.text import strip_tags
from panelspark.functions.stopwords import stop_words_frame
from panelspark.operators.aggregate import rollup_sum0
from panelspark.operators.joins import missing_days, null_safe_join
from panelspark.operators.reshape import columns_to_long, long_to_wide, wide_to_long
from panelspark.operators.select import (
    between_dates, clean_columns, columns_matching, columns_present, complete_rows, drop_positions,
    rename_all, rows_at_max, sort_desc_last, top_n, with_stages,
)
from panelspark.operators.ranking import row_numbers, rows_at_ranks
from panelspark.operators.scan import gap_fill_rows, last_value, previous_value, running_count, running_state
from panelspark.operators.setops import union_by_name
from panelspark.operators.stats import correlation_long
from panelspark.operators.window import latest_rows
from panelspark.plans import panel as P
from panelspark.plans import prices as PR
from panelspark.plans import refresh as RF
from panelspark.plans import reports as RP
from panelspark.plans import text as TX
from panelspark.plans.rollups import add_counts, add_moments, stored_correlation, word_counts_between
from panelspark.operators.aggregate import sum_max_by
from panelspark.sources.html import node_text
from panelspark.sources.json import json_array_rows, json_fields
from panelspark.session import checkpoint_dir
from panelspark.sources import manifest as MF
from panelspark.sources.csv import line_report, read_wide_lines, wide_cells, wide_lines
from panelspark.sources.tables import duplicate_keys, stored

# Fixed values used by the query keys (parameters of the reports).
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
INDEX_MEMBERS = ("1-URGENT", "2-HIGH")
HIGH_VALUE, LOW_VALUE = 100.0, 10.0
DATE_RANGE_DAYS = (19727, 19734)            # 2024-01-05 .. 2024-01-12 as day numbers
OLD_UNTIL = _dt.date(2024, 1, 20)           # stored table ends here
BATCH_FROM = _dt.date(2024, 1, 18)          # new batch starts here (overlap)
REPLACE_OLD_UNTIL = _dt.date(2024, 1, 25)
NAME_MAP = {"NATION_1": "US", "NATION_2": "Korea, South", "NATION_3": "Czechia"}
LOG_SERIES = ("purchase", "signup")
MEASURES = P.COUNTRY_MEASURES


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# ---- derived inputs ---------------------------------------------------------

def shared_path(spark, name: str) -> str:
    """A new folder in the shared root, for a store that a key builds."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stores/{name}-{uuid.uuid4().hex}"


def event_days(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.withColumn("date", F.to_date("ts"))


def event_type_flows(spark, sf) -> DataFrame:
    """Per-event indicator rows keyed by (event_type, day): confirmed = every
    event, deaths = value >= 100, recovered = value < 10.  The panel rolls
    them up per (entity, day) (A1) and turns the counts into levels."""
    return event_days(spark, sf).select(
        F.col("event_type").alias("entity"), "date", F.lit(1).alias("confirmed"),
        flag(F.col("value") >= HIGH_VALUE).alias("deaths"),
        flag(F.col("value") < LOW_VALUE).alias("recovered"))


def event_type_population(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.groupBy(F.col("event_type").alias("entity")).agg(
        F.count_distinct("user_id").alias("population"))


def event_type_panel(spark, sf) -> DataFrame:
    return P.country_panel(event_type_flows(spark, sf), "entity", "date", MEASURES,
                           population=event_type_population(spark, sf), flows=True)


USER_MEASURES = ("confirmed", "deaths", "purchases")


def user_flows(spark, sf) -> DataFrame:
    """Per-event indicator rows keyed by (user, day): confirmed = events,
    deaths = error events, purchases = purchase events."""
    return event_days(spark, sf).select(
        "user_id", "date", F.lit(1).alias("confirmed"),
        flag(F.col("event_type") == "error").alias("deaths"),
        flag(F.col("event_type") == "purchase").alias("purchases"))


def user_levels(spark, sf) -> DataFrame:
    """Cumulative levels per (user, active day)."""
    daily = rollup_sum0(user_flows(spark, sf), ["user_id", "date"], USER_MEASURES)
    return P.cumulate(daily, "user_id", "date", USER_MEASURES)


def order_prices(spark, sf) -> DataFrame:
    """Price table: one series per priority, average order price per day,
    order count as volume, members of the index flagged."""
    o = table(spark, sf, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("date"))
             .agg((money_sum("o_totalprice") / F.count(F.lit(1))).alias("adjusted"),
                  F.count(F.lit(1)).alias("volume"))
             .withColumn("djia", flag(F.col("symbol").isin(list(INDEX_MEMBERS)))))


def daily_value_pivot(spark, sf) -> DataFrame:
    """Day x event_type value sums, one column per type (explicit list)."""
    ev = event_days(spark, sf).withColumn("value", F.col("value").cast("decimal(28,6)"))
    wide = long_to_wide(ev, ["date"], "event_type", "value", EVENT_TYPES, agg="sum")
    return wide.select("date", *[F.col(t).cast("double").alias(t) for t in EVENT_TYPES])


def cases_and_prices(spark, sf) -> DataFrame:
    """Per-day total of levels left-joined to the pivoted series,
    complete rows only."""
    panel = event_type_panel(spark, sf)
    sdt = panel.groupBy("date").agg(F.sum("confirmed").alias("positive"))
    return complete_rows(sdt.join(daily_value_pivot(spark, sf), "date", "left"))


# ---- query keys -------------------------------------------------------------

def q_country_panel(spark, sf):
    return event_type_panel(spark, sf)


def q_latest_by_entity(spark, sf):
    ev = event_days(spark, sf).select("user_id", "event_id", "date", "event_type", "value")
    return latest_rows(ev, ["user_id"], "date").orderBy(
        *sort_desc_last("value", tiebreak=["user_id", "event_id"]))


def q_state_panel(spark, sf):
    o = table(spark, sf, "orders")
    m = o.select(F.col("o_orderpriority").alias("state"),
                 F.trunc(F.to_date("o_orderdate"), "month").alias("date"),
                 F.lit(1).alias("positive"),
                 flag(F.col("o_orderstatus") == "F").alias("negative"),
                 flag(F.col("o_orderstatus") == "O").alias("recovered"),
                 flag(F.col("o_orderstatus") == "P").alias("death"))
    daily = rollup_sum0(m, ["state", "date"], P.STATE_MEASURES)
    levels = P.cumulate(daily, "state", "date", P.STATE_MEASURES)
    pop = o.groupBy(F.col("o_orderpriority").alias("state")).agg(
        F.count_distinct("o_custkey").alias("population"))
    return P.state_panel(levels, "state", "date", P.STATE_MEASURES, population=pop)


def _event_measures(spark, sf) -> DataFrame:
    """Event rows whose value is missing on errors."""
    ev = event_days(spark, sf).select("user_id", "event_type", "event_id", "ts", "date", "value")
    return ev.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))


def q_locf_fill(spark, sf):
    """K9 on the rows there are: missing values of a user's first date are 0,
    then the last value is carried forward."""
    rows = _event_measures(spark, sf).select("user_id", "date", "event_id", "value")
    return gap_fill_rows(rows, "user_id", "date", ["value"], order=["event_id"])


def q_event_running_state(spark, sf):
    """W4, W9 on raw rows of five hot entities: threshold counter, last value,
    the value before, and the events so far."""
    rows = _event_measures(spark, sf).select("event_type", "ts", "event_id", "user_id", "value")
    return running_state(rows, "event_type", ["ts", "event_id"], {
        "base_events": running_count(F.col("value") >= HIGH_VALUE),
        "last_value": last_value("value"), "before": previous_value("value"),
        "n_so_far": running_count(F.lit(True))}).drop("ts")


def _by_balance() -> list:
    return [F.desc_nulls_last("c_acctbal"), F.asc("c_custkey")]


def q_ranked_rows(spark, sf):
    """The position of every customer by balance."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return row_numbers(c, _by_balance())


RANKS = (1, 2, 17, 99, 100, 149)


def q_rows_at_ranks(spark, sf):
    """F7 with a list of ranks."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return rows_at_ranks(c, _by_balance(), RANKS)


def q_customers_in_order(spark, sf):
    """O1: an ascending order on several keys, checked by the positions."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return row_numbers(c, ["c_mktsegment", "c_nationkey", "c_custkey"])


# brushed ranges of the roll-up key: within the data, one day, all of it and beyond
BRUSHED = ((_dt.date(2024, 1, 5), _dt.date(2024, 1, 12)), (_dt.date(2024, 1, 7), _dt.date(2024, 1, 7)),
           (_dt.date(2023, 12, 1), _dt.date(2024, 3, 1)))


def q_word_counts_rollup(spark, sf):
    """K11 for brushed ranges, answered from stored roll-ups (A6, F3); the
    last days of the table are appended to the store later."""
    text = F.concat_ws(" ", "event_type", "props")
    tokens = TX.token_table(event_days(spark, sf).select("date", text.alias("text")), "text")
    store = shared_path(spark, "word-rollup")
    late = F.col("date") > OLD_UNTIL
    add_counts(tokens.where(~late), store, "date", "word")
    add_counts(tokens.where(late), store, "date", "word")
    spans = [word_counts_between(spark, store, stop_words_frame(spark), lo, hi, exclude=("view",)).select(
        F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), "word", "n") for lo, hi in BRUSHED]
    return union_by_name(*spans)


MOMENT_DAYS = 7  # days of a period of stored moments


def q_corr_rollup(spark, sf):
    """A10 from stored moments: whole table and a range of weeks, the last
    days appended later."""
    cols = ["positive", *EVENT_TYPES]
    series = stored(cases_and_prices(spark, sf), "series")
    store = shared_path(spark, "moments")
    late = F.col("date") > OLD_UNTIL
    add_moments(series.where(~late), store, "date", cols, MOMENT_DAYS)
    add_moments(series.where(late), store, "date", cols, MOMENT_DAYS)
    first = DATE_RANGE_DAYS[0] // MOMENT_DAYS
    whole = stored_correlation(spark, store, cols).withColumn("span", F.lit("all"))
    some = stored_correlation(spark, store, cols, first, first + 1).withColumn("span", F.lit("weeks"))
    return whole.unionByName(some)


def q_manifest_upsert(spark, sf):
    """The stored prices as a table of manifests; the batch rewrites
    only the files that can hold one of its keys."""
    ev = event_days(spark, sf)
    old = (between_dates(ev, "ts", None, OLD_UNTIL)
           .groupBy("user_id", "date").agg(money_sum("value").alias("adjusted"),
                                           F.count(F.lit(1)).alias("volume")))
    batch = between_dates(ev, "ts", BATCH_FROM, None).select(
        "user_id", "date", F.col("value").alias("adjusted"), F.lit(1).cast("long").alias("volume"), "ts")
    root = shared_path(spark, "price-store")
    MF.replace(spark, old.filter(F.col("adjusted") > 0), root, ["date", "user_id"])
    MF.upsert(spark, root, batch, ["ts"], value="adjusted")
    return MF.read(spark, root)


def q_missing_grid(spark, sf):
    return missing_days(event_days(spark, sf), "user_id", "date")


def q_price_index(spark, sf):
    return PR.index_series(order_prices(spark, sf))


def q_cum_return(spark, sf):
    return PR.returns_panel(PR.index_series(order_prices(spark, sf)))


def q_best_worst(spark, sf):
    panel = PR.returns_panel(PR.index_series(order_prices(spark, sf)))
    return PR.best_worst(panel, index_symbol=PR.INDEX_SYMBOL)


def q_unpivot_measures(spark, sf):
    li = table(spark, sf, "lineitem")
    wide = (li.groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("date"))
              .agg(money_sum("l_quantity").alias("QUANTITY"),
                   money_sum("l_extendedprice").alias("PRICE"),
                   money_sum("l_discount").alias("DISCOUNT")))
    return wide_to_long(wide, ["date"], ["QUANTITY", "PRICE", "DISCOUNT"], "type", "value")


def q_daily_curve(spark, sf):
    panel = event_type_panel(spark, sf)
    return RP.daily_curve(panel, "date", {"CONFIRMED": "new_confirmed", "DEATHS": "new_deaths",
                                          "RECOVERED": "new_recovered"})


def q_ratio_of_sums(spark, sf):
    panel = event_type_panel(spark, sf)
    return RP.daily_curve(panel, "date", {"CONFIRMED": "new_confirmed", "DEATHS": "new_deaths",
                                          "RECOVERED": "new_recovered"},
                          per_capita=True, population="population")


def q_pivot_series(spark, sf):
    return daily_value_pivot(spark, sf)


def q_series_join_complete(spark, sf):
    return cases_and_prices(spark, sf)


def q_corr_long(spark, sf):
    return correlation_long(cases_and_prices(spark, sf), ["positive", *EVENT_TYPES], full=True)


def q_log_series(spark, sf):
    c = cases_and_prices(spark, sf).select("date", F.col("positive").cast("double").alias("positive"),
                                           *LOG_SERIES)
    long = columns_to_long(c, ["date"], ["positive", *LOG_SERIES], {"positive": "Confirmed Cases"})
    return long.withColumn("lvalue", F.round(F.log1p("value"), 6))


def q_kpi_boxes(spark, sf):
    latest = P.most_recent(event_type_panel(spark, sf), "new_confirmed", sort=False)
    return RP.kpi_boxes(latest, MEASURES, ["new_" + m for m in MEASURES])


def q_quantile_buckets(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return RP.overview_buckets(c, ["c_acctbal"])


OVERVIEW_COLS = ("confirmed", "deaths", "recovered", "new_confirmed", "new_deaths",
                 "new_recovered", "death_rate")


def q_overview_table(spark, sf):
    """The latest row of every entity with 20-break quantile buckets
    and colour levels for seven columns (one quantile pass for all)."""
    latest = P.most_recent(event_type_panel(spark, sf), "new_confirmed", sort=False)
    return RP.overview_buckets(latest.select("entity", "date", *OVERVIEW_COLS), list(OVERVIEW_COLS))


def _ranked_order():
    return sort_desc_last("new_confirmed", tiebreak=["entity"])


def q_select_by_rank(spark, sf):
    panel = event_type_panel(spark, sf)
    latest = P.most_recent(panel, "new_confirmed", sort=False)
    keys = RP.selected_keys(latest, "entity", _ranked_order(), 3)
    return RP.select_history(panel, keys, "entity").select(
        "entity", "date", "confirmed", "new_confirmed", "base_day")


def q_adaptive_curve(spark, sf):
    fl = user_flows(spark, sf).withColumn("user_id", F.col("user_id").cast("string"))
    panel = P.country_panel(fl, "user_id", "date", USER_MEASURES, flows=True)
    return RP.cumulative_curve(panel, "user_id", "date", "confirmed", mode="total")


def q_entity_count(spark, sf):
    """Exact distinct entities, as a one-row result."""
    return RP.entity_count(table(spark, sf, "events"), "user_id")


def q_adaptive_curve_lines(spark, sf):
    return RP.cumulative_curve(event_type_panel(spark, sf), "entity", "date", "confirmed", mode="lines")


def q_adaptive_curve_lines_per_capita(spark, sf):
    """K16 per capita with at most 10 entities: per-million lines by base day."""
    return RP.cumulative_curve(event_type_panel(spark, sf), "entity", "date", "confirmed",
                               mode="lines", per_capita=True)


def q_latest_points(spark, sf):
    lv = user_levels(spark, sf).withColumns({
        "state": F.when(F.col("purchases") > 0, F.lit("buyer")).otherwise(F.lit("")),
        "country": F.concat(F.lit("user "), F.col("user_id").cast("string")),
    })
    pts = RP.latest_points(lv, ["user_id"], "date", "state", "country", "confirmed", "deaths")
    return pts.select("user_id", "date", "state", "country", "confirmed", "deaths", "pct_died",
                      F.round("ldeaths", 6).alias("ldeaths"), "popup")


def q_word_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    tokens = TX.token_table(docs, "text")
    return TX.word_counts(tokens, stop_words_frame(spark))


def q_date_range(spark, sf):
    lo_n, hi_n = DATE_RANGE_DAYS
    lo = day_number_to_date_py(lo_n)
    hi = day_number_to_date_py(hi_n)
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return between_dates(ev, "ts", lo, hi).withColumn("date", F.to_date("ts"))


def day_number_to_date_py(n: int) -> _dt.date:
    """X8 for a parameter value (the column form is day_number_to_date)."""
    return _dt.date(1970, 1, 1) + _dt.timedelta(days=int(n))


def q_marker_extract(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "html")
    items = TX.marked_items(pages, "html", "<ul>", "</ul>", "</li>", keep=["page_id"], out="raw")
    return items.withColumn("item", trim_ws(strip_tags("raw")))


def _event_daily(ev: DataFrame) -> DataFrame:
    return ev.groupBy("user_id", "date").agg(F.count(F.lit(1)).alias("n"),
                                             money_sum("value").alias("value"))


def q_upsert_by_key(spark, sf):
    ev = event_days(spark, sf)
    old = (between_dates(ev, "ts", None, OLD_UNTIL)
           .groupBy("user_id", "date").agg(money_sum("value").alias("adjusted"),
                                           F.count(F.lit(1)).alias("volume")))
    batch = between_dates(ev, "ts", BATCH_FROM, None).select(
        "user_id", "date", F.col("value").alias("adjusted"), F.lit(1).cast("long").alias("volume"), "ts")
    return RF.upsert(old, batch, ["user_id", "date"], ["ts"], value="adjusted")


def q_upsert_rejected(spark, sf):
    """A batch with as many missing cells as rows leaves the store as
    it was (the positive-price filter included)."""
    ev = event_days(spark, sf)
    old = (between_dates(ev, "ts", None, OLD_UNTIL)
           .groupBy("user_id", "date").agg(money_sum("value").alias("adjusted"),
                                           F.count(F.lit(1)).alias("volume")))
    batch = between_dates(ev, "ts", BATCH_FROM, None).select(
        "user_id", "date", F.lit(None).cast("double").alias("adjusted"), F.lit(1).cast("long").alias("volume"), "ts")
    return RF.upsert(old, batch, ["user_id", "date"], ["ts"], value="adjusted")


def q_json_arrays(spark, sf):
    """The props of each user's events packed into one JSON array, read
    back as one row per element."""
    ev = table(spark, sf, "events")
    element = F.struct("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    # packed per user and day, so that no user's events meet in one row
    packed = ev.groupBy("user_id", F.to_date("ts").alias("date")).agg(
        F.to_json(F.collect_list(element)).alias("doc"))
    return json_array_rows(packed, "doc", "event_id BIGINT, k INT", keep=["user_id"], columns=["event_id", "k"])


def q_clean_spans(spark, sf):
    """X12 where it fires: spans across lines, fragments and nothing to cut."""
    p = table(spark, sf, "pages").select("page_id", "url")
    text = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("t.co lead "), F.col("url"))).otherwise(
        F.concat(F.lit("lead <b>"), F.col("url"), F.lit("\n</b> https tail > end")))
    return TX.clean_text(p.select("page_id", text.alias("text")), "text")


def q_word_counts_range(spark, sf):
    """K11 with its date range (F3) and an excluded word that occurs."""
    lo, hi = (day_number_to_date_py(n) for n in DATE_RANGE_DAYS)
    tokens = TX.token_table(event_days(spark, sf).select("date", "props"), "props")
    return TX.word_counts(tokens, stop_words_frame(spark), date="date", lo=lo, hi=hi, exclude=("7",))


# the day pages built below: (type, start marker, end marker)
DAY_PAGE = (("tweets", "Tweets of", "What happened"), ("news", "News of", "Trend"), ("social", "Social media on", "Sports"))


def q_headline_lists(spark, sf):
    """K6: day pages made of the urls of ``pages``, some with a repeated
    start marker, without tweets, without the end of the news or of the social
    list, some with an inner year mark."""
    p = table(spark, sf, "pages").select("page_id", "url")
    day = F.date_add(F.lit(_dt.date(2024, 1, 1)), (F.col("page_id") % 28).cast("int"))
    day_text = long_label("date")
    text = F.concat_ws(
        "", F.when(F.col("page_id") % 7 == 0, "Tweets of early"), F.lit("Tweets of"),
        F.when(F.col("page_id") % 5 != 0, F.concat(F.col("url"), day_text, F.lit("\tsecond "), F.col("url"))),
        F.lit("What happened \r\n News of\r\na "), F.col("url"), F.lit("\r\n\r\nb"),
        F.when(F.col("page_id") % 3 == 0, F.lit("\r\nTr\nend")).otherwise(F.lit("Trend")),
        # the social list: cut through the last '<year>|', its end marker absent at times
        F.lit("Social media on"), long_label("date"), F.lit("\r\nnoise of 2024\r\n"),
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("so far 2024\r\n"))),
        F.lit("tag "), F.col("url"), F.lit("\r\n\r\nlast\tone"),
        F.when(F.col("page_id") % 11 != 0, F.lit("Sports of the day")))
    pages = p.withColumn("date", day).withColumn("text", text)
    return TX.headline_lists(pages, sections=DAY_PAGE)


def q_replace_dates(spark, sf):
    ev = event_days(spark, sf)
    source = _event_daily(ev)
    # the stored table: its two last days were read too early and are stale
    stale = F.col("date") >= F.date_sub(F.lit(REPLACE_OLD_UNTIL), 1)
    old = source.filter(F.col("date") <= F.lit(REPLACE_OLD_UNTIL)).withColumn(
        "value", F.when(stale, F.lit(0.0)).otherwise(F.col("value")))
    return RF.replace_trailing_dates(old, source, ["user_id"], "date", overlap_days=1, late="window")


def q_append_distinct(spark, sf):
    ev = event_days(spark, sf).select(F.col("props").alias("headlines"), "date",
                                      F.col("event_type").alias("type"))
    old = between_dates(ev, "date", None, OLD_UNTIL)
    return RF.append_new_days(old, ev, "date", late="window")


def q_dup_keys(spark, sf):
    return duplicate_keys(event_days(spark, sf), ["user_id", "date", "event_type"])


def _nation_monthly(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey"), F.col("r_name").alias("state"),
        F.concat(F.lit("  "), F.col("n_name"), F.lit("\t")).alias("country"),
        F.col("n_regionkey").cast("double").alias("Lat"),
        F.when(F.col("n_regionkey") == 0, F.lit(None)).otherwise(F.col("n_nationkey"))
         .cast("double").alias("Long"))
    oc = o.join(c, o.o_custkey == c.c_custkey).select(
        "c_nationkey", F.trunc(F.to_date("o_orderdate"), "month").alias("month"), "o_orderstatus")
    return oc.join(geo, oc.c_nationkey == geo.n_nationkey).drop("c_nationkey", "n_nationkey")


def _nation_month_counts(spark, sf) -> DataFrame:
    """Orders per (location, month) with the three measures, aggregated
    once; the three landed wide files are pivots of this one table, so
    Spark reuses its exchange."""
    nm = _nation_monthly(spark, sf)
    return nm.groupBy("state", "country", "Lat", "Long", "month").agg(
        F.count(F.lit(1)).alias("confirmed"),
        F.sum(flag(F.col("o_orderstatus") == "F")).alias("deaths"),
        F.sum(flag(F.col("o_orderstatus") == "P")).alias("recovered"))


WIDE_HEADER = ("state", "country", "Lat", "Long")


def _csv_cell(c) -> Column:
    """A cell as a CSV writer leaves it: quoted where it has a comma."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(text.contains(","), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text)


def landed_lines(counts: DataFrame, measure: str, file: str, fmt: str, upto: int | None = None) -> DataFrame:
    """(file, line) of a wide file: a header with one column per month and one
    line per location, without a pivot and without reading the months on the
    driver."""
    span = counts.agg(F.sort_array(F.collect_set("month"))).scalar()
    months = F.col("months") if upto is None else F.slice("months", 1, upto)
    cells = F.map_from_entries(F.collect_list(F.struct("month", measure)))
    places = counts.groupBy("state", "country", "Lat", "Long").agg(cells.alias("cells")).withColumn("months", span)
    ids = [_csv_cell(F.col(c)) for c in WIDE_HEADER]
    values = F.transform(months, lambda m: F.coalesce(F.try_element_at("cells", m).cast("string"), F.lit("")))
    lines = places.select(F.concat_ws(",", *ids, F.array_join(values, ",")).alias("line"))
    labels = F.transform(months, lambda m: F.date_format(m, fmt))
    header = counts.sparkSession.range(1).select(span.alias("months")).select(
        F.concat_ws(",", F.lit(",".join(WIDE_HEADER)), F.array_join(labels, ",")).alias("line"))
    return header.unionByName(lines).select(F.lit(file).alias("file"), "line")


def q_wide_to_long(spark, sf):
    """K1: three landed files, the third with four-digit years, as lines
    through the reader's own parser."""
    keys = ["state", "country", "Lat", "Long", "date"]
    counts = stored(_nation_month_counts(spark, sf), "nation-months")  # read by header and lines of every file
    long = [wide_cells(wide_lines(landed_lines(counts, m, m, fmt), WIDE_HEADER), m, WIDE_HEADER, WIDE_HEADER)
            for m, fmt in (("confirmed", "M/d/yy"), ("deaths", "M/d/yy"), ("recovered", "M/d/yyyy"))]
    return null_safe_join(null_safe_join(long[0], long[1], keys, "left"), long[2], keys, "left")


def _generations(spark, sf) -> DataFrame:
    """Three generations of one landed file, written and read in one scan: few
    months, more months, and all with short and long lines."""
    counts = stored(_nation_month_counts(spark, sf), "nation-months")
    root = shared_path(spark, "wide-files")
    for i, upto in enumerate((12, 40, None)):
        lines = landed_lines(counts, "confirmed", "", "M/d/yy", upto)
        if i == 2:  # the last generation is damaged: cells cut off, cells too many
            here = F.col("line")
            lines = lines.withColumn("line", F.when(
                here.startswith("ASIA,"), F.regexp_replace(here, ",[^,]*,[^,]*$", "")).when(
                here.startswith("EUROPE,"), F.concat(here, F.lit(",7"))).otherwise(here))
        lines.select("line").coalesce(1).write.text(f"{root}/g{i}")
    lines = read_wide_lines(spark, [f"{root}/g{i}" for i in range(3)])
    return wide_lines(lines.withColumn("file", F.regexp_extract("file", "/(g[0-9]+)/", 1)), WIDE_HEADER)


def q_wide_generations(spark, sf):
    """Files whose headers differ, as (file, location, date, value)."""
    parsed = _generations(spark, sf)
    per_file = [wide_cells(parsed.where(F.col("file") == f"g{i}"), "confirmed", WIDE_HEADER, WIDE_HEADER).select(
        F.lit(f"g{i}").alias("file"), "state", "country", "date", "confirmed") for i in range(3)]
    return union_by_name(*per_file)


def q_wide_line_report(spark, sf):
    """The lines whose cells do not fit the header of their file."""
    return line_report(_generations(spark, sf))


def q_name_map(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name", "c_mktsegment")
    mapped = j.withColumn("n_name", map_names(F.col("n_name"), NAME_MAP))
    return rename_all(mapped, ["c_custkey", "country", "segment"])


def q_clean_numbers(spark, sf):
    c = table(spark, sf, "customer")
    txt = c.select("c_custkey",
                   F.when(F.col("c_acctbal") < 0, F.lit("N.A.")).otherwise(
                       F.format_number("c_acctbal", 2)).alias("bal"),
                   F.concat(F.col("c_nationkey").cast("string"), F.lit(" %")).alias("pct"))
    return clean_columns(txt, ["bal", "pct"], to_number)


def q_report_latest_line(spark, sf):
    curve = q_daily_curve(spark, sf)
    line = RP.latest_line(curve, labels={"CONFIRMED": "Confirmed", "DEATHS": "Deaths",
                                         "RECOVERED": "Recovered"})
    return line.withColumnsRenamed({"CONFIRMED": "confirmed", "DEATHS": "deaths",
                                    "RECOVERED": "recovered"})


def q_projections(spark, sf):
    c = table(spark, sf, "customer")
    picked = drop_positions(c.select(*columns_present(c, [*columns_matching(c, r"^c_"), "c_absent"])), [1])
    staged = with_stages(picked, {"bal_k": F.col("c_acctbal") / F.lit(1000.0)},
                         {"bal_k": rround("bal_k", 1)})
    return staged.orderBy(F.desc("c_acctbal"), F.asc("c_custkey"))


def q_first_n(spark, sf):
    """The 50 highest balances, a top-k report."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return top_n(c, [F.desc("c_acctbal"), F.asc("c_custkey")], 50)


def q_date_functions(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    o = o.withColumn("ymd_text", compact_text("d"))
    o = o.withColumns({"parsed": parse_ymd("ymd_text"),
                       "day_no": F.datediff("d", F.lit(_dt.date(1970, 1, 1)))})
    return o.withColumns({"next_day": F.date_add("parsed", 1), "prev_day": F.date_sub("parsed", 1),
                          "from_day_no": day_number_to_date("day_no"),
                          "month_name": month_name("d"), "label": long_label("d")})


def q_text_clean(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("\t "), F.upper("p_name"), F.lit(" \r\n")).alias("padded"))
    p = p.withColumn("name_clean", trim_ws("padded"))
    return p.select("p_partkey", "name_clean",
                    F.regexp_replace("name_clean", " [A-Z]+$", "").alias("stem"),
                    F.lower("name_clean").alias("lowered"))


def q_round_half_even(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return c.withColumns({"r1": rround("c_acctbal", 1), "r0": rround("c_acctbal", 0)})


def q_json_fields(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "props")
    return json_fields(ev, "props", "k INT, m STRING").select("event_id", "k", "m")


def q_report_rows_latest(spark, sf):
    """F9 on a panel: every entity's row at the table's latest date."""
    return rows_at_max(event_type_panel(spark, sf), "date").select(
        "entity", "date", "confirmed", "new_confirmed", "death_rate")


def q_state_latest(spark, sf):
    """mostRecentState: latest row per state, death rate descending."""
    latest = P.most_recent(q_state_panel(spark, sf), "death_rate", ["state"])
    return latest.select("state", "date", "positive", "death", "recovered", "new_positive",
                         "new_deaths", "new_recovered", "death_rate")


def q_state_daily_curve(spark, sf):
    return RP.daily_curve(q_state_panel(spark, sf), "date",
                          {"CONFIRMED": "new_positive", "DEATHS": "new_deaths",
                           "RECOVERED": "new_recovered"}, per_capita=True)


def q_state_kpi_boxes(spark, sf):
    """K14 on the state page: totals, per-capita values and percentages of
    positives over the latest row of every state."""
    latest = P.most_recent(q_state_panel(spark, sf), "death_rate", ["state"], sort=False)
    return RP.kpi_boxes(latest, ["positive", "death", "recovered"],
                        ["new_positive", "new_deaths", "new_recovered"])


def nation_panel(spark, sf) -> DataFrame:
    """Entity = nation (25), date = order month, levels = running order
    counts; population = customers per nation from the customer table."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    flows = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
              .select(F.col("n_name").alias("entity"),
                      F.trunc(F.to_date("o_orderdate"), "month").alias("date"),
                      F.lit(1).alias("confirmed"),
                      flag(F.col("o_orderstatus") == "F").alias("deaths"),
                      flag(F.col("o_orderstatus") == "P").alias("recovered")))
    pop = (c.join(n, c.c_nationkey == n.n_nationkey)
            .groupBy(F.col("n_name").alias("entity")).agg(F.count(F.lit(1)).alias("population")))
    return P.country_panel(flows, "entity", "date", MEASURES, population=pop, flows=True)


def q_adaptive_curve_per_capita(spark, sf):
    """K16 per capita with more than 10 entities: total per-million line."""
    return RP.cumulative_curve(nation_panel(spark, sf), "entity", "date", "confirmed",
                               mode="total", per_capita=True)


def q_base_name_totals(spark, sf):
    """A13 + X24: suffix stripped to a base name, then sum and max per base."""
    p = table(spark, sf, "part").select("p_name", "p_retailprice", "p_size")
    base = trim_ws(F.regexp_replace("p_name", " .*$", ""))
    out = sum_max_by(p.withColumn("price_cents", (F.col("p_retailprice") * 100).cast("decimal(18,0)")),
                     base, {"price_cents": "price_cents"}, {"max_size": "p_size"}, "base_name")
    return out.withColumn("price_cents", F.col("price_cents").cast("long"))


def q_state_panel_gaps(spark, sf):
    """F11, X23 where they fire: states without a population, measures that are
    missing (0 in the panel, in measure columns only)."""
    o = table(spark, sf, "orders")
    levels = q_state_panel(spark, sf).select("state", "date", *P.STATE_MEASURES)
    odd = F.month("date") % 5 == 0
    holes = levels.withColumns({"negative": F.when(~odd, F.col("negative")),
                                "recovered": F.when(F.month("date") != 3, F.col("recovered"))})
    pop = o.groupBy(F.col("o_orderpriority").alias("state")).agg(F.count_distinct("o_custkey").alias("population"))
    pop = pop.withColumn("population", F.when(F.col("state") != "5-LOW", F.col("population")))
    return P.state_panel(holes, "state", "date", P.STATE_MEASURES, population=pop).select(
        "state", "date", *P.STATE_MEASURES, "population", "total_test_results", "pos_per_mil", "new_total",
        "new_recovered", "recovered_per_mil")


def q_html_node_text(spark, sf):
    """Text of each page's <footer> element (HTML parser on the
    executors, entities decoded)."""
    pages = table(spark, sf, "pages").select("page_id", "html")
    return node_text(pages, "footer")


QUERIES = {
    "country_panel": q_country_panel,
    "latest_by_entity": q_latest_by_entity,
    "state_panel": q_state_panel,
    "locf_fill": q_locf_fill,
    "missing_grid": q_missing_grid,
    "price_index": q_price_index,
    "cum_return": q_cum_return,
    "best_worst": q_best_worst,
    "unpivot_measures": q_unpivot_measures,
    "daily_curve": q_daily_curve,
    "ratio_of_sums": q_ratio_of_sums,
    "pivot_series": q_pivot_series,
    "series_join_complete": q_series_join_complete,
    "corr_long": q_corr_long,
    "log_series": q_log_series,
    "kpi_boxes": q_kpi_boxes,
    "quantile_buckets": q_quantile_buckets,
    "overview_table": q_overview_table,
    "select_by_rank": q_select_by_rank,
    "adaptive_curve": q_adaptive_curve,
    "adaptive_curve_lines": q_adaptive_curve_lines,
    "adaptive_curve_lines_per_capita": q_adaptive_curve_lines_per_capita,
    "latest_points": q_latest_points,
    "word_counts": q_word_counts,
    "date_range": q_date_range,
    "marker_extract": q_marker_extract,
    "upsert_by_key": q_upsert_by_key,
    "upsert_rejected": q_upsert_rejected,
    "json_arrays": q_json_arrays,
    "word_counts_range": q_word_counts_range,
    "clean_spans": q_clean_spans,
    "headline_lists": q_headline_lists,
    "replace_dates": q_replace_dates,
    "append_distinct": q_append_distinct,
    "dup_keys": q_dup_keys,
    "wide_to_long": q_wide_to_long,
    "name_map": q_name_map,
    "clean_numbers": q_clean_numbers,
    "report_latest_line": q_report_latest_line,
    "report_rows_latest": q_report_rows_latest,
    "projections": q_projections,
    "first_n": q_first_n,
    "entity_count": q_entity_count,
    "date_functions": q_date_functions,
    "text_clean": q_text_clean,
    "round_half_even": q_round_half_even,
    "json_fields": q_json_fields,
    "state_latest": q_state_latest,
    "state_daily_curve": q_state_daily_curve,
    "state_kpi_boxes": q_state_kpi_boxes,
    "adaptive_curve_per_capita": q_adaptive_curve_per_capita,
    "base_name_totals": q_base_name_totals,
    "event_running_state": q_event_running_state,
    "ranked_rows": q_ranked_rows,
    "rows_at_ranks": q_rows_at_ranks,
    "customers_in_order": q_customers_in_order,
    "word_counts_rollup": q_word_counts_rollup,
    "corr_rollup": q_corr_rollup,
    "manifest_upsert": q_manifest_upsert,
    "wide_generations": q_wide_generations,
    "wide_line_report": q_wide_line_report,
    "state_panel_gaps": q_state_panel_gaps,
    "html_node_text": q_html_node_text,
}
