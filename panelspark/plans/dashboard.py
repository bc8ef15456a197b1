"""The dashboard's data work as two steps.

``build_tables`` derives every panel once from the stored tables and writes
each one as a table in the shared folder (``spark.checkpoint.dir`` unless a
root is given).  Reading the written table back cuts the lineage: reports
never recompute the panel, and a lost executor costs a re-read of files,
not a re-run of the panel plan (unlike ``cache()``).

``country_view`` / ``state_view`` / ``market_view`` are the per-interaction
reports: given the materialised tables, a selection and a mode, they return
DataFrames (KPI boxes, curves, map points, bucketed tables, correlations,
word counts) -- the data behind each chart of the source app.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.stopwords import stop_words_frame
from panelspark.operators.joins import join_dim
from panelspark.operators.reshape import columns_to_long, long_to_wide
from panelspark.operators.select import between_dates, complete_rows, sort_desc_last
from panelspark.operators.stats import correlation_long
from panelspark.plans import panel as P
from panelspark.plans import prices as PR
from panelspark.plans import reports as RP
from panelspark.plans import text as TX
from panelspark.session import checkpoint_dir

# Symbols shown against cases on the log chart.
LOG_CHART_SYMBOLS = ("regn", "zm", "nclh", "rcl")


def materialize(spark: SparkSession, df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared root and read it back."""
    base = (root or checkpoint_dir(spark)).rstrip("/")
    path = f"{base}/panels/{name}/v={time.time_ns()}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def build_tables(spark: SparkSession, ccdr: DataFrame, state_data: DataFrame, stocks: DataFrame,
                 headlines: DataFrame, country_pop: DataFrame, state_pop: DataFrame,
                 root: str | None = None) -> dict[str, DataFrame]:
    """Derive and materialise: country panel (K7), filled locations (K9),
    state panel (K8), price series and returns (K10), headline tokens (K11)."""
    cpop = country_pop.select("country", "population")
    spop = state_pop.select("state", F.col("Pop").alias("population"))
    out = {
        "country_summary": P.country_panel(ccdr, "country", "date", population=cpop),
        "locations": P.fill_locations(ccdr, ["state", "country", "Lat", "Lng"], "date",
                                      P.COUNTRY_MEASURES, trim=["country"]),
        "state_summary": P.state_panel(state_data, "state", "date", population=spop),
        "prices": PR.index_series(stocks),
        "headline_tokens": TX.token_table(headlines, "headlines"),
    }
    tables = {k: materialize(spark, v, k, root) for k, v in out.items()}
    # returns read the written price table instead of recomputing it
    tables["returns"] = materialize(spark, PR.returns_panel(tables["prices"]), "returns", root)
    return tables


def _curve_mode(curve: str | None, selected: Sequence[str] | None) -> str:
    """Lines for chosen entities, one total otherwise, unless stated."""
    return curve or ("lines" if selected else "total")


def country_view(tables: dict[str, DataFrame], selected: Sequence[str] | None = None,
                 per_capita: bool = False, curve: str | None = None) -> dict[str, DataFrame]:
    """World page: selected countries (None = all) -> KPI boxes, daily
    curve, cumulative curve, map points, overview table with buckets."""
    panel = tables["country_summary"]
    latest = P.most_recent(panel, "new_confirmed", ["country"], sort=False)
    keys = None if not selected else panel.sparkSession.createDataFrame(
        [(c,) for c in selected], "country string")
    sel_latest = RP.select_history(latest, keys, "country")
    history = RP.select_history(panel, keys, "country")
    measures = {"CONFIRMED": "new_confirmed", "DEATHS": "new_deaths", "RECOVERED": "new_recovered"}
    locations = RP.select_history(tables["locations"], keys, "country")
    return {
        "latest": sel_latest,
        "kpis": RP.kpi_boxes(sel_latest, P.COUNTRY_MEASURES, ["new_" + m for m in P.COUNTRY_MEASURES]),
        "daily_curve": RP.daily_curve(history, "date", measures, per_capita=per_capita),
        "cumulative_curve": RP.cumulative_curve(history, "country", "date", "confirmed",
                                                _curve_mode(curve, selected), per_capita=per_capita),
        "map_points": RP.latest_points(locations, ["Lat", "Lng"], "date", "state", "country",
                                       "confirmed", "deaths"),
        "table": RP.overview_buckets(
            latest.select("country", "date", "confirmed", "deaths", "recovered", "new_confirmed",
                          "new_deaths", "new_recovered", "death_rate"),
            ["confirmed", "deaths", "recovered", "new_confirmed", "new_deaths", "new_recovered",
             "death_rate"]),
    }


def state_view(tables: dict[str, DataFrame], selected: Sequence[str] | None = None,
               per_capita: bool = False, curve: str | None = None) -> dict[str, DataFrame]:
    """US page: the same reports over the state panel."""
    panel = tables["state_summary"]
    latest = P.most_recent(panel, "death_rate", ["state"], sort=False)
    keys = None if not selected else panel.sparkSession.createDataFrame(
        [(s,) for s in selected], "state string")
    sel_latest = RP.select_history(latest, keys, "state")
    history = RP.select_history(panel, keys, "state")
    measures = {"CONFIRMED": "new_positive", "DEATHS": "new_deaths", "RECOVERED": "new_recovered"}
    return {
        "latest": sel_latest,
        "kpis": RP.kpi_boxes(sel_latest, ["positive", "death", "recovered"],
                             ["new_positive", "new_deaths", "new_recovered"]),
        "daily_curve": RP.daily_curve(history, "date", measures, per_capita=per_capita),
        "cumulative_curve": RP.cumulative_curve(
            history.withColumn("positive_per_mil", F.col("pos_per_mil")), "state", "date",
            "positive", _curve_mode(curve, selected), per_capita=per_capita),
        "table": RP.overview_buckets(
            latest.select("state", "date", "positive", "death", "recovered", "new_positive",
                          "new_deaths", "new_recovered", "death_rate"),
            ["positive", "death", "recovered", "new_positive", "new_deaths", "new_recovered",
             "death_rate"]),
    }


def market_view(tables: dict[str, DataFrame], symbols: Sequence[str], lo: _dt.date | None = None,
                hi: _dt.date | None = None, log_symbols: Sequence[str] = LOG_CHART_SYMBOLS,
                exclude_words: Sequence[str] = ("trump",)) -> dict[str, DataFrame]:
    """Stocks page of the given symbols for an optional date range: best/worst and index change,
    word counts, cases x prices table, correlation matrix, log series."""
    spark = tables["returns"].sparkSession
    cases = tables["country_summary"].groupBy("date").agg(F.sum("confirmed").alias("positive"))
    prices = tables["prices"]
    wide = long_to_wide(prices.filter(F.col("symbol").isin(list(symbols))).select("date", "symbol", "adjusted"), ["date"], "symbol", "adjusted",
                        list(symbols))
    cdata = complete_rows(join_dim(between_dates(cases, "date", lo, hi),
                                   between_dates(wide, "date", lo, hi), "date", "left"))
    present = [s for s in log_symbols if s in symbols]
    log_long = columns_to_long(cdata.select("date", F.col("positive").cast("double"), *present),
                               ["date"], ["positive", *present], {"positive": "Confirmed Cases"})
    return {
        "best_worst": PR.best_worst(tables["returns"]),
        "word_counts": TX.word_counts(tables["headline_tokens"], stop_words_frame(spark), date="date",
                                      lo=lo, hi=hi, exclude=exclude_words),
        "cases_prices": cdata,
        "correlation": correlation_long(cdata, ["positive", *symbols]),
        "log_series": log_long.withColumn("lvalue", F.log1p("value")),
    }


def summary_report(tables: dict[str, DataFrame], selected: Sequence[str] | None = None,
                   per_capita: bool = False) -> dict[str, DataFrame]:
    """The printable summary -- latest rows of the selected countries,
    their daily curve with the 'Yesterday: ...' line at its latest date, and
    the cumulative curve."""
    view = country_view(tables, selected, per_capita)
    labels = {"CONFIRMED": "Confirmed", "DEATHS": "Deaths", "RECOVERED": "Recovered"}
    return {
        "table": view["latest"].select("country", "date", "confirmed", "deaths", "recovered",
                                       "new_confirmed", "new_deaths", "new_recovered",
                                       "death_rate")
                               .orderBy(*sort_desc_last("new_confirmed", tiebreak=["country"])),
        "daily_curve": view["daily_curve"],
        "yesterday": RP.latest_line(view["daily_curve"], labels=labels),
        "cumulative_curve": view["cumulative_curve"],
    }
