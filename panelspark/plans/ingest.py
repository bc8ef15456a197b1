"""Ingest jobs: wide case files -> long fact (K1) and an HTML population
table -> typed dimension with re-mapped names (K2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.names import map_names
from panelspark.functions.semantics import to_number, trim_ws
from panelspark.operators.select import clean_columns
from panelspark.sources.csv import country_series  # noqa: F401  (K1)
from panelspark.functions.dates import parse_ymd
from panelspark.plans.refresh import refresh_partitioned
from panelspark.plans.text import headline_lists
from panelspark.sources.csv import read_prices
from panelspark.sources.html import first_table, html_tables
from panelspark.sources.json import read_json_files
from panelspark.sources.tables import HEADLINE_SCHEMA, STATE_SCHEMA, conform

# The population table's columns after the rank column.
POPULATION_COLUMNS = ("country", "population", "yearlyChangePct", "netChange", "density",
                      "landArea", "netMigrants", "fertRate", "medAge", "urbanPopPct",
                      "worldSharePct")


STATE_JSON = "date string, state string, positive string, negative string, recovered string, death string"


def refresh_states(spark: SparkSession, path: str, store: str, staging_root: str | None = None) -> DataFrame:
    """K3 from landed state JSON: yyyymmdd dates, typed columns, the arrived
    (state, date) pairs replaced in the month-partitioned ``store``; late
    corrections are kept."""
    raw = read_json_files(spark, path, STATE_JSON).withColumn("date", parse_ymd("date"))
    batch = conform(raw, STATE_SCHEMA, text_keys=["state"])
    return refresh_partitioned(spark, store, batch, "replace_dates", keys=["state"], late="keep",
                               staging_root=staging_root)


def refresh_prices(spark: SparkSession, path: str, members: DataFrame, store: str,
                   staging_root: str | None = None, **span) -> DataFrame:
    """K4 from landed price files: tagged and typed, one row per (symbol,
    date), guarded, upserted into ``store`` where the new batch wins."""
    batch = read_prices(spark, path, members, **span)
    return refresh_partitioned(spark, store, batch, "upsert", keys=["symbol", "date"], order=["close"],
                               value="adjusted", staging_root=staging_root)


def refresh_headlines(spark: SparkSession, pages: DataFrame, store: str,
                      staging_root: str | None = None) -> DataFrame:
    """K5 + K6 from day pages (date, text): the three typed headline lists,
    appended to ``store`` so that a repeated page adds nothing; pages of
    stored days are taken too."""
    batch = conform(headline_lists(pages), HEADLINE_SCHEMA)
    return refresh_partitioned(spark, store, batch, "append_distinct", late="keep", staging_root=staging_root)


def country_population(pages: DataFrame, columns: Sequence[str] = POPULATION_COLUMNS,
                       name_map: dict | None = None) -> DataFrame:
    """K2: first HTML table of each landed page, rank column dropped, every
    column but the name cleaned to a number ('1,439,323,776', '0.39 %',
    'N.A.' -> NULL), names re-mapped to the case table's spelling."""
    t = first_table(html_tables(pages), list(columns)).drop("page_id")
    t = clean_columns(t, list(columns[1:]), to_number)
    return t.withColumn(columns[0], map_names(trim_ws(F.col(columns[0])), name_map))
