"""Price jobs (K10): member index, return factors, cumulative returns,
latest changes and best/worst performers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.semantics import rround, safe_div, sum0
from panelspark.operators.select import best_and_worst, positive
from panelspark.operators.setops import union_by_name
from panelspark.operators.window import cumulative_return, latest_flag, return_factor, row_index

# The index divisor and the label of the index series.
INDEX_DIVISOR = 0.1474
INDEX_SYMBOL = "djia"


def index_series(prices: DataFrame, symbol: str = "symbol", date: str = "date",
                 adjusted: str = "adjusted", volume: str = "volume", member: str = "djia",
                 divisor: float = INDEX_DIVISOR, index_symbol: str = INDEX_SYMBOL) -> DataFrame:
    """A4 + U1: members' prices summed per date and scaled by ``divisor``
    become one more series labelled ``index_symbol``; non-members are kept
    as they are.  Rows without a positive price are dropped first (F2)."""
    clean = positive(prices, adjusted)
    idx = (clean.filter(F.col(member) == 1).groupBy(date)
                .agg(safe_div(F.sum(adjusted), F.lit(float(divisor))).alias(adjusted),
                     sum0(volume).alias(volume))
                .withColumn(symbol, F.lit(index_symbol)))                # P8
    rest = clean.filter(F.col(member) == 0).select(date, symbol, adjusted, volume)
    return union_by_name(rest, idx)


def returns_panel(series: DataFrame, symbol: str = "symbol", date: str = "date",
                  adjusted: str = "adjusted") -> DataFrame:
    """Observation number, period return factor, cumulative return
    and latest flag per symbol (one shared window)."""
    s = positive(series, adjusted)
    return s.withColumns({
        "obs": row_index(symbol, date),
        "adjusted_change": return_factor(adjusted, symbol, date),
        "cum_change": cumulative_return(adjusted, symbol, date),
        "most_recent": latest_flag(date, symbol),
    })


def latest_changes(panel: DataFrame) -> DataFrame:
    return panel.filter(F.col("most_recent") == 1)


def index_change(panel: DataFrame, symbol: str = "symbol",
                 index_symbol: str = INDEX_SYMBOL) -> DataFrame:
    """The index's latest period change (factor - 1), one row."""
    return (latest_changes(panel).filter(F.col(symbol) == index_symbol)
            .select((F.col("adjusted_change") - F.lit(1.0)).alias("index_change")))


def best_worst(panel: DataFrame, symbol: str = "symbol",
               index_symbol: str | None = INDEX_SYMBOL) -> DataFrame:
    """O3 (+P7): best and worst latest change and the index's latest change
    (factor - 1), all in one global aggregate; each also as a percentage
    rounded to two places."""
    extra = {}
    if index_symbol is not None:
        extra["index_change"] = F.max(F.when(F.col(symbol) == index_symbol,
                                             F.col("adjusted_change") - F.lit(1.0)))
    out = best_and_worst(latest_changes(panel), symbol, "adjusted_change", extra=extra)
    pct = {f"{w}_pct": rround((F.col(f"{w}_adjusted_change") - F.lit(1.0)) * F.lit(100.0), 2) for w in ("best", "worst")}
    if index_symbol is not None:
        pct["index_pct"] = rround(F.col("index_change") * F.lit(100.0), 2)
    return out.withColumns(pct)
