"""Panel jobs: entity-level panels with per-period changes, running counters,
per-million rates and latest rows (K7, K8, K9).

Plan shape: the input is first rolled up to (entity, date) with a hash
aggregate (map-side partial aggregation absorbs hot entities); all window
columns then share one ``partitionBy(entity).orderBy(date)`` exchange over
that small grain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.semantics import rround, safe_div, trim_ws
from panelspark.operators.aggregate import rollup_sum0
from panelspark.operators.joins import join_dim
from panelspark.operators.select import sort_desc_last
from panelspark.operators.window import (
    gap_fill, latest_flag, new_keep_first, new_zero_first, per_unit, running_sum,
    threshold_days, whole,
)

COUNTRY_MEASURES = ("confirmed", "deaths", "recovered")
STATE_MEASURES = ("positive", "negative", "recovered", "death")
PER_MILLION = 0.000001   # population counts are expressed in millions


def _new(m: str) -> str:
    return "new_" + m


def attach_population(df: DataFrame, entity: str, population: DataFrame | None,
                      pop_col: str = "population") -> DataFrame:
    """J2 + F11: left join the population dimension (rows with a missing
    population dropped from the dimension first)."""
    if population is None:
        return df.withColumn(pop_col, F.lit(None).cast("double"))
    dim = population.filter(F.col(pop_col).isNotNull()).select(entity, pop_col)
    return join_dim(df, dim, entity, "left")


def cumulate(df: DataFrame, entity: str, date: str, measures: Sequence[str]) -> DataFrame:
    """Running totals of per-period counts per entity (turns a flow table
    into cumulative levels)."""
    return df.withColumns({m: running_sum(m, entity, date) for m in measures})


def country_panel(base: DataFrame, entity: str = "country", date: str = "date",
                  measures: Sequence[str] = COUNTRY_MEASURES,
                  population: DataFrame | None = None, threshold: int = 100,
                  rollup: bool = True, flows: bool = False) -> DataFrame:
    """K7: cumulative levels per (entity, sub-entity, date) -> entity panel.

    ``flows=True`` means the input holds per-period counts rather than
    levels: after the roll-up they are turned into running totals inside
    the same entity window as the rest of the panel (one exchange).

    Columns: levels; max_date; most_recent (0/1, ties kept); population in
    millions; <m>_per_mil (1 place); new_<m> (first row keeps its level);
    new_<m>_per_mil; base_day (running count of days with the first
    measure >= threshold); death_rate (second / first measure, 2 places).
    """
    first, second = measures[0], measures[1]
    df = base.withColumn(entity, trim_ws(entity))
    if rollup:
        df = rollup_sum0(df, [entity, date], measures)              # A1
    if flows:
        df = cumulate(df, entity, date, measures)
    df = attach_population(df, entity, population)                  # J2, F11
    df = df.withColumns({                                           # stage 1
        "max_date": F.max(date).over(whole(entity)),
        "most_recent": latest_flag(date, entity),
        "population": F.col("population") * F.lit(PER_MILLION),
    })
    stage2 = {f"{m}_per_mil": per_unit(m, "population", 1) for m in measures}
    stage2.update({_new(m): new_keep_first(m, entity, date) for m in measures})
    stage2["base_day"] = threshold_days(first, entity, date, threshold)
    stage2["death_rate"] = rround(safe_div(second, first), 2)
    df = df.withColumns(stage2)
    return df.withColumns({f"{_new(m)}_per_mil": per_unit(_new(m), "population", 1)
                           for m in measures})


def most_recent(panel: DataFrame, order_by: str, tiebreak: Sequence[str] = (),
                sort: bool = True) -> DataFrame:
    """Latest row(s) per entity, sorted by ``order_by`` descending with
    missing values last."""
    out = panel.filter(F.col("most_recent") == 1)
    return out.orderBy(*sort_desc_last(order_by, tiebreak=tiebreak)) if sort else out


def state_panel(base: DataFrame, entity: str = "state", date: str = "date",
                measures: Sequence[str] = STATE_MEASURES,
                population: DataFrame | None = None, threshold: int = 100) -> DataFrame:
    """K8: per-entity panel whose per-period changes start at 0 (W2), with
    changes of changes (W3), test totals and rates.

    ``measures`` = (positive, negative, recovered, death)."""
    pos, neg, rec, dth = measures
    df = base.fillna(0, subset=list(measures))                      # X23
    df = attach_population(df, entity, population)
    df = df.withColumns({
        "most_recent": latest_flag(date, entity),
        "population": F.col("population") * F.lit(PER_MILLION),
        "total_test_results": F.col(pos) + F.col(neg),
    })
    df = df.withColumns({
        "pos_pct": safe_div(pos, "total_test_results"),
        "death_pct": safe_div(dth, pos),
        "death_rate": safe_div(dth, pos),
        "pos_per_mil": per_unit(pos, "population"),
        "death_per_mil": per_unit(dth, "population"),
        "recovered_per_mil": per_unit(rec, "population"),
        "new_positive": new_zero_first(pos, entity, date),
        "new_deaths": new_zero_first(dth, entity, date),
        "new_total": new_zero_first("total_test_results", entity, date),
        "new_recovered": new_zero_first(rec, entity, date),
        "base_day": threshold_days(pos, entity, date, threshold),
    })
    return df.withColumns({
        "new_positive_per_mil": per_unit("new_positive", "population"),
        "new_positive_change": new_zero_first("new_positive", entity, date),
        "new_deaths_per_mil": per_unit("new_deaths", "population"),
        "new_deaths_change": new_zero_first("new_deaths", entity, date),
        "new_total_change": new_zero_first("new_total", entity, date),
        "new_recovered_per_mil": per_unit("new_recovered", "population"),
    })


def fill_locations(df: DataFrame, keys: Sequence[str], date: str,
                   measures: Sequence[str], trim: Sequence[str] = ()) -> DataFrame:
    """K9: trim text keys, then zero-fill the first date and carry values
    forward per location."""
    if trim:
        df = df.withColumns({c: trim_ws(c) for c in trim})
    return gap_fill(df, list(keys), date, measures)
