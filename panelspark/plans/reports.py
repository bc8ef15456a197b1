"""Report jobs over a panel (K13-K19): selection, KPI boxes, daily and
cumulative curves, latest points, quantile-bucketed overview, summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.semantics import na_text, num_text, pretty_num, rround, safe_div, sum0
from panelspark.operators.aggregate import distinct_count, exact_sum, ratio_of_sums, totals_by
from panelspark.operators.joins import keep_keys
from panelspark.operators.ranking import rows_at_ranks
from panelspark.operators.reshape import wide_to_long
from panelspark.operators.select import rows_at_max, top_n
from panelspark.operators.stats import quantile_breaks, with_buckets
from panelspark.operators.window import latest_flag
from panelspark.sources.tables import stored

TOP_RANKS = 1000  # ranks up to which a top-k is read
# Fixed value: the label for a missing sub-entity name.
MISSING_STATE_LABEL = "State Not Given"


def selected_keys(latest: DataFrame, entity: str, order: Sequence[Column],
                  ranks: int | Sequence[int]) -> DataFrame:
    """the entities at the given 1-based ranks of the sorted latest
    table (an int k means ranks 1..k), as a key frame of bounded size.

    For small ranks only the first max(rank) rows are kept (distributed top-k:
    no global sort); larger ones are found by global row numbers."""
    if isinstance(ranks, int):
        return top_n(latest, order, ranks).select(entity)
    wanted = sorted({int(r) for r in ranks})
    if wanted[-1] > TOP_RANKS:
        return rows_at_ranks(latest, order, wanted).select(entity)
    # at most max(rank) rows, as one array in their order
    top = top_n(latest, order, wanted[-1]).select(entity)
    listed = top.agg(F.collect_list(entity).alias("_top"))
    picked = F.filter(F.array(*[F.get("_top", r - 1) for r in wanted]), lambda x: x.isNotNull())
    return listed.select(F.explode(picked).alias(entity))


def select_history(panel: DataFrame, keys: DataFrame | None, entity: str) -> DataFrame:
    """The panel rows of the selected entities; None = all."""
    if keys is None:
        return panel
    return keep_keys(panel, keys, entity)


def kpi_boxes(latest: DataFrame, levels: Sequence[str], news: Sequence[str],
              population: str = "population", pct_of: str | None = None) -> DataFrame:
    """Every box in one aggregate -- totals of the new and level
    measures, per-capita versions (1 place), each level's percentage of
    ``pct_of`` (1 place) and display text: every total and per-capita value
    with separators ('12,345', '1,234.5'), and each level with its percentage
    ('12,345 (1.2%)')."""
    pct_of = pct_of or levels[0]
    aggs = []
    for m in list(news) + list(levels):
        aggs.append(sum0(m).alias(f"total_{m}"))
        aggs.append(rround(safe_div(sum0(m), exact_sum(population)), 1).alias(f"per_mil_{m}"))
    for m in levels:
        if m != pct_of:
            aggs.append(rround(safe_div(sum0(m), sum0(pct_of)) * F.lit(100.0), 1).alias(f"pct_{m}"))
    row = latest.agg(*aggs)
    texts = {f"text_total_{m}": F.coalesce(F.format_number(F.col(f"total_{m}").cast("double"), 0), F.lit("NA"))
             for m in list(news) + list(levels)}
    texts |= {f"text_per_mil_{m}": pretty_num(F.col(f"per_mil_{m}")) for m in list(news) + list(levels)}
    for m in levels:
        if m != pct_of:
            texts[f"text_{m}"] = F.concat(
                F.format_number(F.col(f"total_{m}").cast("double"), 0), F.lit(" ("),
                num_text(F.col(f"pct_{m}")), F.lit("%)"))
    return row.withColumns(texts)


def daily_curve(panel: DataFrame, date: str, measures: Mapping[str, str],
                per_capita: bool = False, population: str = "population") -> DataFrame:
    """Per-date totals (A2) or per-capita ratios (A3) of the measures,
    in long form (date, type, value) (R2)."""
    if per_capita:
        wide = ratio_of_sums(panel, [date], measures, population)
    else:
        wide = totals_by(panel, [date], measures)
    return wide_to_long(wide.select(date, *[F.col(o).cast("double").alias(o) for o in measures]),
                        [date], list(measures), "type", "value")


def entity_count(df: DataFrame, entity: str) -> DataFrame:
    """Exact distinct entities as a one-row result; give it the narrow
    key column or the dimension, not a panel."""
    return df.agg(distinct_count(entity).alias("n_entities"))


def cumulative_curve(panel: DataFrame, entity: str, date: str, measure: str, mode: str,
                     per_capita: bool = False, population: str = "population") -> DataFrame:
    """``mode='total'`` gives one line by date, ``mode='lines'`` one
    line per entity from its base day (base_day > 0).  The caller chooses:
    the result's form never depends on the data.

    Per capita, the total line is sum(measure) / sum(population) per date
    (``<measure>_per_mil``) and the entity lines show ``<measure>_per_mil``."""
    if mode not in ("total", "lines"):
        raise ValueError(mode)
    per_mil = f"{measure}_per_mil"
    if mode == "total":
        if per_capita:
            return ratio_of_sums(panel, [date], {per_mil: measure}, population)
        return totals_by(panel, [date], {measure: measure})
    shown = per_mil if per_capita else measure
    return panel.filter(F.col("base_day") > 0).select(entity, "base_day", date, shown)


def latest_points(df: DataFrame, location: Sequence[str], date: str, state: str, country: str,
                  confirmed: str, deaths: str) -> DataFrame:
    """The latest row of every location with death share (0 when both
    counts are 0), log size, a label for a missing state and popup text."""
    out = df.withColumn("_latest", latest_flag(date, list(location)))
    out = out.filter(F.col("_latest") == 1).drop("_latest")
    pct = F.when((F.col(confirmed) == 0) & (F.col(deaths) == 0), F.lit(0.0)).otherwise(
        rround(safe_div(deaths, confirmed), 2))
    out = out.withColumns({
        "pct_died": pct,
        "ldeaths": F.log1p(F.col(deaths).cast("double")),
        state: F.when(F.col(state) == "", F.lit(MISSING_STATE_LABEL)).otherwise(F.col(state)),
    })
    return out.withColumn("popup", F.concat(
        F.lit("<p>"), na_text(F.col(state)), F.lit(", "), na_text(F.col(country)),
        F.lit("</p></p>Confirmed: "), num_text(F.col(confirmed)),
        F.lit("</p></p>Deaths: "), num_text(F.col(deaths)),
        F.lit(" ("), num_text(F.col("pct_died") * F.lit(100)), F.lit("%)</p>")))


def overview_buckets(table: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Per-column 20 quantile breaks and each cell's bucket / colour
    level.  The table is written once: the breaks and the result read it."""
    table = stored(table, "overview")
    return with_buckets(table, cols, quantile_breaks(table, cols, approx=approx))


def latest_line(curve_long: DataFrame, date: str = "date", type_col: str = "type",
                value: str = "value", labels: Mapping[str, str] | None = None) -> DataFrame:
    """The curve at its latest date, values as text, one row with a
    subtitle 'Yesterday: A = 1,234, B = ...'."""
    last = rows_at_max(curve_long, date)
    labels = labels or {}
    parts = []
    piv = last.groupBy(date).pivot(type_col, list(labels) if labels else None).agg(F.first(value))
    names = list(labels) if labels else [c for c in piv.columns if c != date]
    for i, t in enumerate(names):
        parts += [F.lit(("" if i == 0 else ", ") + labels.get(t, t) + " = "),
                  pretty_num(F.col(t))]
    return piv.withColumn("subtitle", F.concat(F.lit("Yesterday: "), *parts))


