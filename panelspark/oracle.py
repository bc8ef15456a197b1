"""Independent SQL (DuckDB dialect) for every query key in
``panelspark.queries``.  Written from the operator definitions, not from
the Spark plans; shared pieces are CTE fragments.

Conventions: sums of integer flags are cast to BIGINT (DuckDB widens them),
money is summed as DECIMAL(28,6) then cast to DOUBLE, divisions
use NULLIF(den, 0), rounding is half-even (round_even).
"""

from __future__ import annotations

import math
import time

from panelspark.functions.stopwords import ENGLISH_STOP_WORDS

# the event types of the driver's table, stated here on their own
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

WS = "' ' || chr(9) || chr(13) || chr(10)"
RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _money(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(28,6))) AS DOUBLE)"


# a word in RE2: letters, digits and underscores; between letters one of
# . : ' and their relatives, between digits one of . , ; ' and theirs
_L, _D = r"[\p{L}\p{M}]", r"\p{Nd}"
SQL_WORD = rf"(?:{_L}(?:[.:''’·․‘﹒＇．]{_L})*|{_D}(?:[.,;''’․‘﹒＇．，；]{_D})*|[_‿⁀])+"


def _totals(names: list[str]) -> str:
    return ", ".join(f"format('{{:,}}', CAST(total_{m} AS BIGINT)) AS text_total_{m}" for m in names)


def _per_mil(names: list[str]) -> str:
    """Per-capita box texts: one decimal, seven digits, separators."""
    x = "per_mil_{m}"
    return ", ".join((
        f"CASE WHEN {x} IS NULL THEN 'NA' WHEN {x} >= 1000000 THEN format('{{{{:,}}}}', CAST(round_even({x}, 0) AS BIGINT)) "
        f"ELSE format('{{{{:,}}}}', CAST(floor({x}) AS BIGINT)) || CASE WHEN {x} = floor({x}) THEN '' "
        f"ELSE '.' || CAST(CAST(round(({x} - floor({x})) * 10) AS INTEGER) AS VARCHAR) END END AS text_{x}"
    ).format(m=m) for m in names)


def _stop_list() -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"


# --- event-type panel (country_panel and everything built on it) -----------
PANEL = f"""
daily AS (
  SELECT trim(event_type, {WS}) AS entity, CAST(ts AS DATE) AS date,
         CAST(count(*) AS BIGINT) AS c,
         CAST(sum(CASE WHEN value >= 100 THEN 1 ELSE 0 END) AS BIGINT) AS d,
         CAST(sum(CASE WHEN value < 10 THEN 1 ELSE 0 END) AS BIGINT) AS r
  FROM events GROUP BY 1, 2),
lv AS (
  SELECT entity, date,
         CAST(sum(c) OVER w AS BIGINT) AS confirmed,
         CAST(sum(d) OVER w AS BIGINT) AS deaths,
         CAST(sum(r) OVER w AS BIGINT) AS recovered
  FROM daily WINDOW w AS (PARTITION BY entity ORDER BY date {RUN})),
pop AS (SELECT event_type AS entity, CAST(count(DISTINCT user_id) AS BIGINT) AS population
        FROM events GROUP BY 1),
j AS (
  SELECT lv.*, CAST(p.population AS DOUBLE) * CAST(0.000001 AS DOUBLE) AS population
  FROM lv LEFT JOIN (SELECT * FROM pop WHERE population IS NOT NULL) p ON lv.entity = p.entity),
p1 AS (
  SELECT entity, date, confirmed, deaths, recovered, population,
         max(date) OVER (PARTITION BY entity) AS max_date,
         CAST(CASE WHEN date = max(date) OVER (PARTITION BY entity) THEN 1 ELSE 0 END AS INTEGER) AS most_recent,
         round_even(confirmed / NULLIF(population, 0), 1) AS confirmed_per_mil,
         round_even(deaths / NULLIF(population, 0), 1) AS deaths_per_mil,
         round_even(recovered / NULLIF(population, 0), 1) AS recovered_per_mil,
         coalesce(confirmed - lag(confirmed) OVER w, confirmed) AS new_confirmed,
         coalesce(deaths - lag(deaths) OVER w, deaths) AS new_deaths,
         coalesce(recovered - lag(recovered) OVER w, recovered) AS new_recovered,
         CAST(sum(CASE WHEN confirmed >= 100 THEN 1 ELSE 0 END) OVER (PARTITION BY entity ORDER BY date {RUN}) AS BIGINT) AS base_day,
         round_even(deaths / NULLIF(confirmed, 0), 2) AS death_rate
  FROM j WINDOW w AS (PARTITION BY entity ORDER BY date)),
panel AS (
  SELECT *,
         round_even(new_confirmed / NULLIF(population, 0), 1) AS new_confirmed_per_mil,
         round_even(new_deaths / NULLIF(population, 0), 1) AS new_deaths_per_mil,
         round_even(new_recovered / NULLIF(population, 0), 1) AS new_recovered_per_mil
  FROM p1)"""

PIVOT = """
pv AS (
  SELECT CAST(ts AS DATE) AS date, """ + ",\n         ".join(
    f"CAST(sum(CASE WHEN event_type = '{t}' THEN CAST(value AS DECIMAL(28,6)) END) AS DOUBLE) AS {t}"
    for t in EVENT_TYPES) + """
  FROM events GROUP BY 1)"""

CDATA = f"""{PANEL},{PIVOT},
sdt AS (SELECT date, CAST(sum(confirmed) AS BIGINT) AS positive FROM panel GROUP BY date),
cdata AS (
  SELECT sdt.date, sdt.positive, {", ".join("pv." + t for t in EVENT_TYPES)}
  FROM sdt LEFT JOIN pv ON sdt.date = pv.date
  WHERE {" AND ".join(f"pv.{t} IS NOT NULL" for t in EVENT_TYPES)} AND sdt.positive IS NOT NULL)"""

PRICES = f"""
prices AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
         {_money('o_totalprice')} / count(*) AS adjusted, CAST(count(*) AS BIGINT) AS volume,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS djia
  FROM orders GROUP BY 1, 2),
clean AS (SELECT * FROM prices WHERE adjusted > 0),
series AS (
  SELECT date, symbol, adjusted, volume FROM clean WHERE djia = 0
  UNION ALL
  SELECT date, 'djia' AS symbol, sum(adjusted) / CAST(0.1474 AS DOUBLE) AS adjusted,
         CAST(coalesce(sum(volume), 0) AS BIGINT) AS volume
  FROM clean WHERE djia = 1 GROUP BY date),
spd AS (
  SELECT date, symbol, adjusted, volume,
         CAST(row_number() OVER w AS INTEGER) AS obs,
         CASE WHEN lag(adjusted) OVER w IS NULL THEN CAST(1 AS DOUBLE)
              ELSE (adjusted - lag(adjusted) OVER w) / NULLIF(lag(adjusted) OVER w, 0) + CAST(1 AS DOUBLE) END AS adjusted_change,
         adjusted / NULLIF(first_value(adjusted) OVER (PARTITION BY symbol ORDER BY date {RUN}), 0) - CAST(1 AS DOUBLE) AS cum_change,
         CAST(CASE WHEN date = max(date) OVER (PARTITION BY symbol) THEN 1 ELSE 0 END AS INTEGER) AS most_recent
  FROM series WHERE adjusted > 0 WINDOW w AS (PARTITION BY symbol ORDER BY date))"""

GRID = """
ev AS (SELECT user_id, CAST(ts AS DATE) AS date, value FROM events),
bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM ev),
grid AS (
  SELECT u.user_id, CAST(unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT DISTINCT user_id FROM ev) u CROSS JOIN bounds b)"""

USER_LEVELS = f"""
ud AS (
  SELECT user_id, CAST(ts AS DATE) AS date, CAST(count(*) AS BIGINT) AS c,
         CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS d,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS p
  FROM events GROUP BY 1, 2),
ul AS (
  SELECT user_id, date,
         CAST(sum(c) OVER w AS BIGINT) AS confirmed,
         CAST(sum(d) OVER w AS BIGINT) AS deaths,
         CAST(sum(p) OVER w AS BIGINT) AS purchases
  FROM ud WINDOW w AS (PARTITION BY user_id ORDER BY date {RUN}))"""

EV_DAILY = f"""count(*) AS n, {_money('value')} AS value"""

NATION_MONTHLY = f"""
geo AS (
  SELECT n.n_nationkey, r.r_name AS state, trim('  ' || n.n_name || chr(9), {WS}) AS country,
         CAST(n.n_regionkey AS DOUBLE) AS Lat,
         CAST(CASE WHEN n.n_regionkey = 0 THEN NULL ELSE n.n_nationkey END AS DOUBLE) AS Long
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
nm AS (
  SELECT g.state, g.country, g.Lat, g.Long, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
         o.o_orderstatus
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey)"""

STATE = f"""
m AS (
  SELECT o_orderpriority AS state, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         CAST(count(*) AS BIGINT) AS pos_n,
         CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS neg_n,
         CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS rec_n,
         CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS dth_n
  FROM orders GROUP BY 1, 2),
lv AS (
  SELECT state, date,
         CAST(sum(pos_n) OVER w AS BIGINT) AS positive, CAST(sum(neg_n) OVER w AS BIGINT) AS negative,
         CAST(sum(rec_n) OVER w AS BIGINT) AS recovered, CAST(sum(dth_n) OVER w AS BIGINT) AS death
  FROM m WINDOW w AS (PARTITION BY state ORDER BY date {RUN})),
pop AS (SELECT o_orderpriority AS state, CAST(count(DISTINCT o_custkey) AS BIGINT) AS population
        FROM orders GROUP BY 1),
j AS (
  SELECT lv.state, lv.date, coalesce(lv.positive, 0) AS positive, coalesce(lv.negative, 0) AS negative,
         coalesce(lv.recovered, 0) AS recovered, coalesce(lv.death, 0) AS death,
         CAST(p.population AS DOUBLE) * CAST(0.000001 AS DOUBLE) AS population
  FROM lv LEFT JOIN (SELECT * FROM pop WHERE population IS NOT NULL) p ON lv.state = p.state),
s1 AS (
  SELECT *, CAST(CASE WHEN date = max(date) OVER (PARTITION BY state) THEN 1 ELSE 0 END AS INTEGER) AS most_recent,
         positive + negative AS total_test_results FROM j),
s2 AS (
  SELECT *,
         positive / NULLIF(total_test_results, 0) AS pos_pct,
         death / NULLIF(positive, 0) AS death_pct,
         death / NULLIF(positive, 0) AS death_rate,
         positive / NULLIF(population, 0) AS pos_per_mil,
         death / NULLIF(population, 0) AS death_per_mil,
         recovered / NULLIF(population, 0) AS recovered_per_mil,
         coalesce(positive - lag(positive) OVER w, 0) AS new_positive,
         coalesce(death - lag(death) OVER w, 0) AS new_deaths,
         coalesce(total_test_results - lag(total_test_results) OVER w, 0) AS new_total,
         coalesce(recovered - lag(recovered) OVER w, 0) AS new_recovered,
         CAST(sum(CASE WHEN positive >= 100 THEN 1 ELSE 0 END) OVER (PARTITION BY state ORDER BY date {RUN}) AS BIGINT) AS base_day
  FROM s1 WINDOW w AS (PARTITION BY state ORDER BY date))
, state_panel AS (
SELECT *,
       new_positive / NULLIF(population, 0) AS new_positive_per_mil,
       coalesce(new_positive - lag(new_positive) OVER w, 0) AS new_positive_change,
       new_deaths / NULLIF(population, 0) AS new_deaths_per_mil,
       coalesce(new_deaths - lag(new_deaths) OVER w, 0) AS new_deaths_change,
       coalesce(new_total - lag(new_total) OVER w, 0) AS new_total_change,
       new_recovered / NULLIF(population, 0) AS new_recovered_per_mil
FROM s2 WINDOW w AS (PARTITION BY state ORDER BY date))"""

PROBS = "[" + ", ".join(f"{0.05 * i:.2f}" for i in range(20)) + "]"


def oracle_sql() -> dict[str, str]:
    stop = _stop_list()
    q: dict[str, str] = {}

    q["country_panel"] = f"WITH {PANEL} SELECT * FROM panel"

    q["latest_by_entity"] = """
WITH e AS (SELECT user_id, event_id, CAST(ts AS DATE) AS date, event_type, value FROM events)
SELECT e.* FROM e JOIN (SELECT user_id, max(date) AS date FROM e GROUP BY user_id) m
  ON e.user_id = m.user_id AND e.date = m.date"""

    q["state_panel"] = f"WITH {STATE} SELECT * FROM state_panel"

    q["locf_fill"] = f"""
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS date, event_id,
                  CASE WHEN event_type <> 'error' THEN value END AS value FROM events),
z AS (SELECT user_id, date, event_id,
             CASE WHEN value IS NULL AND date = min(date) OVER (PARTITION BY user_id)
                  THEN CAST(0 AS DOUBLE) ELSE value END AS value FROM e)
SELECT user_id, date, event_id,
       last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY date, event_id {RUN}) AS value
FROM z"""

    q["event_running_state"] = f"""
WITH e AS (SELECT event_type, ts, event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)
SELECT event_type, event_id, user_id, value,
       CAST(sum(CASE WHEN value >= 100 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS base_events,
       last_value(value IGNORE NULLS) OVER w AS last_value,
       lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before,
       count(*) OVER w AS n_so_far
FROM e WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id {RUN})"""

    q["ranked_rows"] = """
SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS row_no
FROM customer"""

    q["rows_at_ranks"] = """
SELECT c_custkey, c_acctbal, c_mktsegment,
       row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS row_no
FROM customer QUALIFY row_no IN (1, 2, 17, 99, 100, 149)"""

    q["customers_in_order"] = """
SELECT c_custkey, c_mktsegment, c_nationkey,
       row_number() OVER (ORDER BY c_mktsegment, c_nationkey, c_custkey) AS row_no
FROM customer"""

    spans = "\nUNION ALL ".join(
        f"SELECT DATE '{lo}' AS lo, DATE '{hi}' AS hi, word, CAST(count(*) AS BIGINT) AS n FROM w "
        f"WHERE date BETWEEN DATE '{lo}' AND DATE '{hi}' AND NOT list_contains({stop}, word) AND word <> 'view' GROUP BY word"
        for lo, hi in (("2024-01-05", "2024-01-12"), ("2024-01-07", "2024-01-07"), ("2023-12-01", "2024-03-01")))
    q["word_counts_rollup"] = f"""
WITH w AS (SELECT CAST(ts AS DATE) AS date,
                  unnest(regexp_extract_all(lower(event_type || ' ' || props), '{SQL_WORD}', 0)) AS word FROM events)
{spans}"""

    q["missing_grid"] = f"""
WITH {GRID}
SELECT g.user_id, g.date FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.user_id = g.user_id AND ev.date = g.date)"""

    q["price_index"] = f"WITH {PRICES} SELECT * FROM series"
    q["cum_return"] = f"WITH {PRICES} SELECT * FROM spd"
    q["best_worst"] = f"""
WITH {PRICES},
latest AS (SELECT * FROM spd WHERE most_recent = 1),
b AS (SELECT symbol, adjusted_change FROM latest ORDER BY adjusted_change DESC, symbol ASC LIMIT 1),
w AS (SELECT symbol, adjusted_change FROM latest ORDER BY adjusted_change ASC, symbol DESC LIMIT 1)
SELECT b.symbol AS best_symbol, b.adjusted_change AS best_adjusted_change,
       w.symbol AS worst_symbol, w.adjusted_change AS worst_adjusted_change,
       (SELECT max(adjusted_change) - CAST(1 AS DOUBLE) FROM latest WHERE symbol = 'djia') AS index_change,
       round_even((b.adjusted_change - 1) * 100, 2) AS best_pct, round_even((w.adjusted_change - 1) * 100, 2) AS worst_pct,
       round_even((SELECT max(adjusted_change) - CAST(1 AS DOUBLE) FROM latest WHERE symbol = 'djia') * 100, 2) AS index_pct
FROM b, w"""

    q["unpivot_measures"] = f"""
WITH m AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         {_money('l_quantity')} AS QUANTITY, {_money('l_extendedprice')} AS PRICE,
         {_money('l_discount')} AS DISCOUNT
  FROM lineitem GROUP BY 1)
SELECT date, 'QUANTITY' AS type, QUANTITY AS value FROM m
UNION ALL SELECT date, 'PRICE', PRICE FROM m
UNION ALL SELECT date, 'DISCOUNT', DISCOUNT FROM m"""

    daily_tot = """
t AS (SELECT date, CAST(coalesce(sum(new_confirmed), 0) AS DOUBLE) AS CONFIRMED,
             CAST(coalesce(sum(new_deaths), 0) AS DOUBLE) AS DEATHS,
             CAST(coalesce(sum(new_recovered), 0) AS DOUBLE) AS RECOVERED
      FROM panel GROUP BY date)"""
    long_t = """
SELECT date, 'CONFIRMED' AS type, CONFIRMED AS value FROM t
UNION ALL SELECT date, 'DEATHS', DEATHS FROM t
UNION ALL SELECT date, 'RECOVERED', RECOVERED FROM t"""
    q["daily_curve"] = f"WITH {PANEL}, {daily_tot} {long_t}"

    den = "NULLIF(CAST(sum(CAST(population AS DECIMAL(30,6))) AS DOUBLE), 0)"
    q["ratio_of_sums"] = f"""
WITH {PANEL},
t AS (SELECT date,
             CAST(coalesce(sum(new_confirmed), 0) AS BIGINT) / {den} AS CONFIRMED,
             CAST(coalesce(sum(new_deaths), 0) AS BIGINT) / {den} AS DEATHS,
             CAST(coalesce(sum(new_recovered), 0) AS BIGINT) / {den} AS RECOVERED
      FROM panel GROUP BY date) {long_t}"""

    q["pivot_series"] = f"WITH {PIVOT} SELECT * FROM pv"
    q["series_join_complete"] = f"WITH {CDATA} SELECT * FROM cdata"

    cols = ["positive", *EVENT_TYPES]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    corr_rows = "\nUNION ALL ".join(
        [f"SELECT '{x}' AS a, '{y}' AS b, round(covar_samp({a}, {b}) / "
         f"NULLIF(stddev_samp({a}) * stddev_samp({b}), 0), 6) AS r FROM cdata"
         for a, b in pairs for x, y in ((a, b), (b, a))]
        + [f"SELECT '{c}' AS a, '{c}' AS b, CASE WHEN stddev_samp({c}) > 0 THEN CAST(1 AS DOUBLE) END AS r "
           f"FROM cdata" for c in cols])
    q["corr_long"] = f"WITH {CDATA} {corr_rows}"

    weeks = "(SELECT * FROM cdata WHERE date BETWEEN DATE '1970-01-01' + 2818 * 7 AND DATE '1970-01-01' + 2820 * 7 - 1)"
    q["corr_rollup"] = f"""
WITH {CDATA},
a AS ({corr_rows}),
w AS ({corr_rows.replace("FROM cdata", "FROM " + weeks)})
SELECT a, b, r, 'all' AS span FROM a UNION ALL SELECT a, b, r, 'weeks' FROM w"""

    q["log_series"] = f"""
WITH {CDATA},
l AS (
  SELECT date, 'Confirmed Cases' AS type, CAST(positive AS DOUBLE) AS value FROM cdata
  UNION ALL SELECT date, 'purchase', purchase FROM cdata
  UNION ALL SELECT date, 'signup', signup FROM cdata)
SELECT date, type, value, round(ln(1 + value), 6) AS lvalue FROM l"""

    popsum = "CAST(sum(CAST(population AS DECIMAL(28,6))) AS DOUBLE)"
    kpi_cols = []
    for m in ["new_confirmed", "new_deaths", "new_recovered", "confirmed", "deaths", "recovered"]:
        kpi_cols.append(f"CAST(coalesce(sum({m}), 0) AS BIGINT) AS total_{m}")
        kpi_cols.append(f"round_even(coalesce(sum({m}), 0) / NULLIF({popsum}, 0), 1) AS per_mil_{m}")
    for m in ["deaths", "recovered"]:
        kpi_cols.append(f"round_even(coalesce(sum({m}), 0) / NULLIF(coalesce(sum(confirmed), 0), 0)"
                        f" * CAST(100 AS DOUBLE), 1) AS pct_{m}")
    q["kpi_boxes"] = f"""
WITH {PANEL},
k AS (SELECT {", ".join(kpi_cols)} FROM panel WHERE most_recent = 1)
SELECT *, {_totals(["new_confirmed", "new_deaths", "new_recovered", "confirmed", "deaths", "recovered"])},
       {_per_mil(["new_confirmed", "new_deaths", "new_recovered", "confirmed", "deaths", "recovered"])},
       format('{{:,}}', total_deaths) || ' (' || coalesce(format('{{:.15g}}', pct_deaths), 'NA') || '%)' AS text_deaths,
       format('{{:,}}', total_recovered) || ' (' || coalesce(format('{{:.15g}}', pct_recovered), 'NA') || '%)' AS text_recovered
FROM k"""

    q["quantile_buckets"] = f"""
WITH b AS (SELECT quantile_cont(c_acctbal, {PROBS}) AS q FROM customer),
k AS (SELECT c_custkey, c_acctbal,
             CAST(len(list_filter(b.q, lambda x: c_acctbal > x)) AS INTEGER) AS c_acctbal_bucket
      FROM customer, b)
SELECT *, CAST(round_even(CAST(255 AS DOUBLE) - CAST(10.75 AS DOUBLE) * c_acctbal_bucket, 0) AS INTEGER) AS c_acctbal_level
FROM k"""

    ocols = ["confirmed", "deaths", "recovered", "new_confirmed", "new_deaths", "new_recovered",
             "death_rate"]
    q["overview_table"] = f"""
WITH {PANEL},
latest AS (SELECT entity, date, {", ".join(ocols)} FROM panel WHERE most_recent = 1),
br AS (SELECT {", ".join(f"quantile_cont({c}, {PROBS}) AS q_{c}" for c in ocols)} FROM latest),
b AS (SELECT latest.*, {", ".join(
        f"CAST(len(list_filter(br.q_{c}, lambda x: {c} > x)) AS INTEGER) AS {c}_bucket" for c in ocols)}
      FROM latest, br)
SELECT *, {", ".join(
        f"CAST(round_even(CAST(255 AS DOUBLE) - CAST(10.75 AS DOUBLE) * {c}_bucket, 0) AS INTEGER) AS {c}_level"
        for c in ocols)}
FROM b"""

    q["select_by_rank"] = f"""
WITH {PANEL},
top AS (SELECT entity FROM panel WHERE most_recent = 1
        ORDER BY new_confirmed DESC NULLS LAST, entity ASC NULLS LAST LIMIT 3)
SELECT entity, date, confirmed, new_confirmed, base_day FROM panel WHERE entity IN (SELECT entity FROM top)"""

    q["adaptive_curve"] = f"""
WITH {USER_LEVELS}
SELECT date, CAST(coalesce(sum(confirmed), 0) AS BIGINT) AS confirmed FROM ul GROUP BY date"""

    q["adaptive_curve_lines"] = f"""
WITH {PANEL} SELECT entity, base_day, date, confirmed FROM panel WHERE base_day > 0"""

    q["adaptive_curve_lines_per_capita"] = f"""
WITH {PANEL} SELECT entity, base_day, date, confirmed_per_mil FROM panel WHERE base_day > 0"""

    q["latest_points"] = f"""
WITH {USER_LEVELS},
lt AS (SELECT * FROM ul WHERE date = (SELECT max(date) FROM ul u2 WHERE u2.user_id = ul.user_id)),
x AS (
  SELECT user_id, date,
         CASE WHEN purchases > 0 THEN 'buyer' ELSE 'State Not Given' END AS state,
         'user ' || CAST(user_id AS VARCHAR) AS country, confirmed, deaths,
         CASE WHEN confirmed = 0 AND deaths = 0 THEN CAST(0 AS DOUBLE)
              ELSE round_even(deaths / NULLIF(confirmed, 0), 2) END AS pct_died,
         round(ln(1 + CAST(deaths AS DOUBLE)), 6) AS ldeaths
  FROM lt)
SELECT *, '<p>' || state || ', ' || country || '</p></p>Confirmed: ' || CAST(confirmed AS VARCHAR)
          || '</p></p>Deaths: ' || CAST(deaths AS VARCHAR) || ' ('
          || coalesce(format('{{:.15g}}', pct_died * 100), 'NA') || '%)</p>' AS popup
FROM x"""

    q["word_counts"] = f"""
WITH t AS (
  SELECT regexp_replace(regexp_replace(text, '(?s)(<.*>)', ''), 't\\.co|trump|https', '', 'g') AS text
  FROM documents),
w AS (SELECT unnest(regexp_extract_all(lower(text), '{SQL_WORD}', 0)) AS word FROM t)
SELECT word, CAST(count(*) AS BIGINT) AS n FROM w
WHERE NOT list_contains({stop}, word) AND word <> 'trump'
GROUP BY word"""

    q["date_range"] = """
SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS date FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'"""

    q["marker_extract"] = f"""
WITH b AS (
  SELECT page_id,
         regexp_replace(regexp_replace(regexp_replace(html, '(?s)^.*<ul>', ''), '(?s)</ul>.*$', ''),
                        '[\\t\\n\\r]', '', 'g') AS body
  FROM pages),
i AS (SELECT page_id, unnest(list_filter(string_split(body, '</li>'), lambda s: s <> '')) AS raw FROM b)
SELECT page_id, raw, trim(regexp_replace(raw, '<[^>]*>', '', 'g'), {WS}) AS item FROM i"""

    q["upsert_by_key"] = f"""
WITH ev AS (SELECT *, CAST(ts AS DATE) AS date FROM events),
old AS (SELECT user_id, date, {_money('value')} AS adjusted, CAST(count(*) AS BIGINT) AS volume
        FROM ev WHERE date <= DATE '2024-01-20' GROUP BY 1, 2),
batch AS (SELECT user_id, date, value AS adjusted, CAST(1 AS BIGINT) AS volume, ts
          FROM ev WHERE date >= DATE '2024-01-18'),
fresh AS (
  SELECT user_id, date, adjusted, volume FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, date ORDER BY ts, adjusted, volume) AS rn
    FROM batch) WHERE rn = 1),
ok AS (SELECT count(*) > 0 AS ok FROM fresh),
f AS (SELECT * FROM fresh WHERE (SELECT ok FROM ok)),
u AS (
  SELECT * FROM old o WHERE NOT EXISTS (
    SELECT 1 FROM f WHERE f.user_id IS NOT DISTINCT FROM o.user_id AND f.date IS NOT DISTINCT FROM o.date)
  UNION ALL SELECT * FROM f)
SELECT * FROM u WHERE adjusted > 0"""

    q["manifest_upsert"] = q["upsert_by_key"]

    q["upsert_rejected"] = f"""
SELECT user_id, CAST(ts AS DATE) AS date, {_money('value')} AS adjusted, CAST(count(*) AS BIGINT) AS volume
FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20' GROUP BY 1, 2"""

    q["json_arrays"] = """
SELECT user_id, event_id, CAST(props ->> '$.k' AS INTEGER) AS k FROM events"""

    q["clean_spans"] = """
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN replace(replace(' lead ' || url, 't.co', ''), 'https', '')
                     ELSE 'lead  end' END AS text FROM pages"""

    q["word_counts_range"] = f"""
WITH w AS (SELECT unnest(regexp_extract_all(lower(props), '{SQL_WORD}', 0)) AS word FROM events
           WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12')
SELECT word, CAST(count(*) AS BIGINT) AS n FROM w
WHERE NOT list_contains({stop}, word) AND word <> '7' GROUP BY word"""

    q["headline_lists"] = """
WITH p AS (SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER) AS date FROM pages),
t AS (SELECT date, url, page_id % 7 = 0 AS twice, page_id % 5 = 0 AS no_tweets, page_id % 3 = 0 AS no_end, page_id % 2 = 0 AS even, page_id % 11 = 0 AS no_stop,
             chr(13) || chr(10) AS nl, strftime(date, '%B %-d, %Y') AS day FROM p),
tw AS (SELECT date, unnest(CASE WHEN no_tweets THEN [] ELSE [url, 'second ' || url] END) AS headlines FROM t),
ne AS (SELECT date, unnest(list_concat(['a ' || url, 'b'], CASE WHEN no_end THEN list_concat(
         ['TrendSocial media on' || day, 'noise of 2024'], CASE WHEN even THEN ['so far 2024'] ELSE [] END,
         ['tag ' || url, 'lastone' || CASE WHEN no_stop THEN '' ELSE 'Sports of the day' END]) ELSE [] END)) AS headlines FROM t),
so AS (SELECT date, unnest(['tag ' || url, 'lastone']) AS headlines FROM t)
SELECT headlines, date, 'tweets' AS type FROM tw
UNION ALL SELECT headlines, date, 'news' FROM ne
UNION ALL SELECT headlines, date, 'social' FROM so"""

    q["replace_dates"] = f"""
WITH ev AS (SELECT *, CAST(ts AS DATE) AS date FROM events),
old AS (SELECT user_id, date, {EV_DAILY} FROM ev
        WHERE date <= DATE '2024-01-25' GROUP BY 1, 2),
src AS (SELECT user_id, date, {EV_DAILY} FROM ev GROUP BY 1, 2),
new AS (SELECT * FROM src WHERE date >= (SELECT max(date) FROM old) - 1)
SELECT * FROM old o WHERE NOT EXISTS (
  SELECT 1 FROM new n WHERE n.user_id IS NOT DISTINCT FROM o.user_id AND n.date IS NOT DISTINCT FROM o.date)
UNION ALL SELECT * FROM new"""

    q["append_distinct"] = """
WITH ev AS (SELECT props AS headlines, CAST(ts AS DATE) AS date, event_type AS type FROM events),
old AS (SELECT * FROM ev WHERE date <= DATE '2024-01-20')
SELECT DISTINCT * FROM (
  SELECT * FROM old UNION ALL SELECT * FROM ev WHERE date > (SELECT max(date) FROM old))"""

    q["dup_keys"] = """
SELECT user_id, CAST(ts AS DATE) AS date, event_type, CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1"""

    q["wide_to_long"] = f"""
WITH {NATION_MONTHLY},
ids AS (SELECT DISTINCT state, country, Lat, Long FROM nm),
months AS (SELECT DISTINCT month FROM nm),
agg AS (SELECT state, country, Lat, Long, month, CAST(count(*) AS BIGINT) AS confirmed,
               CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS deaths,
               CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS recovered
        FROM nm GROUP BY ALL)
SELECT i.state, i.country, i.Lat, i.Long, m.month AS date, a.confirmed, a.deaths, a.recovered
FROM ids i CROSS JOIN months m
LEFT JOIN agg a ON a.state IS NOT DISTINCT FROM i.state AND a.country IS NOT DISTINCT FROM i.country
  AND a.Lat IS NOT DISTINCT FROM i.Lat AND a.Long IS NOT DISTINCT FROM i.Long AND a.month = m.month"""

    q["wide_generations"] = f"""
WITH {NATION_MONTHLY},
months AS (SELECT month, row_number() OVER (ORDER BY month) AS i, count(*) OVER () AS last FROM (SELECT DISTINCT month FROM nm)),
ids AS (SELECT DISTINCT state, country FROM nm),
agg AS (SELECT state, country, month, count(*) AS n FROM nm GROUP BY ALL),
g AS (SELECT * FROM (VALUES ('g0', 12), ('g1', 40), ('g2', 10000)) AS v(file, upto))
SELECT g.file, i.state, i.country, m.month AS date,
       CAST(CASE WHEN g.file = 'g2' AND i.state = 'ASIA' AND m.i > m.last - 2 THEN NULL ELSE a.n END AS INTEGER) AS confirmed
FROM g JOIN months m ON m.i <= g.upto CROSS JOIN ids i
LEFT JOIN agg a ON a.state = i.state AND a.country = i.country AND a.month = m.month"""

    q["wide_line_report"] = f"""
WITH {NATION_MONTHLY}
SELECT 'g2' AS file, CASE WHEN state = 'ASIA' THEN 'short' ELSE 'long' END AS kind, count(DISTINCT country) AS n
FROM nm WHERE state IN ('ASIA', 'EUROPE') GROUP BY state"""

    q["name_map"] = """
SELECT c.c_custkey,
       CASE n.n_name WHEN 'NATION_1' THEN 'US' WHEN 'NATION_2' THEN 'Korea, South'
                     WHEN 'NATION_3' THEN 'Czechia' ELSE n.n_name END AS country,
       c.c_mktsegment AS segment
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""

    q["clean_numbers"] = """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal,
       CAST(c_nationkey AS DOUBLE) AS pct
FROM customer"""

    q["report_latest_line"] = f"""
WITH {PANEL}, {daily_tot}
SELECT date, CONFIRMED AS confirmed, DEATHS AS deaths, RECOVERED AS recovered,
       'Yesterday: Confirmed = ' || format('{{:,}}', CAST(CONFIRMED AS BIGINT))
       || ', Deaths = ' || format('{{:,}}', CAST(DEATHS AS BIGINT))
       || ', Recovered = ' || format('{{:,}}', CAST(RECOVERED AS BIGINT)) AS subtitle
FROM t WHERE date = (SELECT max(date) FROM t)"""

    q["report_rows_latest"] = f"""
WITH {PANEL}
SELECT entity, date, confirmed, new_confirmed, death_rate FROM panel
WHERE date = (SELECT max(date) FROM panel)"""

    q["projections"] = """
SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment,
       round_even(c_acctbal / CAST(1000 AS DOUBLE), 1) + CAST(0 AS DOUBLE) AS bal_k
FROM customer ORDER BY c_acctbal DESC, c_custkey ASC"""

    q["first_n"] = """
SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey ASC LIMIT 50"""

    q["entity_count"] = "SELECT count(DISTINCT user_id) AS n_entities FROM events"

    q["date_functions"] = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
t AS (SELECT *, strftime(d, '%Y%m%d') AS ymd_text FROM o),
p AS (SELECT *, CAST(strptime(ymd_text, '%Y%m%d') AS DATE) AS parsed,
             CAST(d - DATE '1970-01-01' AS INTEGER) AS day_no FROM t)
SELECT o_orderkey, d, ymd_text, parsed, day_no,
       parsed + 1 AS next_day, parsed - 1 AS prev_day,
       DATE '1970-01-01' + day_no AS from_day_no,
       strftime(d, '%B') AS month_name, strftime(d, '%B %-d, %Y') AS label
FROM p"""

    q["text_clean"] = f"""
WITH p AS (SELECT p_partkey, trim(chr(9) || ' ' || upper(p_name) || ' ' || chr(13) || chr(10), {WS}) AS name_clean
           FROM part)
SELECT p_partkey, name_clean, regexp_replace(name_clean, ' [A-Z]+$', '') AS stem,
       lower(name_clean) AS lowered
FROM p"""

    q["round_half_even"] = """
SELECT c_custkey, c_acctbal, round_even(c_acctbal, 1) AS r1, round_even(c_acctbal, 0) AS r0
FROM customer"""

    q["json_fields"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.m') AS m
FROM events"""
    gaps = (STATE.replace("FROM lv LEFT JOIN", "FROM lvn AS lv LEFT JOIN")
            .replace("pop AS (SELECT o_orderpriority AS state, CAST(count(DISTINCT o_custkey) AS BIGINT) AS population",
                     "lvn AS (SELECT state, date, positive, death, CASE WHEN month(date) % 5 <> 0 THEN negative END AS negative, "
                     "CASE WHEN month(date) <> 3 THEN recovered END AS recovered FROM lv),\n"
                     "pop AS (SELECT o_orderpriority AS state, CASE WHEN o_orderpriority <> '5-LOW' "
                     "THEN CAST(count(DISTINCT o_custkey) AS BIGINT) END AS population"))
    q["state_panel_gaps"] = f"""
WITH {gaps}
SELECT state, date, positive, negative, recovered, death, population, total_test_results, pos_per_mil, new_total,
       new_recovered, recovered_per_mil
FROM state_panel"""

    q["state_latest"] = f"""
WITH {STATE}
SELECT state, date, positive, death, recovered, new_positive, new_deaths, new_recovered, death_rate
FROM state_panel WHERE most_recent = 1"""

    q["state_daily_curve"] = f"""
WITH {STATE},
t AS (SELECT date,
             CAST(coalesce(sum(new_positive), 0) AS BIGINT) / {den} AS CONFIRMED,
             CAST(coalesce(sum(new_deaths), 0) AS BIGINT) / {den} AS DEATHS,
             CAST(coalesce(sum(new_recovered), 0) AS BIGINT) / {den} AS RECOVERED
      FROM state_panel GROUP BY date) {long_t}"""

    skpi = []
    for m in ["new_positive", "new_deaths", "new_recovered", "positive", "death", "recovered"]:
        skpi.append(f"CAST(coalesce(sum({m}), 0) AS BIGINT) AS total_{m}")
        skpi.append(f"round_even(coalesce(sum({m}), 0) / NULLIF({popsum}, 0), 1) AS per_mil_{m}")
    for m in ["death", "recovered"]:
        skpi.append(f"round_even(coalesce(sum({m}), 0) / NULLIF(coalesce(sum(positive), 0), 0)"
                    f" * CAST(100 AS DOUBLE), 1) AS pct_{m}")
    q["state_kpi_boxes"] = f"""
WITH {STATE},
k AS (SELECT {", ".join(skpi)} FROM state_panel WHERE most_recent = 1)
SELECT *, {_totals(["new_positive", "new_deaths", "new_recovered", "positive", "death", "recovered"])},
       {_per_mil(["new_positive", "new_deaths", "new_recovered", "positive", "death", "recovered"])},
       format('{{:,}}', total_death) || ' (' || coalesce(format('{{:.15g}}', pct_death), 'NA') || '%)' AS text_death,
       format('{{:,}}', total_recovered) || ' (' || coalesce(format('{{:.15g}}', pct_recovered), 'NA') || '%)' AS text_recovered
FROM k"""

    q["adaptive_curve_per_capita"] = f"""
WITH nm AS (
  SELECT trim(n.n_name, {WS}) AS entity, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
daily AS (SELECT entity, date, count(*) AS c FROM nm GROUP BY 1, 2),
lv AS (SELECT entity, date, CAST(sum(c) OVER (PARTITION BY entity ORDER BY date {RUN}) AS BIGINT) AS confirmed
       FROM daily),
pop AS (SELECT n.n_name AS entity, count(*) AS population
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1),
j AS (SELECT lv.*, CAST(p.population AS DOUBLE) * CAST(0.000001 AS DOUBLE) AS population
      FROM lv LEFT JOIN pop p ON lv.entity = p.entity)
SELECT date, CAST(coalesce(sum(confirmed), 0) AS BIGINT) / {den} AS confirmed_per_mil
FROM j GROUP BY date"""

    q["base_name_totals"] = f"""
SELECT trim(regexp_replace(p_name, ' .*$', ''), {WS}) AS base_name,
       CAST(coalesce(sum(CAST(p_retailprice * 100 AS DECIMAL(18,0))), 0) AS BIGINT) AS price_cents,
       max(p_size) AS max_size
FROM part GROUP BY 1"""

    q["html_node_text"] = """
SELECT page_id, CAST(0 AS INTEGER) AS node_no,
       replace(replace(replace(replace(regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1),
               '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') AS text
FROM pages WHERE html LIKE '%<footer>%'"""
    return q


# ---- side-by-side check ------------------------------------------------------

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(repr(v)) if v == v else v
    if hasattr(v, "isoformat"):
        return v.isoformat() if not hasattr(v, "hour") else v.isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def compare(spark, sf: str, only=(), verbose: bool = True) -> list[str]:
    """Run the keys on Spark and DuckDB; return the names that differ."""
    import duckdb

    from panelspark.queries import QUERIES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sql = QUERIES, oracle_sql()
    bad = []
    say = print if verbose else (lambda *a, **k: None)
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            rows = [tuple(norm(x) for x in r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            say(f"{name:24s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad.append(name)
            continue
        dt = time.time() - t0
        if name not in sql:
            say(f"{name:24s} rows={len(rows)} (no oracle) {dt:.1f}s")
            continue
        try:
            cur = con.execute(sql[name])
            ocols = [d[0] for d in cur.description]
            orows = [tuple(norm(x) for x in r) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            say(f"{name:24s} ORACLE ERROR {type(e).__name__}: {str(e)[:300]}")
            bad.append(name)
            continue
        ok_cols = sorted(cols) == sorted(ocols)
        msg = ""
        ok_vals = False
        if ok_cols:
            order = sorted(range(len(cols)), key=lambda i: cols[i])
            oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
            a = sorted((tuple(r[i] for i in order) for r in rows), key=key)
            b = sorted((tuple(r[i] for i in oorder) for r in orows), key=key)
            ok_vals = a == b
            if not ok_vals and len(a) == len(b):
                for ra, rb in zip(a, b):
                    if ra != rb:
                        names = [cols[i] for i in order]
                        diff = [(n, x, y) for n, x, y in zip(names, ra, rb) if x != y]
                        msg = f" first diff: {diff[:4]}"
                        break
        else:
            msg = f" cols spark-only={sorted(set(cols)-set(ocols))} oracle-only={sorted(set(ocols)-set(cols))}"
        status = "OK " if (ok_cols and ok_vals and len(rows) == len(orows)) else "BAD"
        if status == "BAD":
            bad.append(name)
        say(f"{name:24s} {status} rows={len(rows)}/{len(orows)} {dt:.1f}s{msg}")
    return bad
