"""Delimited sources."""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.dates import parse_mdy
from panelspark.functions.semantics import empty_if_null, to_type, trim_ws
from panelspark.operators.joins import null_safe_join
from panelspark.operators.reshape import wide_to_long
from panelspark.operators.select import DATE_HEADER, columns_matching
from panelspark.operators.setops import union_by_name

# The id columns of the wide case files and their new names.
WIDE_IDS = ("Province/State", "Country/Region", "Lat", "Long")
WIDE_ID_NAMES = ("state", "country", "Lat", "Lng")

# The schema of the state population file.
STATE_POPULATION_SCHEMA = T.StructType([
    T.StructField("stateLong", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("Pop", T.LongType()), T.StructField("Growth", T.DoubleType()),
    T.StructField("Pop2018", T.LongType()), T.StructField("Pop2010", T.LongType()),
    T.StructField("growthSince2010", T.DoubleType()), T.StructField("Percent", T.DoubleType()),
    T.StructField("density", T.DoubleType()),
])


PRICE_SCHEMA = ("symbol string, date date, open double, high double, low double, close double, "
                "volume bigint, adjusted double")
PRICES_FROM = "2020-01-01"  # fixed value: the first day of the price history


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """A wide time-series CSV with a header.  Date columns stay text
    (header names are data); values are parsed later by name."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def header_dates(long: DataFrame, headers: Sequence[str], name_col: str = "date") -> DataFrame:
    """Replace the header text in ``name_col`` by its date.

    Headers are schema metadata (one per date column), so each is parsed
    once -- by ``parse_mdy`` over a constant table the optimizer folds on
    the driver -- and rows get their date by a lookup in a map literal: no
    regex per row, no join."""
    parsed = _parsed_headers(long.sparkSession, tuple(headers))
    if not parsed:
        return long.withColumn(name_col, F.lit(None).cast("date"))
    lookup = F.create_map(*[x for h, d in parsed.items() for x in (F.lit(h), F.lit(d).cast("date"))])
    return long.withColumn(name_col, F.try_element_at(lookup, F.col(name_col)))


_HEADER_CACHE: OrderedDict = OrderedDict()  # of the last HEADERS_KEPT header rows
HEADERS_KEPT = 64


def _parsed_headers(spark: SparkSession, headers: tuple) -> dict:
    """header text -> date (or None), parsed by ``parse_mdy``; a pure
    function of the header strings, so it is remembered."""
    if headers not in _HEADER_CACHE:
        from panelspark.sources.tables import literal_table
        rows = (literal_table(spark, [(h,) for h in headers], "_header string")
                .select("_header", parse_mdy("_header").alias("_date")).collect()) if headers else []
        _HEADER_CACHE[headers] = {r["_header"]: r["_date"] for r in rows}
        if len(_HEADER_CACHE) > HEADERS_KEPT:
            _HEADER_CACHE.popitem(last=False)
    return _HEADER_CACHE[headers]


def wide_file_to_long(wide: DataFrame, value_name: str,
                      ids: Sequence[str] = WIDE_IDS, id_names: Sequence[str] = WIDE_ID_NAMES) -> DataFrame:
    """K1 for one file: date columns found by an anchored pattern, wide ->
    long, text keys trimmed ('' kept), coordinates and values typed,
    header dates parsed (two- or four-digit years)."""
    dates = columns_matching(wide, DATE_HEADER)
    long = wide_to_long(wide, list(ids), dates, "date", value_name)
    renamed = long.toDF(*id_names, "date", value_name)
    s, c, lat, lng = id_names
    typed = renamed.select(
        trim_ws(empty_if_null(s)).alias(s), trim_ws(empty_if_null(c)).alias(c),
        F.col(lat).try_cast("double").alias(lat), F.col(lng).try_cast("double").alias(lng),
        "date", to_type(trim_ws(value_name), "int").alias(value_name))
    return header_dates(typed, dates, "date")


def country_series(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """K1: {value_name: path} of wide files -> one long table, left-joined
    on the five keys with NULL matching NULL (rows only in a later file
    are not added, as in the source)."""
    keys = list(WIDE_ID_NAMES[:2]) + list(WIDE_ID_NAMES[2:]) + ["date"]
    frames = [wide_file_to_long(read_wide(spark, p), v) for v, p in files.items()]
    out = frames[0]
    for f in frames[1:]:
        out = null_safe_join(out, f, keys, "left")
    return out


# ---- files whose headers differ ---------------------------------------------

# one cell behind its comma: quoted (doubled quotes inside) or plain
_CELL = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*+)'


def _cells(line) -> Column:
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), 1)
    plain = lambda c: F.when(c.startswith('"'), F.regexp_replace(
        F.substring(c, F.lit(2), F.length(c) - 2), '""', '"')).otherwise(c)
    return F.transform(cells, plain)


def wide_lines(lines: DataFrame, ids: Sequence[str] = WIDE_IDS) -> DataFrame:
    """``lines(file, line)`` of wide files -> ``file, cells, names, dates, kind``:
    the cells of each data line beside its own file's header and the dates in it
    (parsed once per header; null for the ids).  Kind is
    ``ok``, ``short`` or ``long`` (fewer or more cells than the header), or
    ``no header``.  One small row per different header is joined to the lines;
    files may have more or fewer date columns, and no schema passes the driver."""
    # told from the raw line, so that only data lines and headers are cut into cells
    is_header = F.col("line").rlike("^" + ",".join(f'"?{re.escape(c)}"?' for c in ids))
    clean = lines.select("file", F.regexp_replace("line", "\r$", "").alias("line")).where("line <> ''")
    cut = lambda df: df.select("file", _cells(F.col("line")).alias("cells"))
    headers = (cut(clean.where(is_header)).groupBy("file").agg(F.min("cells").alias("names"))
               .select(F.col("file").alias("_file"), "names", F.transform("names", parse_mdy).alias("dates")))
    data = cut(clean.where(~is_header)).join(headers, F.col("file") == F.col("_file"), "left").drop("_file")
    n, m = F.size("cells"), F.size("names")
    kind = (F.when(F.col("names").isNull(), "no header").when(n < m, "short").when(n > m, "long").otherwise("ok"))
    return data.withColumn("kind", kind)


def wide_cells(parsed: DataFrame, value_name: str, ids: Sequence[str] = WIDE_IDS,
               id_names: Sequence[str] = WIDE_ID_NAMES) -> DataFrame:
    """K1 for lines of any header: one typed row per location and date column,
    cells placed by their position.  Cells a short line lacks are missing,
    cells beyond the header have no date and are left to ``line_report``."""
    placed = F.transform("dates", lambda d, i: F.struct(d.alias("date"), F.get(F.col("cells"), i).alias("_cell")))
    s, c, lat, lng = id_names
    key = {n: F.get(F.col("cells"), F.lit(i)) for i, n in enumerate(id_names)}
    rows = parsed.where("names is not null").select(
        trim_ws(key[s]).alias(s), trim_ws(key[c]).alias(c), key[lat].try_cast("double").alias(lat),
        key[lng].try_cast("double").alias(lng), F.inline(F.filter(placed, lambda x: x["date"].isNotNull())))
    return rows.select(s, c, lat, lng, "date", to_type(trim_ws("_cell"), "int").alias(value_name))


def line_report(parsed: DataFrame) -> DataFrame:
    """Lines whose cells do not fit their header, counted per file and kind."""
    return parsed.where("kind <> 'ok'").groupBy("file", "kind").agg(F.count(F.lit(1)).alias("n"))


def read_wide_lines(spark: SparkSession, path) -> DataFrame:
    """Lines of landed files with the file they stand in (one scan, splittable)."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def read_state_population(spark: SparkSession, path: str) -> DataFrame:
    """Small delimited dimension with declared types."""
    return spark.read.option("header", True).schema(STATE_POPULATION_SCHEMA).csv(path)


def read_prices(spark: SparkSession, path: str, members: DataFrame, start=None, end=None) -> DataFrame:
    """Landed daily price files (symbol, date, open, high, low, close,
    volume, adjusted) -> tagged with ``ticker`` and the 0/1 index-member
    flag (left join to the member list), within a date range: from ``start``
    (default PRICES_FROM) to ``end`` (default: the day before today).  The
    files are read once, with declared types."""
    p = spark.read.option("header", True).schema(PRICE_SCHEMA).csv(path).withColumn("ticker", F.col("symbol"))
    last = F.date_sub(F.current_date(), 1) if end is None else F.lit(end)
    p = p.filter(F.col("date").between(F.lit(PRICES_FROM if start is None else start).cast("date"), last))
    m = members.select(F.col("symbol"), F.lit(1).alias("djia")).distinct()
    return p.join(m, "symbol", "left").withColumn("djia", F.coalesce("djia", F.lit(0)))


def symbol_list(members: DataFrame, extra: DataFrame) -> DataFrame:
    """Index members plus extra symbols, one column."""
    return union_by_name(members.select("symbol"), extra.select("symbol")).distinct()
