"""Typed stored tables: read, versioned replace, key checks, read-back
checks and a load log (S3-S9, S17).

A stored table is a directory of Parquet versions ``<root>/<name>/v=<n>``
plus a catalog table pointing at the current version.  A replace writes a
new version first and only then re-points the catalog, so a reader never
sees a half-written table and the version being read is never the one
being overwritten (Spark refuses to overwrite a path it is reading).
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.semantics import empty_if_null, to_type
from panelspark.session import checkpoint_dir

# The four stored tables, their columns/types and keys.
CCDR_SCHEMA = T.StructType([
    T.StructField("state", T.StringType()), T.StructField("country", T.StringType()),
    T.StructField("Lat", T.FloatType()), T.StructField("Lng", T.FloatType()),
    T.StructField("date", T.DateType()), T.StructField("confirmed", T.IntegerType()),
    T.StructField("deaths", T.IntegerType()), T.StructField("recovered", T.IntegerType()),
])
CCDR_KEY = ("country", "state", "date")
STATE_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("state", T.StringType()),
    T.StructField("positive", T.IntegerType()), T.StructField("negative", T.IntegerType()),
    T.StructField("recovered", T.IntegerType()), T.StructField("death", T.IntegerType()),
])
STATE_KEY = ("date", "state")
STOCK_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("open", T.FloatType()), T.StructField("high", T.FloatType()),
    T.StructField("low", T.FloatType()), T.StructField("close", T.FloatType()),
    T.StructField("volume", T.LongType()), T.StructField("adjusted", T.FloatType()),
    T.StructField("ticker", T.StringType()), T.StructField("djia", T.IntegerType()),
])
STOCK_KEY = ("symbol", "date")
HEADLINE_SCHEMA = T.StructType([
    T.StructField("headlines", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("type", T.StringType()),
])


def conform(df: DataFrame, schema: T.StructType, text_keys: Sequence[str] = ()) -> DataFrame:
    """Cast to the declared schema by name (extra columns dropped, missing
    ones NULL); text keys keep '' instead of NULL.  A number that does not
    fit its integral type fails the write (``to_type``)."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in text_keys:
            c = empty_if_null(c)
        cols.append(to_type(c, f.dataType).alias(f.name) if f.name in df.columns
                    else c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Keys that occur more than once (a primary key must give none)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
              .filter(F.col(out) > 1))


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a missing key column."""
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return df.filter(cond)


def create_database(spark: SparkSession, name: str) -> None:
    """S9."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def read_table(spark: SparkSession, path_or_name: str, date_col: str = "date") -> DataFrame:
    """Read a stored table (catalog name or Parquet path); a text
    ``date`` column is parsed to a date."""
    if "/" in path_or_name:
        df = spark.read.parquet(path_or_name)
    else:
        df = spark.table(path_or_name)
    if date_col in df.columns and not isinstance(df.schema[date_col].dataType, T.DateType):
        df = df.withColumn(date_col, F.to_date(date_col))
    return df


def read_tables(spark: SparkSession, sources: dict[str, str], date_col: str = "date") -> dict[str, DataFrame]:
    """S3: a {name: path or table} list read in one go (dates parsed)."""
    return {name: read_table(spark, src, date_col) for name, src in sources.items()}


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              partition_column: str | None = None, lower=None, upper=None,
              num_partitions: int | None = None, date_col: str = "date") -> DataFrame:
    """S5 against a database: a full table read over JDBC (the driver jar
    must be on the classpath).  With ``partition_column`` and bounds the
    read is split into ``num_partitions`` parallel range queries instead of
    one connection reading everything."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                        .option("lowerBound", str(lower)).option("upperBound", str(upper))
                        .option("numPartitions", str(num_partitions or 8)))
    df = reader.load()
    if date_col in df.columns and not isinstance(df.schema[date_col].dataType, T.DateType):
        df = df.withColumn(date_col, F.to_date(date_col))
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """An intermediate table in the shared folder (``spark.checkpoint.dir``),
    written once and read back: cuts the lineage, survives a lost executor.
    The folder's retention policy removes it."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/work/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_compressed(df: DataFrame, path: str, codec: str = "gzip") -> None:
    """Compressed serialized write."""
    df.write.mode("overwrite").option("compression", codec).parquet(path)


def replace_table(spark: SparkSession, df: DataFrame, name: str, root: str,
                  schema: T.StructType | None = None, keys: Sequence[str] = (),
                  text_keys: Sequence[str] = (), check_keys: bool = True,
                  partition_by: Sequence[str] = ()) -> str:
    """S6 (+S7): typed full replace.

    Casts to ``schema``, checks the key (no NULL key, no duplicate key),
    writes a new version directory and re-points the catalog table to it
    (``ALTER TABLE ... SET LOCATION`` when the schema is unchanged, so there
    is no moment without a table).  Returns the new version's path."""
    if schema is not None:
        df = conform(df, schema, text_keys)
    version = f"{root.rstrip('/')}/{name}/v={time.time_ns()}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(version)
    if keys and check_keys:
        written = spark.read.parquet(version)
        bad = duplicate_keys(written, keys).limit(1).count() + null_keys(written, keys).limit(1).count()
        if bad:
            raise ValueError(f"key {tuple(keys)} violated in new version of {name}")
    new_schema = spark.read.parquet(version).schema
    if spark.catalog.tableExists(name) and spark.table(name).schema == new_schema:
        # one metadata change: readers see the old or the new version
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{version}'")
    return version


def read_back_check(spark: SparkSession, name: str, expected: DataFrame) -> dict:
    """Re-read a stored table and compare its columns, their types and
    the row count with what was written."""
    got = spark.table(name)
    kinds = lambda df: [(f.name, f.dataType) for f in df.schema]
    return {"schema_ok": kinds(got) == kinds(expected),
            "rows": got.count(), "expected_rows": expected.count()}


def observed(df: DataFrame, date_col: str = "date") -> tuple[DataFrame, Observation]:
    """``df`` that counts itself while it is written or read once:
    rows, latest date and missing cells.  ``load_figures`` reads them after."""
    seen = Observation()
    latest = F.max(date_col) if date_col in df.columns else F.lit(None).cast("date")
    missing = sum((F.sum(F.col(f"`{c}`").isNull().cast("long")) for c in df.columns), F.lit(0))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), latest.alias("max_date"), F.coalesce(missing, F.lit(0)).alias("missing_cells")), seen


def load_figures(seen: Observation) -> dict:
    """``{rows, max_date, missing_cells}`` of an observed write."""
    return dict(seen.get)


def write_observed(df: DataFrame, path: str, date_col: str = "date", mode: str = "errorifexists",
                   partition_by: Sequence[str] = ()) -> dict:
    """Write ``df`` and return its load figures from that one pass."""
    counted, seen = observed(df, date_col)
    writer = counted.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return load_figures(seen)


def guard_passes(figures: dict) -> bool:
    """A12 on load figures: rows, and fewer missing cells than rows."""
    return figures["rows"] > 0 and figures["missing_cells"] < figures["rows"]


LOAD_LOG_SCHEMA = "table string, rows long, max_date date, loaded_at timestamp"


def log_load(spark: SparkSession, log_path: str, table_name: str, df: DataFrame | dict,
             date_col: str = "date", now: _dt.datetime | None = None) -> DataFrame:
    """Append (table, rows, max_date, loaded_at) to a load-log table.
    Given the figures of an observed write, the data is not read again."""
    now = now or _dt.datetime.now()
    if isinstance(df, dict):
        row = literal_table(spark, [(table_name, df["rows"], df["max_date"], now)], LOAD_LOG_SCHEMA)
        row.write.mode("append").parquet(log_path)
        return spark.read.parquet(log_path)
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.max(date_col).alias("max_date")).select(
        F.lit(table_name).alias("table"), "rows", "max_date", F.lit(now).alias("loaded_at"))
    row.write.mode("append").parquet(log_path)
    return spark.read.parquet(log_path)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small inline table, as a JVM-side VALUES list (no Python
    worker is started to read it)."""
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not isinstance(fields, T.StructType):
        fields = T.StructType([T.StructField("value", fields)])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(r, fields.fields)]) for r in rows]
    if not structs:
        return spark.createDataFrame([], fields)
    return spark.range(1).select(F.inline(F.array(*structs)))


def empty_partitions(spark: SparkSession, schema: T.StructType, path: str, dirs: Sequence[str]) -> None:
    """Make partitions read as empty: each partition directory is
    overwritten with a zero-row dataset (Spark writes a schema-only file).
    Dynamic partition overwrite cannot do this, since it only replaces
    partitions that receive rows."""
    for d in dirs:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{d}")


def overwrite_partitions(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str],
                         staging_root: str, keys: Sequence[str] = (),
                         touched: DataFrame | None = None) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition
    overwrite); other partitions of the dataset are untouched.

    ``df`` may be derived from the dataset itself, which Spark refuses to
    overwrite while reading, so the new partitions are first written to a
    staging folder under the shared root and the overwrite reads from
    there.  With ``keys`` (which must determine the partition) the staged
    partitions are checked for duplicate or missing keys first; a violation
    raises before anything is replaced.  ``touched`` (partition values the
    refresh was allowed to change) lets partitions that ended up with no
    rows be emptied -- dynamic overwrite cannot write an empty partition."""
    stage = f"{staging_root.rstrip('/')}/stage-{time.time_ns()}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(stage)
    # explicit schema: a refresh that leaves nothing to write stages no file
    staged = spark.read.schema(df.schema).parquet(stage)
    if keys:
        bad = duplicate_keys(staged, keys).limit(1).count() + null_keys(staged, keys).limit(1).count()
        if bad:
            raise ValueError(f"key {tuple(keys)} violated in the partitions to write")
    emptied = []
    if touched is not None:
        # bounded: one row per touched partition value
        gone = touched.select(*partition_by).distinct().join(
            staged.select(*partition_by).distinct(), list(partition_by), "left_anti").collect()
        emptied = ["/".join(f"{c}={r[c]}" for c in partition_by) for r in gone]
    (staged.select(*df.columns).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_by).parquet(path))
    if emptied:
        data_schema = T.StructType([f for f in df.schema.fields if f.name not in partition_by])
        empty_partitions(spark, data_schema, path, emptied)
