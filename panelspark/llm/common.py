"""Shared helpers: written intermediates, word splitting, id handling."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import checkpoint_dir

# Fixed value: the word pattern of the contracts (a run of characters that are
# neither space nor one of the five ASCII control blanks).
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\r\x0b\x0c"  # blanks that a line can hold
WORD = r"[^\x20\x09-\x0D]+"
FILE_ROWS = 1 << 18  # rows of ids and numbers that one written file may hold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared root that the cluster names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage,
    survives lost executors and is never computed twice.  ``rows``, for narrow
    tables: a bound on their number, so that few rows are few files whatever
    the number of shuffle partitions."""
    path = fresh_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches, rows: int = 512):
    """Arrow batches in slices, so that the texts a worker holds stay few."""
    for whole in batches:
        for i in range(0, whole.num_rows, rows):
            yield whole.slice(i, rows)


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give no words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), lambda w: w != "")


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def type_of(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()
