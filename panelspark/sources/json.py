"""JSON sources (S12, S13): JSON text columns parsed with an explicit
schema by the JVM (``from_json``); no Python on the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_fields(df: DataFrame, col: str, schema: str | T.StructType,
                keep: Sequence[str] | None = None) -> DataFrame:
    """One JSON object per row -> the wanted fields as typed columns.
    Fields the object lacks become NULL; unwanted fields are ignored; a
    malformed document gives NULLs."""
    keep = [c for c in df.columns if c != col] if keep is None else list(keep)
    parsed = F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}).alias("_j")
    return df.select(*keep, parsed).select(*keep, "_j.*")


def json_array_rows(df: DataFrame, col: str, element_schema: str | T.StructType,
                    keep: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """One JSON array of objects per row -> one row per element,
    projected to ``columns``."""
    arr_schema = (T.ArrayType(element_schema) if isinstance(element_schema, T.StructType)
                  else f"array<struct<{element_schema}>>")
    out = df.select(*keep, F.inline(F.from_json(F.col(col), arr_schema)))
    return out.select(*keep, *columns) if columns else out


def read_json_files(spark: SparkSession, path: str, schema: str | T.StructType,
                    multiline: bool = True) -> DataFrame:
    """S12/S13 over landed files: each file a JSON document (array or
    object)."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)
