"""Scheduled refresh as Structured Streaming (K3-K5 over landed files).

The source system re-ran a script on a schedule that fetched new data and
rewrote its tables.  Here new data lands as files in a folder; a file
stream with ``trigger(availableNow=True)`` picks up exactly the files not
yet processed (tracked in the checkpoint), and ``foreachBatch`` applies the
batch refresh -- upsert by key, replace trailing dates, or append distinct
-- against the stored table and writes a new table version.

Exactly-once effect: ``foreachBatch`` may deliver a micro-batch again after
a failure; every batch function here is idempotent (upsert by key, replace
by key, union distinct), so a replay leaves the same table.

Fault tolerance: the stream's checkpoint and every table version live
under the shared folder named by ``spark.checkpoint.dir`` (or an explicit
shared root), never on a machine-local disk; a lost executor re-runs its
tasks, a lost driver resumes from the checkpoint, and a batch that fails
before its version is written leaves the current version in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelspark.plans import refresh as RF
from panelspark.session import checkpoint_dir
from panelspark.sources.tables import replace_table

MODES = ("upsert", "replace_dates", "append_distinct")


def _apply(mode: str, old: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
           date: str, value: str | None, overlap_days: int) -> DataFrame:
    if mode == "upsert":
        return RF.upsert(old, batch, keys, order, value=value)
    if mode == "replace_dates":
        return RF.replace_trailing_dates(old, batch, keys, date, overlap_days, late="keep")
    if mode == "append_distinct":
        return RF.append_new_days(old, batch, date, late="keep")
    raise ValueError(f"mode must be one of {MODES}")


def start_refresh(spark: SparkSession, landing: str, schema: T.StructType, table: str,
                  table_root: str, mode: str, keys: Sequence[str] = (), order: Sequence[str] = (),
                  date: str = "date", value: str | None = None, overlap_days: int = 1,
                  fmt: str = "json", checkpoint: str | None = None, options: dict | None = None,
                  table_schema: T.StructType | None = None, text_keys: Sequence[str] = (),
                  partitioned: bool = True):
    """Start (and return) a streaming query that refreshes ``table`` from
    files landing in ``landing``; ``query.awaitTermination()`` waits for
    the available files to be processed.  Rows that land late (older than
    the stored watermark) are taken like any other.

    The table is kept as a month-partitioned dataset at
    ``<table_root>/<table>``; a batch rewrites only the months it touches.
    With ``partitioned=False`` each batch writes a new full version of a
    catalog table (the source's drop-and-recreate, for small tables)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{table}"
    reader = spark.readStream.schema(schema).format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(landing)
    store_schema = table_schema or schema

    def refresh(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if partitioned:
            RF.refresh_partitioned(spark, f"{table_root.rstrip('/')}/{table}", batch, mode, keys, order,
                                   date, value, overlap_days,
                                   staging_root=f"{table_root.rstrip('/')}/_staging", late="keep")
            return
        if spark.catalog.tableExists(table):
            old = spark.table(table)
        else:
            old = spark.createDataFrame([], store_schema)
        new_state = _apply(mode, old, batch, keys, order, date, value, overlap_days)
        # the new version is written before the catalog is re-pointed, so
        # the version being read is never overwritten
        pk = () if mode == "append_distinct" else (
            list(keys) if date in keys else list(keys) + [date])
        replace_table(spark, new_state, table, table_root, store_schema, keys=pk,
                      text_keys=text_keys)

    return (stream.writeStream.foreachBatch(refresh)
                  .option("checkpointLocation", ckpt)
                  .trigger(availableNow=True)
                  .start())


def run_refresh(spark: SparkSession, *args, **kwargs) -> None:
    """Process every landed file not yet processed, then return."""
    q = start_refresh(spark, *args, **kwargs)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
