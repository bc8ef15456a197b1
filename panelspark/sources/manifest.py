"""Stored tables that change in one step (S6, S7, S8) and upserts that touch
only the files which can hold a key (K4, F5).

A version of a table is a *manifest*, a small JSON file written last: schema
with types, key, row count and where the list of data files stands.  Readers
take the newest whole manifest, so a write that ends between any two steps
leaves the version before it in place, also when the schema changes or rows
vanish.  Manifests are created exclusively (a store with atomic create, such as
HDFS, lets one of two writers win; the other one raises ``Conflict``).

The file list is itself a table: per file its zone, rows, least and greatest
key, and beside it a bit filter of its keys.  A zone is a range of keys fixed
when the table was replaced.  An upsert finds each key's zone by an ordered
scan over keys and zone starts, then the files of the zone whose range and
filter admit the key; only those are read and written anew.

Superseded files stay for readers of old versions; the store's retention
policy removes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.operators.joins import drop_keys
from panelspark.operators.scan import last_value, running_state
from panelspark.operators.setops import union_by_name
from panelspark.operators.window import first_per_key
from panelspark.sources.tables import conform, duplicate_keys, guard_passes, null_keys, stored, write_observed

FILTER_BITS = 1 << 16  # per file, kept as words of 64 bits
ZONE = "_zone"


class Conflict(RuntimeError):
    """Another writer committed this version first."""


@dataclass
class Manifest:
    version: int
    schema: str          # JSON of the table's schema
    keys: list[str]
    rows: int
    files: str | None    # Parquet table (zone, path, rows, lo, hi)
    filters: str | None  # Parquet table (path, word, bits)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


# ---- manifest files -----------------------------------------------------------

def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, root: str) -> list[int]:
    p, fs = _path(spark, f"{root}/manifests")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted((int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")), reverse=True)


def _load(spark: SparkSession, root: str, version: int) -> Manifest | None:
    rows = spark.read.text(f"{root}/manifests/v{version:020d}.json", wholetext=True).collect()
    try:
        return Manifest(**json.loads(rows[0][0])) if rows else None
    except (ValueError, TypeError):
        return None  # a write that was cut off: not a version


def current(spark: SparkSession, root: str) -> Manifest | None:
    """The newest whole manifest."""
    for v in _versions(spark, root):
        found = _load(spark, root, v)
        if found:
            return found
    return None


def commit(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Create the manifest file; raises ``Conflict`` if its version is taken."""
    p, fs = _path(spark, f"{root}/manifests/v{manifest.version:020d}.json")
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            raise Conflict(f"version {manifest.version} of {root} is taken") from e
        raise
    try:
        out.write(bytearray(json.dumps(asdict(manifest)).encode()))
    finally:
        out.close()


def _next(spark: SparkSession, root: str) -> int:
    return max([0, *_versions(spark, root)]) + 1


# ---- files and their index ----------------------------------------------------

def _bit(keys: Sequence[str]):
    h = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    return (F.shiftright(h, 6).cast("int").alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int")))


def _indexed(spark: SparkSession, path: str, schema: T.StructType,
             keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The index rows and filters of written zone folders, in one read each."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(ZONE, T.IntegerType())])).parquet(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias("path"))
    key = F.struct(*keys)
    files = rows.groupBy(F.col(ZONE).alias("zone"), "path").agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    word, bit = _bit(keys)
    return files, rows.groupBy("path", word).agg(F.bit_or(bit).alias("bits"))


def _written(df: DataFrame, root: str) -> tuple[str, dict]:
    """``df`` with its zone column as files of one zone each, counted on the way."""
    path = f"{root}/data/{uuid.uuid4().hex}"
    return path, write_observed(df, path, mode="errorifexists", partition_by=[ZONE])


def _kept(df: DataFrame, root: str, name: str) -> str:
    path = f"{root}/{name}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def read(spark: SparkSession, root: str, manifest: Manifest | None = None) -> DataFrame:
    """The table at its newest (or the given) version."""
    m = manifest or current(spark, root)
    if m is None:
        raise FileNotFoundError(f"no version of {root}")
    return read_files(spark, m, [r.path for r in spark.read.parquet(m.files).select("path").collect()] if m.files else [])


def read_files(spark: SparkSession, m: Manifest, paths: Sequence[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], m.struct)
    return spark.read.schema(m.struct).parquet(*paths)


def replace(spark: SparkSession, df: DataFrame, root: str, keys: Sequence[str], schema: T.StructType | None = None,
            text_keys: Sequence[str] = (), zones: int | None = None) -> Manifest:
    """Typed full replace.  Data, index and checks come first (key
    present and unique, types and row count as read back), the manifest last."""
    root, keys = root.rstrip("/"), list(keys)
    version = _next(spark, root)
    df = conform(df, schema, text_keys) if schema is not None else df
    parts = df.repartitionByRange(zones, *keys) if zones else df.repartitionByRange(*keys)
    path, figures = _written(parts.withColumn(ZONE, F.spark_partition_id()), root)
    files = filters = None
    if figures["rows"]:
        back = spark.read.parquet(path).drop(ZONE)
        _check(back, keys)
        want = {f.name: f.dataType for f in df.schema}
        got = {f.name: f.dataType for f in back.schema}
        index, bits = _indexed(spark, path, df.schema, keys)
        files, filters = _kept(index, root, "files"), _kept(bits, root, "filters")
        rows = spark.read.parquet(files).agg(F.sum("rows")).first()[0]
        if got != want or rows != figures["rows"]:
            raise ValueError(f"read back {rows} rows of {got}, wrote {figures['rows']} of {want}")
    m = Manifest(version, df.schema.json(), keys, figures["rows"], files, filters)
    commit(spark, root, m)
    return m


def _check(df: DataFrame, keys: Sequence[str]) -> None:
    if duplicate_keys(df, keys).limit(1).count() or null_keys(df, keys).limit(1).count():
        raise ValueError(f"key {tuple(keys)} violated")


def _zoned(batch: DataFrame, index: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``batch`` with the zone of each key: the last zone that starts at or
    before it (the first zone for keys before all).  An ordered scan over keys
    and zone starts, spread over tasks."""
    starts = index.groupBy("zone").agg(F.min("lo").alias("lo")).select("lo.*", "zone", F.lit(0).alias("_kind"))
    keyed = batch.select(*keys, F.lit(None).cast("int").alias("zone"), F.lit(1).alias("_kind"))
    located = running_state(starts.select(*keys, "zone", "_kind").unionByName(keyed).withColumn("_all", F.lit(0)),
                            ["_all"], [*keys, "_kind"], {ZONE: last_value("zone")})
    first = index.agg(F.min(F.struct("lo", "zone"))["zone"]).scalar()
    return located.where("_kind = 1").select(*keys, F.coalesce(F.col(ZONE), first).alias(ZONE))


def touched_files(located: DataFrame, index: DataFrame, filters: DataFrame, keys: Sequence[str]) -> list[str]:
    """Files that can hold one of the located keys; the list is bounded by the
    files of the zones the batch falls into."""
    word, bit = _bit(keys)
    asked = located.select(ZONE, F.struct(*keys).alias("k"), word, bit.alias("bit"))
    near = asked.join(index, asked[ZONE] == index["zone"]).where("k >= lo and k <= hi").select("path", "word", "bit")
    hit = near.join(filters, ["path", "word"]).where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
    return sorted(r.path for r in hit.select("path").distinct().collect())


def upsert(spark: SparkSession, root: str, batch: DataFrame, order: Sequence[str], value: str | None = None) -> Manifest:
    """K4: the batch wins by key.  The batch is written once and counted (A12
    guard); untouched files are neither read nor written."""
    root = root.rstrip("/")
    m = current(spark, root)
    if m is None:
        raise FileNotFoundError(f"no version of {root}")
    version, keys, names = _next(spark, root), m.keys, m.struct.names
    stage = f"{root}/staged/{uuid.uuid4().hex}"
    fresh = conform(first_per_key(batch, keys, order), m.struct)
    figures = write_observed(fresh, stage)
    if not guard_passes(figures):
        return m
    fresh = spark.read.schema(m.struct).parquet(stage)
    if null_keys(fresh, keys).limit(1).count():
        raise ValueError(f"key {tuple(keys)} violated")
    if not m.files:
        return replace(spark, fresh.filter(F.col(value) > 0) if value else fresh, root, keys)
    index, filters = spark.read.parquet(m.files), spark.read.parquet(m.filters)
    located = stored(_zoned(fresh, index, keys), "located")
    touched = touched_files(located, index, filters, keys)
    zone_of = F.broadcast(index.where(F.col("path").isin(touched)).select("path", F.col("zone").alias(ZONE)))
    old = read_files(spark, m, touched)
    if touched:
        old = old.select("*", F.col("_metadata.file_path").alias("path")).join(zone_of, "path").drop("path")
        kept = drop_keys(old, fresh, keys, null_safe=False)
        out = union_by_name(kept, fresh.join(located, keys))
    else:
        out = fresh.join(located, keys)
    out = out.filter(F.col(value) > 0) if value else out
    path, written = _written(out.select(*names, ZONE).repartitionByRange(ZONE, *keys), root)
    index, filters = (x.where(~F.col("path").isin(touched)) for x in (index, filters))
    if written["rows"]:
        more, bits = _indexed(spark, path, m.struct, keys)
        index, filters = index.unionByName(more), filters.unionByName(bits)
    files, kept_filters = _kept(index, root, "files"), _kept(filters, root, "filters")
    rows = spark.read.parquet(files).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    new = Manifest(version, m.schema, keys, rows, files if rows else None, kept_filters if rows else None)
    commit(spark, root, new)
    return new
