"""Content-addressed WARC archive.

``write`` stores two tables: ``payloads`` holds the bytes of each payload once,
under its SHA-256, and ``headers`` holds the exact header block of every
record with the key of its payload.  Before a payload is stored, the SHA-1 and
length of all rows under its key must agree, and on reading the stored bytes
are hashed again; either mismatch raises.  ``read`` joins header blocks with
facts of the verified payloads (the bytes themselves do not move);
``reconstruct`` joins the bytes and returns the original records.

Of records with equal payloads of at least ``min_bytes`` bytes the one with
the largest id is the response and the others revisit it; smaller payloads are
all responses.

Edge cases: a null payload is empty; a null url leaves out its header line;
blanks inside a url are percent-encoded; rows that repeat the largest id are
all responses; a null id revisits if its group has an id, else it is a
response; an empty table gives empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.common import fresh_path, stored, type_of

MIN_BYTES = 0
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
# Fixed values of the WARC 1.1 format and of base 32.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ID_URN = "urn:page-id:"


@dataclass(frozen=True)
class Archive:
    headers: DataFrame   # id, header (string), key (SHA-256 hex)
    payloads: DataFrame  # key, payload (binary)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base 32 of the SHA-1: eight groups of 20 bits, each
    five hex digits and four letters."""
    digits = F.sha1(payload)
    letters = []
    for i in range(8):
        group = F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(group, s).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                    for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _header(date: str) -> Column:
    revisit = F.col("record_type") == "revisit"
    url = F.regexp_replace(F.regexp_replace("url", r"[\r\n]", "%0A"), r"\s", "%20")
    urn = lambda c: F.concat(F.lit(f"<{ID_URN}"), c.cast("string"), F.lit(">"))
    return F.concat_ws(
        "", F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", urn(F.coalesce(F.col("id").cast("string"), F.lit("none")))),
        F.lit(f"WARC-Date: {date}\r\n"), _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", urn(F.col("winner"))),
                                 F.lit(f"WARC-Profile: {PROFILE}\r\n"))),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string"))),
        F.lit("\r\n"))


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = MIN_BYTES, date: str = DATE, path: str | None = None) -> Archive:
    """Archive one record per row under ``path`` (default: a new shared folder)."""
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.withColumns({"key": F.sha2("payload", 256), "n": F.octet_length("payload").cast("bigint"),
                              "digest": base32_sha1(F.col("payload"))})

    same = (F.min("digest") == F.max("digest")) & (F.min("n") == F.max("n"))
    once = keyed.groupBy("key").agg(F.first("payload").alias("payload"), same.alias("same"))
    once.select("key", F.when(F.col("same"), F.col("payload")).otherwise(
        F.raise_error(F.lit("different payloads under one key")).cast("binary")).alias("payload")
    ).write.option("compression", "zstd").parquet(f"{path}/payloads")

    light = stored(keyed.select("id", "url", "key", "n", "digest"), "warc-rows")
    winners = (light.where(F.col("n") >= min_bytes).groupBy("key").agg(F.max("id").alias("winner"))
               .withColumnRenamed("key", "k"))
    # a hot payload is one winner against many rows: the adaptive skew join splits it
    typed = light.join(winners, F.col("key") == F.col("k"), "left").withColumn(
        "record_type", F.when((F.col("n") < min_bytes) | F.col("id").eqNullSafe(F.col("winner")),
                              F.lit("response")).otherwise(F.lit("revisit")))
    typed.select("id", _header(date).alias("header"), "key").write.option(
        "compression", "zstd").parquet(f"{path}/headers")
    return open_archive(spark, path, type_of(pages, id_col))


def open_archive(spark: SparkSession, path: str, id_type: str = "bigint") -> Archive:
    return Archive(spark.read.schema(f"id {id_type}, header string, key string").parquet(f"{path}/headers"),
                   spark.read.schema("key string, payload binary").parquet(f"{path}/payloads"))


def _verified(payloads: DataFrame) -> DataFrame:
    """Stored payloads whose bytes still hash to their key; else an error."""
    return payloads.select("key", F.when(F.sha2("payload", 256) == F.col("key"), F.col("payload")).otherwise(
        F.raise_error(F.lit("a stored payload does not match its digest")).cast("binary")).alias("payload"))


def field(header: Column, name: str) -> Column:
    """Value of a header line, or null."""
    value = F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(value != "", value)


def read(archive: Archive) -> DataFrame:
    """Per record ``id, record_type, refers_to, url, payload_bytes,
    payload_digest``: the last two from the stored, verified bytes."""
    facts = _verified(archive.payloads).select(
        F.col("key").alias("k"), F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"))
    header = F.col("header")
    id_type = type_of(archive.headers, "id")
    refers = F.regexp_extract(field(header, "WARC-Refers-To"), f"{ID_URN}([^>]*)", 1).cast(id_type)
    return archive.headers.join(facts, F.col("key") == F.col("k")).select(
        "id", field(header, "WARC-Type").alias("record_type"), refers.alias("refers_to"),
        field(header, "WARC-Target-URI").alias("url"), "payload_bytes", "payload_digest")


def reconstruct(archive: Archive) -> DataFrame:
    """Per record ``id``, the exact record bytes (a revisit has no block) and
    the full payload that it stands for."""
    end = F.lit("\r\n\r\n").cast("binary")
    header = F.col("header").cast("binary")
    block = F.when(field(F.col("header"), "WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return archive.headers.join(_verified(archive.payloads), "key").select(
        "id", F.concat(header, block, end).alias("record"), "payload")
