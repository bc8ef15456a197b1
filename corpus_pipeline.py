"""Corpus pipeline: five stages, each written as Parquet and reread.

toxicity rejects the documents that score 0.5 or more; line dedup cuts
boilerplate lines out of the texts; near dedup keeps one document of each
SimHash component; decontamination drops the documents that hold a benchmark
item; BPE gives token counts and digests of what is left.  All stages but the
last return the columns of ``documents`` (``n_chars`` follows the text).

Nulls, empty texts, repeated rows and empty tables have the results that the
operators' docstrings define; labels and benchmark rows are read from
``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from panelspark.llm.common import stored, table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5.  The model is learned from the table of
    all documents, as in the operator's own query."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=True).where("__score < 0.5").select(docs.columns)


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source, whatever share of
    a text they are; a text of such lines alone stays for near dedup."""
    out = line_dedup.drop_lines(docs, max_loss=None)
    if "n_chars" not in docs.columns:
        return out
    n = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.coalesce(n, F.col("n_chars")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    return bpe.token_digests(docs)


STAGES = [("toxicity", toxicity_filter), ("line_dedup", line_filter), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("bpe", bpe_tokens)]

# No SQL expresses the trained and hashed stages: a test holds run() against
# plain Python for lines, fingerprints and tokens, given the trained decisions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
