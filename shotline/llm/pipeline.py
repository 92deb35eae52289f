"""Raw documents to training sequences: five stages, each on all that the one before it kept.

All stages take nulls in any column, empty and very long texts, repeated rows, empty tables
and extra columns; what they do with them is said at each.  All but the last leave the
columns as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import decontaminate, minhash, packing, pii, quality
from .common import BROADCAST_ROWS, discard, settle


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects.

    Null and empty texts are scored like any other; of documents without labels, or with
    labels of one class only, all are kept.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.held_out())
    return quality.keep_good(docs, quality.learn(docs, labels))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the least doc_id, of each group of near-duplicates.

    Of rows that repeat both doc_id and text, the least (by all columns that can be ordered) stays.
    Texts without words, and rows without a doc_id, have no duplicates and all stay.
    """
    named = minhash.near_duplicates(docs, percent=80)
    gone = named.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    gone = F.broadcast(gone) if gone.count() < BROADCAST_ROWS else gone
    first = docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti")
    # Only ids that come more than once are brought together, and their rows are reduced before they are.
    twice = named.where("doc_id is not null").groupBy(F.col("doc_id").alias("_twice")).count().where("count > 1").select("_twice")
    twice = settle(twice)
    if twice.isEmpty():
        return first
    small = F.broadcast(twice) if twice.count() < BROADCAST_ROWS else twice
    row = F.struct(*docs.columns)
    ordered = [c for c in docs.columns if not isinstance(docs.schema[c].dataType, (T.MapType, T.VariantType))]
    often = first.join(small, first["doc_id"] == F.col("_twice")).groupBy("_twice", F.col("text").alias("_same")).agg(F.min_by(row, F.struct(*ordered)).alias("_row")).select("_row.*")
    return first.join(small, first["doc_id"] == F.col("_twice"), "left_anti").unionByName(often)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows whose text holds a near copy of a benchmark item, rows without a doc_id included."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; null and clean texts stay as they are."""
    return pii.redact(docs, pii.learn(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row for each piece of a document, with its ids.  A null or empty text is the end mark alone."""
    return packing.pack(docs, with_ids=True)


STAGES = [("quality classifier", keep_good), ("near-duplicates", keep_first), ("decontamination", keep_clean), ("personal data", redact), ("packing", pack)]
#: SQL has neither the classifier nor the field nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        done, docs = docs, settle(stage(spark, docs, sf_dir))
        discard(done)
    return docs
