"""Rows of a document table as keyed texts, whatever their ids look like."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def keyed(docs: DataFrame) -> DataFrame:
    """Columns key, doc_id, text: one row per document, key unique and never NULL.

    Other columns are ignored. Where ids are unique and present, the key is the
    id. Otherwise a row that repeats both id and text is the same document once
    more and counts once; different texts under one id, or without an id, are
    documents of their own, ordered by id (NULL last) and text.
    """
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    repeated = (
        columns.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull()).limit(1).count()
    )
    if not repeated:
        return columns.select(F.col("doc_id").alias("key"), "doc_id", "text")
    ordered = columns.distinct().orderBy(F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first())
    return cut_lineage(ordered.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"))


def rows_of(docs: DataFrame, keyed_docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of a document table, all columns, whose key is among `keys` (column key)."""
    if plain_ids(keyed_docs):
        return docs.join(keys.select(F.col("key").alias("doc_id")), "doc_id", "left_semi")
    chosen = keyed_docs.join(keys.select("key"), "key", "left_semi").select("doc_id", "text")
    once = docs.dropDuplicates(["doc_id", "text"])
    same = once["doc_id"].eqNullSafe(chosen["doc_id"]) & once["text"].eqNullSafe(chosen["text"])
    return once.join(chosen, same, "left_semi")


def plain_ids(docs: DataFrame) -> bool:
    """Whether keys made by `keyed` are the ids themselves."""
    return not docs.where(~F.col("key").eqNullSafe(F.col("doc_id"))).limit(1).count()
