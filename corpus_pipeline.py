"""From raw documents to packed training sequences, stage by stage.

Every stage takes all rows its predecessor kept and, but for the last, returns the
columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmill.llm.decontaminate import contaminated
from lossmill.llm.documents import keyed, plain_ids, rows_of
from lossmill.llm.minhash_dedup import near_duplicates
from lossmill.llm.packing import pack_documents
from lossmill.llm.quality import accepted, train
from lossmill.llm.queries import tokenizer_path
from lossmill.llm.shipping import ship
from lossmill.llm.substring_dedup import remove_repeated_words
from lossmill.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on their labels, does not reject.

    Each row is judged by its own text; rows without an id or with a repeated one take
    no part in the fit where their label is unclear, but are judged like all others.
    An empty table stays empty.
    """
    ship(spark)
    return accepted(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the one with the smallest id; texts without words all stay."""
    ship(spark)
    texts = keyed(docs)
    return rows_of(docs, texts, near_duplicates(texts, has_keys=True).where("kept"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand earlier; a text that loses nothing stays as it is."""
    ship(spark)
    texts = keyed(docs)
    # Names that no column of the documents has.
    longest = max(map(len, docs.columns))
    shorter_text, own_id, own_text = (name.ljust(longest + 1, "_") for name in ("shorter_text", "own_id", "own_text"))
    found = remove_repeated_words(texts, has_keys=True).where("removed > 0")
    shorter = found.select("key", F.col("kept").cast("string").alias(shorter_text))
    if plain_ids(texts):
        joined = docs.join(shorter.withColumnRenamed("key", "doc_id"), "doc_id", "left")
    else:
        changed = texts.join(shorter, "key").select(F.col("doc_id").alias(own_id), F.col("text").alias(own_text), shorter_text)
        once = docs.dropDuplicates(["doc_id", "text"])
        same = once["doc_id"].eqNullSafe(changed[own_id]) & once["text"].eqNullSafe(changed[own_text])
        joined = once.join(changed, same, "left")
    text = F.coalesce(shorter_text, "text")
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col(shorter_text).isNull(), F.col("n_chars")).otherwise(F.length(shorter_text))
    return joined.select(*(columns[c].cast(t).alias(c) if c in columns else F.col(c) for c, t in docs.dtypes))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship(spark)
    texts = keyed(docs)
    found = contaminated(texts, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), has_keys=True)
    found = cut_lineage(found.select("key").distinct())
    if plain_ids(texts):
        return docs.join(found.withColumnRenamed("key", "doc_id"), "doc_id", "left_anti")
    return rows_of(docs, texts, texts.join(found, "key", "left_anti"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and their place in a sequence."""
    ship(spark)
    return pack_documents(docs, tokenizer_path(), end_id=2)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL has no conditional random field and no tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
