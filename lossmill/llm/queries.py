"""Registered queries of the corpus operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .decontaminate import contaminated
from .documents import read_documents
from .licenses import license_matches
from .minhash_dedup import near_duplicates
from .packing import pack_documents
from .periodic_runs import periodic_runs
from .ppm import language_scores
from .quality import THRESHOLD, scored, train
from .scalar_clusters import centroid_clusters
from .set_join import similar_sets
from .shipping import ship
from .substring_dedup import remove_repeated_words
from .suffix_dedup import remove_repeated_bytes
from .token_files import read_token_files, write_token_files
from .vector_search import nearest_neighbours

#: Vocabulary file of the token queries.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return near_duplicates(read_documents(spark, folder), length=3, percent=85).drop("key")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    found = remove_repeated_words(read_documents(spark, folder))
    return found.select(
        "doc_id", F.col("size").alias("n_words"), F.col("removed").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_language_scores(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return language_scores(read_documents(spark, folder), across=True)


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    found = remove_repeated_bytes(read_documents(spark, folder))
    return found.select(
        "doc_id",
        F.col("size").alias("n_bytes"),
        F.col("removed").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return contaminated(read_documents(spark, folder), benchmark).drop("key")


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return pack_documents(read_documents(spark, folder), tokenizer_path(), end_id=2, with_ids=False).drop("ids")


def op7_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    docs, labels = read_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = scored(docs, train(docs, labels))
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    path = scratch_path(spark, "tokens")
    write_token_files(read_documents(spark, folder), path, tokenizer_path(), end_id=1)
    return read_token_files(spark, path, with_ids=False)


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_matches(read_documents(spark, folder))


def op11_set_join(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return similar_sets(read_documents(spark, folder), length=3, percent=90).select("doc_id", "n_shingles", "component_id")


def with_cycles(docs: DataFrame) -> DataFrame:
    """The texts with the tails of some repeated in cycles, as the contract of the query wants them.

    A tenth of the documents, chosen by the CRC-32 of the id, repeat a piece of
    their words from some word on; other texts, and those without an id, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    parts = docs.select("doc_id", "text", h.alias("h"), F.when(chosen, words).alias("words"))
    parts = parts.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    filled = F.col("words").isNotNull() & (F.col("n") > 0)
    start = F.when(filled, (F.col("g") % F.col("n")).cast("int")).alias("a")
    parts = parts.select("doc_id", "text", "words", "n", "g", start)
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int").alias("p")
    parts = parts.select("doc_id", "text", "words", "n", "a", period)
    turns = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), turns))
    made = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), F.col("n") - F.col("a")))
    return parts.select("doc_id", F.coalesce(F.when(F.col("a").isNotNull(), F.array_join(made, " ")), "text").alias("text"))


def period_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the one with the largest exact exponent, and digests of all runs and of what is left."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    larger = lambda best, r: F.when(best.isNull() | (r.length * best.period > best.length * r.period), r).otherwise(best)
    line = lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    found = found.withColumn("best", F.aggregate("runs", none, larger))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return period_digests(periodic_runs(with_cycles(read_documents(spark, folder))))


def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    found = centroid_clusters(spark.read.parquet(f"{folder}/embeddings.parquet"))
    text = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.withColumn("centroid_sha256", F.sha2(text, 256)).drop("centroid")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_minhash_dedup,
        op2_substring_dedup,
        op3_language_scores,
        op4_suffix_dedup,
        op5_decontamination,
        op6_packing,
        op7_vector_search,
        op8_quality,
        op9_token_files,
        op10_licenses,
        op11_set_join,
        op12_periodic_runs,
        op13_centroid_clusters,
    )
    return {f.__name__: f for f in found}
