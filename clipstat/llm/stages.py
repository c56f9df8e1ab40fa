"""The operators as stages of a corpus pipeline.

A stage takes ``(spark, docs, sf_dir)`` and returns documents again (doc_id, text, lang, source, n_chars);
only packing, the last, returns its pieces. Nulls in any column, empty texts, repeated rows and empty
tables pass through as the operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat.llm import language_id, mixing, near_dedup, packing, substring_dedup
from clipstat.llm.tokens import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = "byte_bpe_50k.json"


def documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language (null or without a letter); fills a missing lang.

    A low score is no ground to drop: very short clean texts have one too. Where no language can be learned
    (no labelled text), every document with a letter stays as it is.
    """
    docs = documents(docs)
    network = language_id.learned(docs)
    if not network.langs:
        return docs.filter(language_id.has_letter(F.col("text")))
    found = language_id.identified(docs, network)
    known = F.col("_lang.lang_pred") != language_id.UNKNOWN
    return documents(found.filter(known).withColumn("lang", F.coalesce("lang", "_lang.lang_pred")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest document of each group of near-duplicates, one row of it, and one of equal rows.

    Rows that share a doc_id are judged by their texts; rows without an id go where a document is like them.
    """
    docs = documents(docs)
    found = near_dedup.near_duplicates(docs, marked=True)
    least = found.filter("near_group is not null").groupBy("near_group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.col("mark").alias("own"))).alias("least")
    )
    kept = least.select("least.id", "least.own").unionByName(
        found.filter("near_group is null").select(F.col("doc_id").alias("id"), F.col("mark").alias("own")).distinct()
    )
    met = docs.withColumn("mark", near_dedup.text_mark()).join(kept, F.expr("doc_id <=> id and mark = own"), "left_semi")
    return documents(met.dropDuplicates(["doc_id", "text"]))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages that an earlier document has; a document left without words goes."""
    kept = substring_dedup.without_repeats(documents(docs), carry=("lang", "source", "n_chars"), rejoin=False)
    kept = kept.filter("n_removed = 0 or n_removed < n_words")
    changed = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars"))
    return documents(kept.withColumn("n_chars", changed).withColumnRenamed("kept_text", "text"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each document as often as its source's target weight asks."""
    return documents(mixing.emitted(mixing.mix(documents(docs))))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.packed(docs, tokenizer_path(VOCABULARY))
