"""The registered queries of this subpackage and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat.llm import alignment, collection_bwt, edit_fingerprints, language_id, license_scan, manifest, mixing, near_dedup, packing, permutation_index, substring_dedup, token_counts, url_filter
from clipstat.llm.common import table
from clipstat.llm.tokens import tokenizer_path


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.identified(docs.select("doc_id", "text"), language_id.learned(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "_lang.lang_pred", "_lang.score")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents"), license_scan.given_templates(spark))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), url_filter.rules(spark))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints.fingerprinted_classes(table(spark, sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    m = F.col("_mix")
    return mixing.mix(docs).select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"), (m["size"] * m["copies"]).alias("taken")
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op11_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = collection_bwt.without_repeated_bytes(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op4_minhash": op4_minhash,
    "op1_language": op1_language,
    "op2_licenses": op2_licenses,
    "op3_urls": op3_urls,
    "op5_fingerprints": op5_fingerprints,
    "op6_neighbours": op6_neighbours,
    "op7_mixing": op7_mixing,
    "op8_packing": op8_packing,
    "op9_substring": op9_substring,
    "op10_token_counts": op10_token_counts,
    "op11_suffix_array": op11_suffix_array,
    "op12_manifest": op12_manifest,
    "op13_alignment": op13_alignment,
}
CHECKS: dict[str, str] = {"op3_urls": url_filter.URL_SQL, "op7_mixing": mixing.MIX_SQL, "op12_manifest": manifest.MANIFEST_SQL}
