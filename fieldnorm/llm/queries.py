"""The operators as registered queries over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnorm.llm.decontaminate import contamination
from fieldnorm.llm.language import fold, identify, learn
from fieldnorm.llm.language_model import score_texts
from fieldnorm.llm.licenses import license_scan
from fieldnorm.llm.lines import line_report
from fieldnorm.llm.main_text import extract
from fieldnorm.llm.main_text import learn as learn_pages
from fieldnorm.llm.middle import fill_in_middle, restored
from fieldnorm.llm.near_dedup import near_duplicates
from fieldnorm.llm.packing import pack_documents
from fieldnorm.llm.quality import quality_rules
from fieldnorm.llm.shards import shard_places
from fieldnorm.llm.substrings import without_repeats
from fieldnorm.llm.vector_codes import vector_codes

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated"
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    found = identify(docs, learn(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), size=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 1, F.lit(False))
    return score_texts(table(spark, sf_dir, "documents"), held_out, least=2)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, learn_pages(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = line_report(table(spark, sf_dir, "documents"))
    return report.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = shard_places(table(spark, sf_dir, "documents"), 8)
    return places.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings")).drop("label")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_language_id": op2_language_id,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_quality_rules": op5_quality_rules,
    "op6_html_extraction": op6_html_extraction,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_packing": op10_packing,
    "op11_sharding": op11_sharding,
    "op12_vector_codes": op12_vector_codes,
    "op13_fill_in_middle": op13_fill_in_middle,
}
