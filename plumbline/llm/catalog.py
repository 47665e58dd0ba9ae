"""The registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import byte_bpe, centroids, decontaminate, exact_dedup, html_text, jaccard_join, language, licenses, line_dedup, secrets, spellings, substrings, toxicity
from plumbline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.span_digests(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return decided.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).drop("key", "component")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digests(licenses.scan_licenses(table(spark, sf_dir, "documents")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), F.col("lang").alias("lang_pred"), "score")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame) -> DataFrame:
    """Digests of the ids of each text and of the bytes that these ids decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.decode(byte_bpe.encode(docs, path, public_tokenizers.PATTERN), path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", F.sha2(F.array_join("centroid", ","), 256)).drop("centroid")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.substring_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.group_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_decontaminate": op2_decontaminate,
        "op3_secret_scan": op3_secret_scan,
        "op4_html_text": op4_html_text,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_license_scan": op6_license_scan,
        "op7_toxicity": op7_toxicity,
        "op8_language_id": op8_language_id,
        "op9_line_dedup": op9_line_dedup,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_centroid_clustering": op11_centroid_clustering,
        "op12_substring_dedup": op12_substring_dedup,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard": jaccard_join.SQL,
        "op2_decontaminate": decontaminate.SQL,
        "op5_exact_dedup": exact_dedup.SQL,
        "op11_centroid_clustering": centroids.sql(),
        "op12_substring_dedup": substrings.SQL,
        "op13_spelling_variants": spellings.SQL,
    }
