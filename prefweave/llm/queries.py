"""Registered queries of the subpackage: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from prefweave.llm import (ann, codes, decontaminate, htmltext, language, licenses, linededup, ngram_join, packing,
                           quality, secrets, urls, whitening)
from prefweave.llm.oracle import ORACLE_SQL  # noqa: F401  (registered by the entry point)
from prefweave.llm.tables import read

QUERY_EVERY = 20               # ids divisible by this are the queries of the search


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan_secrets(read(spark, sf, "documents"))


def secret_base_spans(spark: SparkSession, sf: str) -> DataFrame:
    """The scan's base findings alone, which SQL can state."""
    return op1_secret_scan(spark, sf).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify_languages(read(spark, sf, "documents"))


def op3_hash_prefix_forest(spark: SparkSession, sf: str) -> DataFrame:
    vectors = read(spark, sf, "embeddings")
    return ann.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0), k=20)


def op4_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf, "documents"), k=4, percent=85)


def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return linededup.dedup_lines(read(spark, sf, "documents")).select(
        "doc_id", "text", "n_lines", "n_removed", "removed")


def op6_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(read(spark, sf, "documents"))


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_contamination(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op8_quality_mil(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_quality(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op9_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return htmltext.extract_main_text(read(spark, sf, "pages"))


def op10_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf, "documents"))


def op11_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.filter_urls(read(spark, sf, "pages"))


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return codes.compress(read(spark, sf, "embeddings"))


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(read(spark, sf, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_secret_scan, op2_language_id, op3_hash_prefix_forest, op4_ngram_jaccard_join, op5_line_dedup,
    op6_best_fit_packing, op7_decontamination, op8_quality_mil, op9_html_extraction, op10_license_scan,
    op11_url_filter, op12_vector_codes, op13_embedding_whitening, secret_base_spans)}
