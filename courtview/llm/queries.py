"""The registered queries of the operators: thin, over whole tables, with the columns their contracts fix."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtview.llm import (benchmark_decontam, centroid_clustering, lexical_search, license_scan, line_dedup, mixing, quality_gam, secret_scan, sharding,
                           simhash_dedup, suffix_dedup, topk_search, warc_archive)
from courtview.llm.common import read_table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.exact_top_k(read_table(spark, sf_dir, "embeddings"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("spans")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.hilbert_shards(read_table(spark, sf_dir, "documents"))


def op8_benchmark_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_dedup.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op10_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.clusters_with_inertia(*centroid_clustering.cluster_vectors(read_table(spark, sf_dir, "embeddings")))


def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_archive.archived_pages(read_table(spark, sf_dir, "pages"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_line_dedup, op2_mixing, op3_secret_scan, op4_topk_search, op5_license_scan, op6_suffix_dedup, op7_sharding, op8_benchmark_decontam,
    op9_simhash_dedup, op10_quality_gam, op11_centroid_clustering, op12_warc_archive, op13_lexical_search, pipeline)}
