"""The operators of this package as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (
    filter_audit, html_extract, importance_resampling, license_scan, mixing, pii, pu_classifier, quality_rules, secret_scan,
    sentencepiece_tokens, simhash, vptree, warc,
)
from larder.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(read(spark, folder, "documents"))


def op2_sentencepiece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_tokens.encode(read(spark, folder, "documents"))


def op3_pii_sanitisation(spark: SparkSession, folder: str) -> DataFrame:
    return pii.scan(read(spark, folder, "documents"))


def op4_mixing_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(read(spark, folder, "documents"))


def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(read(spark, folder, "pages"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return pu_classifier.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(read(spark, folder, "pages"))


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings")
    return vptree.nearest(vectors, vectors.where(F.col("vec_id") % vptree.QUERY_EVERY == 0))


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance_resampling.resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op12_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op13_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(read(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    found = (
        op1_secret_scans, op2_sentencepiece_encoding, op3_pii_sanitisation, op4_mixing_sources, op5_html_extraction,
        op6_quality_rules, op7_quality_classifier, op8_warc, op9_simhash_near_dedup, op10_nearest_neighbours,
        op11_importance_resampling, op12_filter_interactions, op13_license_scans,
    )
    return {f.__name__: f for f in found}
