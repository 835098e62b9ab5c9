"""A corpus from raw documents to token ids, as stages that each write a table.

Every stage takes the session, the documents its predecessor kept and the folder of
the input tables, and returns a frame. All but the last return the columns of
documents. Each result is written as Parquet in the shared folder and read again, so
a lost executor repeats one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.llm import mixing, pu_classifier, secret_scan, sentencepiece_tokens, simhash
from larder.llm.common import read, stored

# Learned models, graph walks and token ids are not expressible in SQL; the stages
# are tested against brute force instead.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return pu_classifier.accepted(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return simhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by marks."""
    return secret_scan.redact(docs, length_column="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves the sources to their target weights."""
    return mixing.in_mix_order(docs)


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document with its place in the mix, round trip and parity verified.

    Files are not read back in the order of their rows, so the mix is the order by
    slot, offset and doc_id. Places depend on ids, sources and texts only.
    """
    placed = mixing.with_place(docs, ["doc_id", "text"])
    return sentencepiece_tokens.encode(placed, others=("slot", "offset"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", to_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the last one's rows."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
