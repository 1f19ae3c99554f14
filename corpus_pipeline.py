"""A corpus from raw documents: five stages, each on all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; all but the last return
the columns of ``docs``. What a stage keeps is written to the shared folder and read again.

The stages take the rows that their operators take: null and empty texts pass all of them (the quality
stage judges an empty text by its statistics) and have no pieces; rows with a null id pass, near copies among them too, and
rows that repeat one id and text pass or go together. An empty table gives an empty one. Very long texts are worked on
whole. Further columns are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import (
    decontamination,
    minhash_dedup,
    privacy,
    quality_gbt,
    unigram_pieces,
)
from footfall.llm.tables import ship_package, table
from footfall.session import shared_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship_package(spark)
    return quality_gbt.good_documents(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8."""
    ship_package(spark)
    return minhash_dedup.one_of_each(docs, width=5, percent=80)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    ship_package(spark)
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that disclose it replaced."""
    ship_package(spark)
    return privacy.sanitised(docs)


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the pieces of the text, their number, and the text that they decode to."""
    ship_package(spark)
    return unigram_pieces.with_pieces(docs).selectExpr(
        "doc_id", "piece_ids", "size(piece_ids) n_pieces", "n_byte_pieces", "decoded"
    )


STAGES = [
    ("quality", good_quality),
    ("near_copies", one_of_near_copies),
    ("benchmarks", without_benchmarks),
    ("personal_data", without_personal_data),
    ("pieces", in_pieces),
]

#: SQL cannot express the classifier, the signatures and the pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after another."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
