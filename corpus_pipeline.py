"""From raw documents to packed sequences: each stage takes what the one before kept, as a table with documents' columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmine.llm import mixing, near_copies, packing, pii, toxicity
from quillmine.llm.common import stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from those labelled documents that are in docs."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (SimHash candidates, five-word shingles with a similarity of 0.8 or more) one document stays."""
    return near_copies.deduplicated(docs)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in brackets."""
    return pii.without_personal_data(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents cut, left out or repeated so that sources meet their target weights."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their ids."""
    return packing.pack(docs)


STAGES = [("toxicity", toxicity_stage), ("near_duplicates", near_duplicate_stage), ("personal_data", personal_data_stage), ("mixing", mixing_stage), ("packing", packing_stage)]

#: Fingerprints, trained models and hash permutations are beyond SQL; tests hold each stage against plain code instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        # written and read again, so that no stage computes the ones before it anew
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
