"""The thin queries op1 to op13: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmine.llm import bucketing, fingerprints, language, media, mixing, packing, pii, quality, repair, simhash, suffix_tree, toxicity, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = media.media_columns(_table(spark, sf_dir, "documents"), with_media=False)
    return rows.select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", media.landmark_text(F.col("times"), F.col("codes")).alias("feature")
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padded_length")


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scored(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixture(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", mixing.slot_text(F.col("takes")).alias("slots"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_table(spark, sf_dir, "documents"))
    return found.withColumn("spans", pii.spans_as_text(F.col("spans")))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(_table(spark, sf_dir, "pages"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("n_lines", "n_letters", "n_upper", "n_digits", "n_marks", "n_distinct", "n_bare")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return repair.report(repair.damaged(conversations), conversations)


def op13_co_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucketing.co_bucketed(spark, _table(spark, sf_dir, "sales"), _table(spark, sf_dir, "sale_lines"), bucketing.new_folder(spark))


QUERIES = {f.__name__: f for f in (op1_media_columns, op2_suffix_tree, op3_simhash, op4_mixing, op5_packing, op6_language, op7_personal_data, op8_url_filter, op9_fingerprints, op10_toxicity, op11_quality_rules, op12_conversation_repair, op13_co_bucketed)}
#: The other operators rest on hashes, models or tokenizers that SQL lacks; tests hold them against plain code.
ORACLE_SQL: dict[str, str] = {"op9_fingerprints": fingerprints.compared_sql()}
