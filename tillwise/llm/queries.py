"""The queries of this subpackage: each takes (spark, data_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillwise.llm import (
    decontaminate,
    filter_audit,
    language_id,
    license_scan,
    line_quality,
    mixing,
    ngram_lm,
    pii,
    secret_scan,
    simhash,
    token_counts,
    token_files,
    vector_codes,
)
from tillwise.llm.shared import id_remainder


def _table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = _table(spark, data_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    model = language_id.train(docs.where(~held_out))
    predicted = language_id.predictor(docs, model)(F.col("text"))
    return docs.select("doc_id", held_out.alias("held_out"), predicted.alias("p")).select("doc_id", "held_out", "p.*")


def op2_decontaminate(spark: SparkSession, data_dir: str) -> DataFrame:
    return decontaminate.overlaps(_table(spark, data_dir, "documents"), _table(spark, data_dir, "benchmark"))


def op3_line_quality(spark: SparkSession, data_dir: str) -> DataFrame:
    return line_quality.check(_table(spark, data_dir, "documents"), _table(spark, data_dir, "labels"))


def op4_pii(spark: SparkSession, data_dir: str) -> DataFrame:
    return pii.scan(_table(spark, data_dir, "documents"))


def op5_token_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    return token_counts.attribute(_table(spark, data_dir, "documents"))


def op6_mixing(spark: SparkSession, data_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, data_dir, "documents"))


def op7_secret_scan(spark: SparkSession, data_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, data_dir, "documents"))


def op8_license_scan(spark: SparkSession, data_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, data_dir, "documents"))


def op9_simhash(spark: SparkSession, data_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, data_dir, "documents"))


def op10_ngram_lm(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = _table(spark, data_dir, "documents")
    return ngram_lm.score(docs, id_remainder(F.col("doc_id"), 7) == 2)


def op11_vector_codes(spark: SparkSession, data_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, data_dir, "embeddings"))


def op12_token_files(spark: SparkSession, data_dir: str) -> DataFrame:
    return token_files.write_and_read(_table(spark, data_dir, "documents"))


def op13_filter_audit(spark: SparkSession, data_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, data_dir, "documents"), _table(spark, data_dir, "labels"))


def pipeline(spark: SparkSession, data_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, data_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_decontaminate": op2_decontaminate,
    "op3_line_quality": op3_line_quality,
    "op4_pii": op4_pii,
    "op5_token_counts": op5_token_counts,
    "op6_mixing": op6_mixing,
    "op7_secret_scan": op7_secret_scan,
    "op8_license_scan": op8_license_scan,
    "op9_simhash": op9_simhash,
    "op10_ngram_lm": op10_ngram_lm,
    "op11_vector_codes": op11_vector_codes,
    "op12_token_files": op12_token_files,
    "op13_filter_audit": op13_filter_audit,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op6_mixing": mixing.ORACLE,
    "op7_secret_scan": secret_scan.ORACLE,
    "op8_license_scan": license_scan.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
