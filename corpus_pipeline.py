"""From raw documents to a training mix, in five stages.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is
written as Parquet and read again, so a lost executor repeats one stage at most.
All but the last return the columns of `documents`.

Defined cases: a null or empty text is rejected by the first stage (too few words), and a
stage that gets one treats it as empty; of repeated rows one stays after the second stage; ties (which
document of a group stays, where the mix ends) go by id, then by a hash of the text; null ids
are ids like any other; extra columns are carried along whatever their names; an empty table
gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import decontaminate, line_quality, mixing, secret_scan, simhash
from tillwise.sinks.scratch import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return line_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    return simhash.without_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text, and n_chars follows; no document goes."""
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their weights: the documents taken, with their copies."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality rules", good_quality),
    ("near duplicates", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scan", secrets_masked),
    ("mixing", mixed),
]

#: The quality stage decodes a trained field, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
