"""Small literal tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tillwise.domains import AMOUNT_RANGES, CATEGORY_MASTER
from tillwise.schema import BENCHMARK_REPORT


def category_master(
    spark: SparkSession, rows: Iterable[tuple[str, str, int]] = CATEGORY_MASTER
) -> DataFrame:
    """(category, category_group, priority)"""
    return spark.createDataFrame(list(rows), ["category", "category_group", "priority"])


def amount_ranges(
    spark: SparkSession, rows: Iterable[tuple[str, int, int]] = AMOUNT_RANGES
) -> DataFrame:
    """(category, min_amount, max_amount), both ends allowed"""
    return spark.createDataFrame(
        list(rows), "category string, min_amount bigint, max_amount bigint"
    )


def benchmark_rows(spark: SparkSession, rows: Iterable[tuple[str, float, str]]) -> DataFrame:
    """(test_name, elapsed_sec, detail)"""
    return spark.createDataFrame(list(rows), BENCHMARK_REPORT)
