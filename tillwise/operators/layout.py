"""Layout and tuning: lookups, reuse of a cached frame, repartitioning, profiles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.calendar_cols import between_times
from tillwise.operators.explore import category_rollup
from tillwise.sinks.scratch import materialize

# Partition counts to compare, as set for a cluster of 8 cores
REPARTITION_COUNTS = (1, 4, 8, 16, 50, 200)
REPARTITION_CORES = 8


def lookup_day(df: DataFrame, day: str) -> DataFrame:
    """One day by the `txn_date` column: prunes folders where that is the layout."""
    return df.filter(F.col("txn_date") == day)


def lookup_day_by_time(df: DataFrame, day: str, next_day: str) -> DataFrame:
    """One day as a time range, which an unpartitioned Parquet scan can skip by."""
    return between_times(df, day, next_day)


def lookup_month(df: DataFrame, year: int, month: int) -> DataFrame:
    return df.filter((F.col("txn_year") == year) & (F.col("txn_month") == month))


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """`df` kept in memory, spilling to disk, and released at the end."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def scaled_counts(spark: SparkSession, counts: Iterable[int] = REPARTITION_COUNTS) -> list[int]:
    """The counts at the same number of tasks per core as on the 8-core cluster.

    Never below 2, so that the data does not pass through a single task.
    """
    cores = spark.sparkContext.defaultParallelism
    return sorted({max(2, -(-n * cores // REPARTITION_CORES)) for n in counts})


def repartition_rollups(df: DataFrame, counts: Iterable[int]) -> DataFrame:
    """The category roll-up after a round-robin repartition to each count. Its two columns
    are written once, so what is above `df` is not repeated for every count."""
    narrow = materialize(df.select("category", "amount"), "repartition-input")
    runs = [
        category_rollup(narrow.repartition(n)).withColumn("partitions", F.lit(n)) for n in counts
    ]
    return reduce(DataFrame.unionAll, runs)


def repartition_invariance(df: DataFrame, counts: Iterable[int]) -> DataFrame:
    """The roll-up with the number of different results it had over all counts (1)."""
    result = F.struct("txn_count", "total_amount", "avg_amount")
    return (
        repartition_rollups(df, counts)
        .groupBy("category")
        .agg(
            F.max("txn_count").alias("txn_count"),
            F.max("total_amount").alias("total_amount"),
            F.count_distinct(result).alias("distinct_results"),
        )
    )


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition of the frame as Spark would process it now."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count("*").alias("rows")
    )


def partition_summary(df: DataFrame) -> DataFrame:
    """Partition count with the fewest, most and total rows (empty ones not counted)."""
    return partition_profile(df).agg(
        F.count("*").alias("partitions"),
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
        F.sum("rows").alias("total_rows"),
    )
