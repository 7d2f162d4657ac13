"""Lookups of one value, and joins that recur: layouts that spare reading and shuffling.

A day or a month is found by its folder; a card or an id lies anywhere. Files sorted by
that column hold a narrow range of values in each row group, so the minimum and maximum in their
footers rule most row groups out; a Bloom filter in the footer rules out most of the rest, also
where values are not sorted. Buckets deal both sides of a join the same way once, when they are
written, so that no later join on that key shuffles them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.sizing import spread


def write_clustered(
    df: DataFrame, path: str, by: str, bloom: tuple[str, ...] = (), row_group_bytes: int = 32 << 20
) -> None:
    """Overwrite `path` with files that each hold one range of `by`, sorted, with Bloom filters on
    `by` and on the columns of `bloom`.

    Ranges are cut by (value, hash of the row), so a value with a third of all rows takes several files.
    """
    tie = F.xxhash64(*df.columns).alias("_tie")
    ranged = df.select("*", tie).repartitionByRange(spread(df.sparkSession), by, "_tie").sortWithinPartitions(by)
    writer = ranged.drop("_tie").write.mode("overwrite").option("compression", "snappy")
    writer = writer.option("parquet.block.size", row_group_bytes)
    for column in (by, *bloom):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def lookup_value(df: DataFrame, column: str, value) -> DataFrame:
    """Rows with one value of a column; a plain comparison, so that the reader can skip by it."""
    return df.where(F.col(column) == F.lit(value))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Overwrite an external table at `path` in which rows are dealt to `buckets` files by `key`.

    The rows are dealt before they are written, so there is one file for each bucket. For a key without
    a value that holds a large part of the rows: a bucket cannot be split.
    """
    dealt = df.repartition(buckets, F.col(key))
    writer = dealt.write.mode("overwrite").format("parquet").option("compression", "snappy").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def bucketed_join(spark: SparkSession, facts: str, lookups: str, key: str, how: str = "left") -> DataFrame:
    """The join of two tables with the same buckets, which needs no shuffle. The hint keeps the
    join from being turned into a broadcast, whose size would depend on the data."""
    return spark.table(facts).join(spark.table(lookups).hint("merge"), key, how)
