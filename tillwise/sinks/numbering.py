"""Dense numbers for cards and merchants, so that sets of them can be kept as bitmaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.functions.sizing import spread
from tillwise.sinks.merge import Folder
from tillwise.sinks.scratch import materialize
from tillwise.sinks.tables import read_output, typed

NAME = "member_numbers"


def read_numbers(spark: SparkSession, root: str) -> DataFrame:
    """value, number, member; empty before the first run."""
    path = f"{root}/{NAME}"
    if Folder(spark, path).exists():
        return read_output(spark, path, NAME)
    return typed(spark.createDataFrame([], "value string, number long, member string"), NAME)


def number_members(values: DataFrame, root: str) -> DataFrame:
    """Give numbers to those of the `values` (member, value) that have none, and return all.

    Numbers are dense from 1 for each kind of member and never change. They are given in
    slices by hash: a running sum over one row for each slice says where it begins, so
    no task sees all values. New ones are appended in one commit; a run that fails later leaves them
    numbered, which harms nothing.
    """
    spark = values.sparkSession
    known = read_numbers(spark, root)
    unknown = values.where("value IS NOT NULL").select("member", "value").distinct()
    unknown = unknown.join(known, ["member", "value"], "left_anti")
    sliced = materialize(
        unknown.withColumn("slice", F.pmod(F.xxhash64("value"), F.lit(spread(spark)))), "new-members"
    )
    last = known.groupBy("member").agg(F.max("number").alias("last"))
    before = Window.partitionBy("member").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        sliced.groupBy("member", "slice")
        .count()
        .withColumn("begin", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .join(last, "member", "left")
        .select("member", "slice", (F.coalesce("last", F.lit(0)) + F.col("begin")).alias("begin"))
    )
    in_slice = Window.partitionBy("member", "slice").orderBy("value")
    numbered = (
        sliced.withColumn("place", F.row_number().over(in_slice))
        .join(F.broadcast(begins), ["member", "slice"])  # one row for each slice
        .withColumn("number", F.col("begin") + F.col("place"))
    )
    added = typed(numbered, NAME)
    added.write.mode("append").option("compression", "snappy").partitionBy("member").parquet(f"{root}/{NAME}")
    return read_numbers(spark, root)
