"""A rank over a whole table without sending the table through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.sizing import spread
from tillwise.sinks.scratch import materialize


def with_global_rank(df: DataFrame, by: str, name: str) -> DataFrame:
    """Add the rank of `by`, highest first; ties share a rank, NULL ranks last.

    A window without keys would sort every row in one task. Here the distinct
    values of `by`, with their row counts, are range-partitioned into slices; the
    rank of a value is the rows of all higher slices (a running sum over one row
    per slice) plus the rows of higher values in its own slice. Equal values are
    one row by then, so not even a value shared by most rows is a hot spot. The
    slice numbers are written out before use: they must not change when a task
    is run again.
    """
    df = materialize(df, "ranked-rows")
    values = materialize(
        df.groupBy(by)
        .agg(F.count("*").alias("_rows"))
        .repartitionByRange(spread(df.sparkSession), F.desc_nulls_last(by))
        .withColumn("_slice", F.spark_partition_id()),
        "rank-values",
    )
    higher_slices = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        values.groupBy("_slice")
        .agg(F.sum("_rows").alias("_slice_rows"))
        .select(
            "_slice",
            F.coalesce(F.sum("_slice_rows").over(higher_slices), F.lit(0)).alias("_offset"),
        )
    )
    higher_values = (
        Window.partitionBy("_slice")
        .orderBy(F.desc_nulls_last(by))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        values.withColumn("_before", F.coalesce(F.sum("_rows").over(higher_values), F.lit(0)))
        .join(F.broadcast(offsets), "_slice")  # one row per slice
        .select(F.col(by).alias("_value"), (F.col("_offset") + F.col("_before") + 1).alias(name))
    )
    return df.join(ranks, df[by].eqNullSafe(ranks["_value"]), "left").drop("_value")
