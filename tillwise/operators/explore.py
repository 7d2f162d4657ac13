"""Ad-hoc aggregates for reports and charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.measures import (
    average,
    mean_amount,
    total,
    unique_with_null,
    with_share_of_total,
)

HUNDRED_MILLION = 100_000_000
MILLION = 1_000_000


def _rows():
    return F.count("*").alias("txn_count")


def by_category(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(_rows(), total(), average()).orderBy(F.desc("total_amount"))


def by_hour(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("txn_hour")
        .agg(_rows(), total())
        .withColumn("amount_millions", F.col("total_amount") / MILLION)
        .orderBy("txn_hour")
    )


def by_month(df: DataFrame) -> DataFrame:
    """By month of the year; the same month of different years is one row."""
    return (
        df.groupBy("txn_month")
        .agg(_rows(), total(), average())
        .withColumn("amount_hundred_millions", F.col("total_amount") / HUNDRED_MILLION)
        .orderBy("txn_month")
    )


def by_region(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(_rows(), total(), average()).orderBy(F.desc("total_amount"))


def top_merchants(df: DataFrame, top: int = 15) -> DataFrame:
    """The `top` merchants by revenue; equal revenue is ordered by name."""
    return (
        df.groupBy("merchant", "category")
        .agg(_rows(), total())
        .orderBy(F.desc("total_amount"), "merchant", "category")
        .limit(top)
        .withColumns(
            {
                "label": F.concat("merchant", F.lit(" ("), "category", F.lit(")")),
                "amount_hundred_millions": F.col("total_amount") / HUNDRED_MILLION,
            }
        )
    )


def amount_describe(df: DataFrame) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum, as numbers.

    Squared deviations are summed around a whole number next to the mean, in decimals: exact,
    whatever the order of rows and however large the mean is against the deviation. What that
    number is off is corrected for at the end.
    """
    amount, n = F.col("amount"), F.col("count").cast("decimal(20,0)")
    near = F.floor(F.col("mean")).cast("decimal(18,0)")
    around = F.col("_squares") - 2 * near * F.col("_sum") + n * near * near
    off = (F.col("_sum") - n * near).cast("double")
    return (
        df.agg(
            F.count("amount").alias("count"),
            mean_amount(digits=None).alias("mean"),
            F.sum(amount.cast("decimal(18,0)")).cast("decimal(30,0)").alias("_sum"),
            F.sum(amount.cast("decimal(18,0)") * amount.cast("decimal(18,0)")).alias("_squares"),
            F.min("amount").alias("min"),
            F.max("amount").alias("max"),
        )
        .withColumn(
            "stddev",
            F.sqrt(F.try_divide(around.cast("double") - F.try_divide(off * off, F.col("count")), F.col("count") - 1)),
        )
        .select("count", "mean", "stddev", "min", "max")
    )


def summary(df: DataFrame) -> DataFrame:
    return df.agg(
        _rows(),
        total(),
        unique_with_null("card_no", "unique_cards"),
        unique_with_null("merchant", "unique_merchants"),
    ).withColumns(
        {
            "amount_hundred_millions": F.round(F.col("total_amount") / HUNDRED_MILLION, 1),
            "avg_amount": F.expr("total_amount div nullif(txn_count, 0)"),
        }
    )


def category_rollup(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(_rows(), total(), mean_amount(None).alias("avg_amount"))


def category_distribution(df: DataFrame) -> DataFrame:
    """All statuses: rows, share of rows and amount by category."""
    counted = df.groupBy("category").agg(_rows(), total())
    return with_share_of_total(counted, "txn_count", "share_pct", 1, closed=False).orderBy(F.desc("txn_count"))


def approval_distribution(df: DataFrame) -> DataFrame:
    """All statuses: rows and share of rows by approval status."""
    counted = df.groupBy("approval_status").agg(_rows())
    return with_share_of_total(counted, "txn_count", "share_pct").orderBy(F.desc("txn_count"))
