"""Daily, merchant, hourly, regional and monthly summaries of approved transactions.

Each is one aggregation: rows are combined before they are shuffled, and the
distinct counts shuffle (group, value) pairs, so a group holding a large part of
all rows is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.domains import REST_SLOT, TIME_SLOTS
from tillwise.functions.calendar_cols import day_text, time_slot
from tillwise.functions.measures import (
    average,
    standard,
    total,
    txn_count,
    unique,
    unique_with_null,
)


def daily_category_summary(df: DataFrame, exact: bool = True) -> DataFrame:
    return (
        df.groupBy("txn_date", "category")
        .agg(
            *standard(exact),
            F.max("amount").alias("max_amount"),
            F.min("amount").alias("min_amount"),
        )
        .orderBy("txn_date", "category")
    )


def merchant_ranking(df: DataFrame, exact: bool = True) -> DataFrame:
    """Merchants by revenue. `revenue_rank` is revenue in units of 10,000, not a
    rank; see `merchant_amount_rank` for that."""
    return (
        df.groupBy("merchant", "category", "sub_category")
        .agg(
            txn_count(),
            unique("card_no", "unique_customers", exact),
            total("total_revenue"),
            average("avg_transaction"),
        )
        .withColumn("revenue_rank", F.round(F.col("total_revenue") / 10000, 1))
        .orderBy(F.desc("total_revenue"))
    )


def hourly_pattern(
    df: DataFrame,
    slots: tuple[tuple[str, int, int], ...] = TIME_SLOTS,
    rest: str = REST_SLOT,
    exact: bool = True,
) -> DataFrame:
    return (
        df.groupBy("txn_hour")
        .agg(*standard(exact))
        .withColumn("time_slot", time_slot("txn_hour", slots, rest))
        .orderBy("txn_hour")
    )


def regional_analysis(df: DataFrame, exact: bool = True) -> DataFrame:
    return (
        df.groupBy("region", "category")
        .agg(*standard(exact))
        .orderBy("region", F.desc("total_amount"))
    )


def monthly_trend(df: DataFrame, exact: bool = True) -> DataFrame:
    return (
        df.groupBy("txn_year", "txn_month")
        .agg(*standard(exact), unique("merchant", "unique_merchants", exact))
        .orderBy("txn_year", "txn_month")
    )


def etl_report(df: DataFrame) -> DataFrame:
    """One row over everything. Distinct counts include NULL as a value."""
    return df.agg(
        F.count("*").alias("txn_count"),
        total(),
        unique_with_null("card_no", "unique_cards"),
        unique_with_null("merchant", "unique_merchants"),
        day_text(F.min("transaction_ts")).alias("min_date"),
        day_text(F.max("transaction_ts")).alias("max_date"),
    )
