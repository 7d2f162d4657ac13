"""Tables the catalog has always described: approval rates, true ranks, growth by
month and by category, ratios, and the sample queries over the summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.domains import APPROVED, CANCELLED, CREDIT, REST_SLOT, TIME_SLOTS
from tillwise.functions.calendar_cols import in_year, time_slot
from tillwise.functions.measures import (
    average,
    growth,
    share,
    total,
    txn_count,
    unique,
    with_share_of_total,
)
from tillwise.operators.ranking import with_global_rank


def _has_status(status: str):
    return F.count_if(F.col("approval_status") == status)


COUNTS = ("txn_count", "approved_count", "cancelled_count", "credit_count")


def status_counts(df: DataFrame, credit_type: str = CREDIT) -> DataFrame:
    """By day, hour and category over ALL statuses: what the two tables below need, so that
    one pass over the transactions is enough for both."""
    return df.groupBy("txn_date", "txn_hour", "category").agg(
        txn_count(),
        _has_status(APPROVED).alias("approved_count"),
        _has_status(CANCELLED).alias("cancelled_count"),
        F.count_if(F.col("card_type") == credit_type).alias("credit_count"),
    )


def daily_approval_rate(df: DataFrame) -> DataFrame:
    """By day and category over ALL statuses."""
    return daily_rate_of_counts(
        df.groupBy("txn_date", "category").agg(
            txn_count(),
            _has_status(APPROVED).alias("approved_count"),
            _has_status(CANCELLED).alias("cancelled_count"),
        )
    )


def daily_rate_of_counts(counts: DataFrame) -> DataFrame:
    """`daily_approval_rate` from counts at its grain or a finer one."""
    return (
        counts.groupBy("txn_date", "category")
        .agg(*[F.sum(c).alias(c) for c in COUNTS[:3]])
        .withColumn("approval_rate", share(F.col("approved_count"), F.col("txn_count")))
        .orderBy("txn_date", "category")
    )


def merchant_amount_rank(df: DataFrame, exact: bool = True) -> DataFrame:
    """Merchants with their rank by revenue over all merchants."""
    merchants = df.groupBy("merchant", "category").agg(
        txn_count(), total(), average(), unique("card_no", "unique_cards", exact)
    )
    return with_global_rank(merchants, "total_amount", "amount_rank")


def hourly_ratios(
    df: DataFrame,
    credit_type: str = CREDIT,
    slots: tuple[tuple[str, int, int], ...] = TIME_SLOTS,
    rest: str = REST_SLOT,
) -> DataFrame:
    """Credit and cancellation shares by hour over ALL statuses."""
    counts = df.groupBy("txn_hour").agg(
        txn_count(),
        _has_status(CANCELLED).alias("cancelled_count"),
        F.count_if(F.col("card_type") == credit_type).alias("credit_count"),
    )
    return hourly_ratios_of_counts(counts, slots, rest)


def hourly_ratios_of_counts(
    counts: DataFrame,
    slots: tuple[tuple[str, int, int], ...] = TIME_SLOTS,
    rest: str = REST_SLOT,
) -> DataFrame:
    """`hourly_ratios` from counts at its grain or a finer one."""
    whole = F.sum("txn_count")
    return (
        counts.groupBy("txn_hour")
        .agg(
            whole.alias("txn_count"),
            share(F.sum("credit_count"), whole).alias("credit_ratio"),
            share(F.sum("cancelled_count"), whole).alias("cancel_rate"),
        )
        .withColumn("time_slot", time_slot("txn_hour", slots, rest))
        .orderBy("txn_hour")
    )


def regional_profile(df: DataFrame, credit_type: str = CREDIT) -> DataFrame:
    """One row per region: volume, distinct merchants, credit share and the category
    with the most transactions (of equals, the last by name).

    One scan: grouping sets fold the rows to (region, category) and
    (region, merchant) before the shuffle, so no region is handled row by row.
    """
    by_category = F.col("_set") == 1
    return (
        df.groupingSets(
            [["region", "category"], ["region", "merchant"]], "region", "category", "merchant"
        )
        .agg(
            # the set without merchant has grouping id 0b001, the other 0b010
            F.grouping_id().alias("_set"),
            F.count("transaction_id").alias("_rows"),
            F.sum("amount").alias("_amount"),
            F.count("amount").alias("_amounts"),
            F.count_if(F.col("card_type") == credit_type).alias("_credit"),
        )
        .groupBy("region")
        .agg(
            F.sum(F.when(by_category, F.col("_rows"))).alias("txn_count"),
            F.sum(F.when(by_category, F.col("_amount"))).alias("total_amount"),
            F.sum(F.when(by_category, F.col("_amounts"))).alias("_amounts"),
            F.sum(F.when(by_category, F.col("_credit"))).alias("_credit"),
            F.count_if(~by_category & F.col("merchant").isNotNull()).alias("unique_merchants"),
            F.max_by(
                "category", F.when(by_category, F.struct("_rows", "category"))
            ).alias("top_category"),
        )
        .select(
            "region",
            "txn_count",
            "total_amount",
            F.round(F.try_divide("total_amount", "_amounts"), 0).alias("avg_amount"),
            "unique_merchants",
            "top_category",
            share(F.col("_credit"), F.col("txn_count")).alias("credit_ratio"),
        )
        .orderBy("region")
    )


def monthly_mom_growth(df: DataFrame, exact: bool = True) -> DataFrame:
    """By yyyy-MM, with growth over the previous month that has data."""
    months = df.groupBy("txn_year", "txn_month").agg(
        txn_count(),
        total(),
        average(),
        unique("card_no", "unique_cards", exact),
        unique("merchant", "unique_merchants", exact),
    )
    # one row per calendar month, so the window without keys stays tiny
    in_order = Window.orderBy("txn_year", "txn_month")
    return months.select(
        F.format_string("%04d-%02d", "txn_year", "txn_month").alias("txn_month"),
        "txn_count",
        "total_amount",
        "avg_amount",
        growth("total_amount", F.lag("total_amount").over(in_order)).alias("mom_growth_rate"),
        "unique_cards",
        "unique_merchants",
    ).orderBy("txn_month")


def quarterly_category_qoq(df: DataFrame, year: int) -> DataFrame:
    """By quarter and category, with growth over that category's previous quarter."""
    in_order = Window.partitionBy("category").orderBy("txn_quarter")
    return (
        in_year(df, year)
        .groupBy("txn_quarter", "category")
        .agg(txn_count(), total(), average())
        .select(
            F.format_string("Q%d", "txn_quarter").alias("quarter"),
            "category",
            "txn_count",
            "total_amount",
            "avg_amount",
            growth("total_amount", F.lag("total_amount").over(in_order)).alias("qoq_growth_rate"),
        )
        .orderBy("quarter", "category")
    )


def daily_top_categories(daily: DataFrame, top: int = 5) -> DataFrame:
    """The `top` categories of each day by amount, from `daily_category_summary`."""
    by_amount = Window.partitionBy("txn_date").orderBy(F.desc("total_amount"), "category")
    return (
        daily.select(
            "txn_date", "category", "total_amount", F.row_number().over(by_amount).alias("rn")
        )
        .filter(F.col("rn") <= top)
        .orderBy("txn_date", "rn")
    )


def time_slot_share(hourly: DataFrame) -> DataFrame:
    """Share of transactions by time slot, from `hourly_pattern`."""
    slots = hourly.groupBy("time_slot").agg(F.sum("txn_count").alias("total_txns"))
    return with_share_of_total(slots, "total_txns", "pct")


def regional_monthly_trend(df: DataFrame) -> DataFrame:
    """Amount by month and region."""
    return (
        df.groupBy("txn_year", "txn_month", "region")
        .agg(txn_count(), total())
        .select(
            F.format_string("%04d-%02d", "txn_year", "txn_month").alias("txn_month"),
            "region",
            "txn_count",
            "total_amount",
        )
        .orderBy("txn_month", F.desc("total_amount"))
    )
