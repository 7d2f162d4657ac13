"""Quarter-grain analytics of approved transactions in one year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.domains import NO_DATA
from tillwise.functions.calendar_cols import between_times, in_year, quarter_label
from tillwise.functions.measures import (
    average,
    growth,
    standard,
    total,
    txn_count,
    unique,
    unique_with_null,
)

QUARTER = ("txn_quarter", "quarter_label")


def quarterly_category_summary(df: DataFrame, year: int, exact: bool = True) -> DataFrame:
    return (
        in_year(df, year)
        .groupBy(*QUARTER, "category")
        .agg(*standard(exact))
        .orderBy("txn_quarter", F.desc("total_amount"))
    )


def quarterly_merchant_top(
    df: DataFrame, year: int, top: int = 10, exact: bool = True
) -> DataFrame:
    """Merchants on the `top` highest revenue ranks of each quarter.

    Ranks are dense, so ties can give more than `top` merchants. The rank limit
    is applied before the shuffle as well, so a quarter's window only receives
    the few rows that can still qualify.
    """
    by_revenue = Window.partitionBy("txn_quarter").orderBy(F.desc("total_revenue"))
    return (
        in_year(df, year)
        .groupBy(*QUARTER, "merchant", "category")
        .agg(
            txn_count(),
            total("total_revenue"),
            unique("card_no", "unique_customers", exact),
        )
        .withColumn("rank", F.dense_rank().over(by_revenue))
        .filter(F.col("rank") <= top)
    )


def qoq_growth(df: DataFrame, year: int, calendar: bool = False, exact: bool = True) -> DataFrame:
    """Each quarter with its growth over the one before.

    By default "before" is the previous quarter of the year that has data, so the
    first has no growth. With `calendar=True` it is the calendar predecessor: the
    first quarter is compared with Q4 of the year before, every quarter gets a
    row, and a quarter after an empty one has no growth.
    """
    if calendar:
        spine = (
            df.sparkSession.range(5)
            .select(
                F.when(F.col("id") == 0, year - 1).otherwise(year).alias("txn_year"),
                F.when(F.col("id") == 0, 4).otherwise(F.col("id")).cast("int").alias("txn_quarter"),
            )
            .withColumn("quarter_label", quarter_label("txn_quarter"))
        )
        totals = (
            between_times(df, f"{year - 1}-10-01", f"{year + 1}-01-01")
            .filter(F.col("txn_year").isin(year - 1, year))  # prunes a stored fact's folders
            .groupBy("txn_year", "txn_quarter")
            .agg(txn_count(), total(), unique("card_no", "unique_cards", exact))
        )
        quarters = spine.join(totals, ["txn_year", "txn_quarter"], "left").fillna(
            0, ["txn_count", "unique_cards"]
        )
        in_order = Window.orderBy("txn_year", "txn_quarter")
    else:
        quarters = (
            in_year(df, year)
            .groupBy(*QUARTER)
            .agg(txn_count(), total(), unique("card_no", "unique_cards", exact))
        )
        in_order = Window.orderBy("txn_quarter")
    # at most five rows reach this window without keys
    compared = quarters.withColumns(
        {
            "prev_amount": F.lag("total_amount").over(in_order),
            "prev_count": F.lag("txn_count").over(in_order),
        }
    )
    if calendar:
        compared = compared.filter(F.col("txn_year") == year)
    return compared.select(
        *QUARTER,
        "txn_count",
        "total_amount",
        "unique_cards",
        "prev_amount",
        "prev_count",
        growth("total_amount", "prev_amount").alias("amount_growth_rate"),
        growth("txn_count", "prev_count").alias("count_growth_rate"),
    ).orderBy("txn_quarter")


def quarterly_card_type(df: DataFrame, year: int) -> DataFrame:
    return (
        in_year(df, year)
        .groupBy(*QUARTER, "card_type")
        .agg(txn_count(), total(), average())
        .orderBy("txn_quarter", "card_type")
    )


def quarterly_region(df: DataFrame, year: int) -> DataFrame:
    return (
        in_year(df, year)
        .groupBy(*QUARTER, "region")
        .agg(txn_count(), total())
        .orderBy("txn_quarter", F.desc("total_amount"))
    )


def quarterly_installment(df: DataFrame, year: int) -> DataFrame:
    """Instalment purchases only."""
    return (
        in_year(df, year)
        .filter(F.col("installment_months") > 0)
        .groupBy(*QUARTER, "installment_months")
        .agg(txn_count(), total())
        .orderBy("txn_quarter", "installment_months")
    )


def quarterly_report(df: DataFrame, year: int) -> DataFrame:
    """One row for each of the four quarters; one without data says so in `note`."""
    found = (
        in_year(df, year)
        .groupBy("txn_quarter")
        .agg(
            F.count("*").alias("txn_count"),
            total(),
            unique_with_null("card_no", "unique_cards"),
            unique_with_null("merchant", "unique_merchants"),
        )
    )
    spine = df.sparkSession.range(1, 5).select(F.col("id").cast("int").alias("txn_quarter"))
    last_month = F.col("txn_quarter") * 3
    return (
        spine.join(found, "txn_quarter", "left")
        .fillna(0, ["txn_count", "unique_cards", "unique_merchants"])
        .withColumns(
            {
                "months": F.format_string("%d-%d", last_month - 2, last_month),
                "avg_amount": F.expr("total_amount div nullif(txn_count, 0)"),
                "note": F.when(F.col("txn_count") == 0, NO_DATA),
            }
        )
        .orderBy("txn_quarter")
    )
