"""The measures the analytics share, as aggregate columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.domains import APPROVED


def approved(df: DataFrame) -> DataFrame:
    return df.filter(F.col("approval_status") == APPROVED)


def txn_count() -> Column:
    return F.count("transaction_id").alias("txn_count")


def total(name: str = "total_amount") -> Column:
    return F.sum("amount").alias(name)


def mean_amount(digits: int | None = 0) -> Column:
    """Mean amount from an exact integer sum.

    `avg` would add doubles, whose result depends on the order of addition once
    sums pass 2**53; sum and count are also shared with the other measures.
    """
    mean = F.try_divide(F.sum("amount"), F.count("amount"))
    return mean if digits is None else F.round(mean, digits)


def average(name: str = "avg_amount") -> Column:
    return mean_amount().alias(name)


def unique(column: str, name: str, exact: bool = True) -> Column:
    """Distinct count. Exact by default; `exact=False` keeps a sketch per group
    instead of shuffling every (group, value) pair."""
    counter = F.count_distinct if exact else F.approx_count_distinct
    return counter(F.col(column)).alias(name)


def unique_with_null(column: str, name: str) -> Column:
    """Size of SELECT DISTINCT: a NULL counts as one more value."""
    has_null = F.coalesce(F.max(F.col(column).isNull().cast("bigint")), F.lit(0).cast("bigint"))
    return (F.count_distinct(F.col(column)) + has_null).alias(name)


def standard(exact: bool = True) -> list[Column]:
    """Count, sum, mean and distinct cards."""
    return [txn_count(), total(), average(), unique("card_no", "unique_cards", exact)]


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """`part` of `whole` in percent; NULL where the whole is 0."""
    return F.round(part / F.nullif(whole, F.lit(0)) * 100, digits)


def growth(current: Column | str, previous: Column | str, digits: int = 2) -> Column:
    """Change in percent; NULL without a previous value or when that value is 0."""
    current = F.col(current) if isinstance(current, str) else current
    previous = F.col(previous) if isinstance(previous, str) else previous
    return F.round((current - previous) / F.nullif(previous, F.lit(0)) * 100, digits)


def with_share_of_total(
    df: DataFrame, column: str, name: str, digits: int = 2, closed: bool = True
) -> DataFrame:
    """Add each row's share of the column total.

    Over a closed domain (statuses, slots) a window without keys sees one row per value.
    With `closed=False` the total is a subquery of one row, so that a domain with any
    number of values is not brought together; it shares the shuffle of `df`.
    """
    everything = F.sum(column)
    whole = everything.over(Window.partitionBy()) if closed else df.agg(everything).scalar()
    return df.withColumn(name, share(F.col(column), whole, digits))


def fixed(column: Column, digits: int) -> Column:
    """The number as text with so many decimals, rounded from its exact binary value, a tie to the even
    digit: as Python's and C's `%.4f`. (`format_string` rounds the shortest text of the number half up.)"""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", column, F.lit(pattern))
