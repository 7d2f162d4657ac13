"""Calendar columns and labels derived from the transaction time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.domains import QUARTER_LABELS, REST_SLOT, TIME_SLOTS, TIMESTAMP_FORMAT


def parse_timestamp(text: Column | str, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text to timestamp; text that does not fit is NULL rather than an error."""
    return F.try_to_timestamp(text, F.lit(fmt))


def day_text(ts: Column | str) -> Column:
    """yyyy-MM-dd of a timestamp; a date cast needs no formatter and no time zone."""
    return F.to_date(ts).cast("string")


def quarter_label(quarter: Column | str) -> Column:
    """Label of quarter 1..4. A NULL quarter has a NULL label, not the one of Q4."""
    quarter = F.col(quarter) if isinstance(quarter, str) else quarter
    numbers = iter(QUARTER_LABELS.items())
    first, text = next(numbers)
    label = F.when(quarter == first, text)
    for number, text in numbers:
        label = label.when(quarter == number, text)
    return label


def time_slot(
    hour: Column | str,
    slots: tuple[tuple[str, int, int], ...] = TIME_SLOTS,
    rest: str = REST_SLOT,
) -> Column:
    """Name of the slot holding `hour`; a NULL hour has no slot.

    `slots` rows are (label, first hour, last hour). Pass another table for a
    finer split of the day.
    """
    hour = F.col(hour) if isinstance(hour, str) else hour
    label = F.when(hour.isNull(), F.lit(None).cast("string"))
    for name, first, last in slots:
        label = label.when(hour.between(first, last), name)
    return label.otherwise(rest)


def with_calendar(df: DataFrame, ts: str = "transaction_ts") -> DataFrame:
    """Add every calendar column. Unused ones cost nothing: Catalyst drops them."""
    return df.select(
        "*",
        F.year(ts).alias("txn_year"),
        F.month(ts).alias("txn_month"),
        F.quarter(ts).alias("txn_quarter"),
        quarter_label(F.quarter(ts)).alias("quarter_label"),
        day_text(ts).alias("txn_date"),
        F.hour(ts).alias("txn_hour"),
        F.dayofweek(ts).alias("txn_day_of_week"),
    )


def in_year(df: DataFrame, year: int, ts: str = "transaction_ts") -> DataFrame:
    """Rows of one calendar year, as a time range the Parquet reader can skip by.

    Where `txn_year` is a stored column (a partition directory) it is tested as
    well, so whole directories are pruned.
    """
    kept = between_times(df, f"{year}-01-01", f"{year + 1}-01-01", ts)
    return kept.filter(F.col("txn_year") == year) if "txn_year" in df.columns else kept


def between_times(df: DataFrame, start: str, end: str, ts: str = "transaction_ts") -> DataFrame:
    """Rows with start <= ts < end."""
    kind = df.schema[ts].dataType
    return df.filter(
        (F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) < F.lit(end).cast(kind))
    )
