"""Literal transactions for what the test data lacks."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tillwise.functions.calendar_cols import with_calendar

SCHEMA = (
    "transaction_id string, transaction_ts timestamp_ntz, card_no string, card_type string, "
    "merchant string, sub_category string, category string, amount bigint, "
    "installment_months int, approval_status string, region string"
)
DEFAULTS = {
    "transaction_id": "TXN0000000001",
    "transaction_ts": "2024-02-03 10:11:12",
    "card_no": "****-****-****-1234",
    "card_type": "신용",
    "merchant": "CU",
    "sub_category": "편의점",
    "category": "식비",
    "amount": 1000,
    "installment_months": 0,
    "approval_status": "approved",
    "region": "서울",
}


def transactions(spark, *changes: dict):
    """One transaction per dict, each the default one with these columns changed."""
    def row(number, change):
        values = {**DEFAULTS, "transaction_id": f"TXN{number:010d}", **change}
        text = values["transaction_ts"]
        values["transaction_ts"] = text and datetime.datetime.fromisoformat(text)
        return tuple(values[name] for name in DEFAULTS)

    return spark.createDataFrame([row(n, c) for n, c in enumerate(changes, 1)], SCHEMA)


def fact(spark, *changes: dict):
    return with_calendar(transactions(spark, *changes))


def raw(spark, *changes: dict):
    """Transactions as the quality suite gets them: the time as text."""
    text = {
        i: c.pop("transaction_date") for i, c in enumerate(changes, 1) if "transaction_date" in c
    }
    df = transactions(spark, *changes).withColumn(
        "transaction_date", F.col("transaction_ts").cast("string")
    )
    for number, value in text.items():
        df = df.withColumn(
            "transaction_date",
            F.when(F.col("transaction_id") == f"TXN{number:010d}", F.lit(value)).otherwise(
                F.col("transaction_date")
            ),
        )
    return df.drop("transaction_ts").withColumn("amount", F.col("amount").cast("int"))
