from pyspark.sql import functions as F

from tests.rows import fact
from tillwise.functions.calendar_cols import parse_timestamp, time_slot
from tillwise.operators import summaries


def test_null_time_has_no_labels(spark):
    row = fact(spark, {"transaction_ts": None}).withColumn("slot", time_slot("txn_hour")).first()
    assert (row.txn_quarter, row.quarter_label, row.txn_date, row.slot) == (None,) * 4


def test_calendar_columns(spark):
    row = fact(spark, {"transaction_ts": "2024-12-29 23:59:59"}).first()
    assert (row.txn_year, row.txn_month, row.txn_quarter) == (2024, 12, 4)
    assert (row.txn_date, row.txn_hour, row.txn_day_of_week) == ("2024-12-29", 23, 1)  # a Sunday
    assert row.quarter_label == "Q4(10-12월)"


def test_slot_borders(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("h"))
    slots = {r.h: r.s for r in hours.withColumn("s", time_slot("h")).collect()}
    assert [slots[h] for h in (5, 6, 11, 12, 17, 18, 23, 0)] == [
        "심야", "오전", "오전", "오후", "오후", "저녁", "저녁", "심야"
    ]


def test_slot_table_is_a_parameter(spark):
    rows = fact(spark, {"transaction_ts": "2024-01-01 04:00:00"})
    finer = (("새벽", 3, 5), ("오전", 6, 11))
    assert summaries.hourly_pattern(rows, finer, "그 외").first().time_slot == "새벽"


def test_bad_text_is_null_not_an_error(spark):
    df = spark.createDataFrame([("1998-13-45 00:00:00",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(parse_timestamp("t")).collect()] == [None] * 3
