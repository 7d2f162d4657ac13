"""Readers for transaction tables. No reader infers a schema: a clean and a dirty
file would come back with different types, and inference costs a full pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.calendar_cols import parse_timestamp, with_calendar
from tillwise.functions.measures import approved
from tillwise.schema import FACT, FACT_RAW, NUMBER_TEXTS


def read_csv(spark: SparkSession, path: str, schema: T.StructType = FACT) -> DataFrame:
    """CSV with a header line, UTF-8, declared types."""
    return spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").csv(path)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text, for input that is still to be checked."""
    return read_csv(spark, path, FACT_RAW)


def cast_numbers(
    df: DataFrame, amount: str = "amount", installment: str = "installment_months"
) -> DataFrame:
    """Text to whole numbers for the two numeric columns; text that is no number becomes
    NULL. The text is kept beside them (`NUMBER_TEXTS`), so that it can be told from
    a missing value."""
    texts = {"amount": F.col(amount), "installment_months": F.col(installment)}
    return df.withColumns(
        {
            **{NUMBER_TEXTS[name]: text for name, text in texts.items()},
            "amount": texts["amount"].try_cast("bigint"),
            "installment_months": texts["installment_months"].try_cast("int"),
        }
    )


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet scan. Pass the schema for partitioned tables: a text partition
    column such as `txn_date` would otherwise be read back as a date."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def with_timestamps(df: DataFrame) -> DataFrame:
    """Parsed transaction time plus all calendar columns."""
    if "transaction_ts" not in df.columns:
        df = df.withColumn("transaction_ts", parse_timestamp("transaction_date"))
    return with_calendar(df)


def load_transactions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(all transactions, approved transactions) of a CSV file, with derived columns."""
    everything = with_timestamps(read_csv(spark, path))
    return everything, approved(everything)
