"""Schemas of the fact table and of every table the jobs write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

FACT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("transaction_date", T.StringType(), False),
        T.StructField("card_no", T.StringType(), False),
        T.StructField("card_type", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("sub_category", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("installment_months", T.IntegerType()),
        T.StructField("approval_status", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)
FACT_COLUMNS = tuple(FACT.names)

# Same columns, nothing cast: for input that has to be checked before it is trusted.
FACT_RAW = T.StructType([T.StructField(name, T.StringType()) for name in FACT_COLUMNS])

# Where the text of a number is kept once the number has been cast.
NUMBER_TEXTS = {"amount": "amount_text", "installment_months": "installment_text"}

BENCHMARK_REPORT = T.StructType(
    [
        T.StructField("test_name", T.StringType()),
        T.StructField("elapsed_sec", T.DoubleType()),
        T.StructField("detail", T.StringType()),
    ]
)

COLUMN_COMMENTS = {
    "transaction_id": "Transaction id",
    "transaction_date": "Transaction time as text",
    "transaction_ts": "Transaction time",
    "card_no": "Masked card number",
    "card_type": "Credit or debit",
    "merchant": "Merchant name",
    "sub_category": "Merchant sub-category",
    "category": "Merchant category",
    "amount": "Amount in the smallest currency unit",
    "installment_months": "Instalments, 0 = paid at once",
    "approval_status": "approved, declined or cancelled",
    "region": "Region",
    "txn_year": "Year",
    "txn_month": "Month",
    "txn_quarter": "Quarter, 1 to 4",
    "txn_date": "Day, yyyy-MM-dd",
    "txn_hour": "Hour, 0 to 23",
    "txn_count": "Number of transactions",
    "total_amount": "Sum of amounts",
    "avg_amount": "Rounded mean amount",
    "unique_cards": "Distinct masked card numbers",
    "unique_merchants": "Distinct merchants",
    "approved_count": "Approved transactions",
    "cancelled_count": "Cancelled transactions",
    "approval_rate": "Approved share in percent",
    "amount_rank": "Rank by revenue, 1 = highest",
    "credit_ratio": "Credit-card share in percent",
    "cancel_rate": "Cancelled share in percent",
    "top_category": "Category with the most transactions",
    "mom_growth_rate": "Growth over the month before in percent",
    "qoq_growth_rate": "Growth over the quarter before in percent",
    "grain": "What the row is summed by besides the day",
    "row_count": "Rows, those without an id included",
    "amount_count": "Rows with an amount",
    "no_card": "Rows without a card number",
    "no_merchant": "Rows without a merchant",
    "credit_count": "Credit-card transactions",
    "member": "What is counted without repetition: card or merchant",
    "bucket": "Bitmap number, 32,768 members each",
    "bits": "Members of the bucket that occur",
    "number": "Number of a member, from 1",
}


@dataclass(frozen=True)
class TableSpec:
    """An output table: where it lives below the output root and what is in it."""

    columns: str
    partition_by: tuple[str, ...] = ()
    comment: str = ""
    few_rows_per_partition: bool = True  # an aggregate, at most some rows per directory

    @property
    def schema(self) -> T.StructType:
        """The table's schema with column comments; also pins partition column types."""
        plain = T.StructType.fromDDL(self.columns)
        return T.StructType(
            [
                T.StructField(f.name, f.dataType, True, {"comment": COLUMN_COMMENTS[f.name]})
                if f.name in COLUMN_COMMENTS
                else f
                for f in plain.fields
            ]
        )


_FACT_DDL = (
    "transaction_id string, transaction_date string, card_no string, card_type string, "
    "merchant string, sub_category string, category string, amount bigint, "
    "installment_months int, approval_status string, region string, transaction_ts timestamp, "
    "txn_date string, txn_hour int, txn_day_of_week int, txn_quarter int, quarter_label string, "
    "txn_year int, txn_month int"
)

TABLES: dict[str, TableSpec] = {
    "partitioned_transactions": TableSpec(
        _FACT_DDL, ("txn_year", "txn_month"), "Approved transactions", few_rows_per_partition=False
    ),
    "daily_category_summary": TableSpec(
        "txn_date string, category string, txn_count bigint, unique_cards bigint, "
        "total_amount bigint, avg_amount double, max_amount bigint, min_amount bigint",
        ("txn_date",),
        "Approved volume by day and category",
    ),
    "merchant_ranking": TableSpec(
        "merchant string, category string, sub_category string, txn_count bigint, "
        "unique_customers bigint, total_revenue bigint, avg_transaction double, "
        "revenue_rank double",
        comment="Revenue by merchant; revenue_rank is revenue in units of 10,000",
    ),
    "hourly_pattern": TableSpec(
        "txn_hour int, txn_count bigint, total_amount bigint, avg_amount double, "
        "unique_cards bigint, time_slot string",
        comment="Approved volume by hour",
    ),
    "regional_analysis": TableSpec(
        "region string, category string, txn_count bigint, total_amount bigint, "
        "avg_amount double, unique_cards bigint",
        ("region",),
        "Approved volume by region and category",
    ),
    "monthly_trend": TableSpec(
        "txn_year int, txn_month int, txn_count bigint, total_amount bigint, avg_amount double, "
        "unique_cards bigint, unique_merchants bigint",
        comment="Approved volume by month",
    ),
    "quarterly_category_summary": TableSpec(
        "txn_quarter int, quarter_label string, category string, txn_count bigint, "
        "total_amount bigint, avg_amount double, unique_cards bigint",
        ("txn_quarter",),
        "Approved volume by quarter and category",
    ),
    "quarterly_merchant_top10": TableSpec(
        "txn_quarter int, quarter_label string, merchant string, category string, "
        "txn_count bigint, total_revenue bigint, unique_customers bigint, rank int",
        ("txn_quarter",),
        "Ten highest revenue ranks of each quarter",
    ),
    "qoq_growth": TableSpec(
        "txn_quarter int, quarter_label string, txn_count bigint, total_amount bigint, "
        "unique_cards bigint, prev_amount bigint, prev_count bigint, "
        "amount_growth_rate double, count_growth_rate double",
        comment="Growth from quarter to quarter",
    ),
    "quarterly_card_type": TableSpec(
        "txn_quarter int, quarter_label string, card_type string, txn_count bigint, "
        "total_amount bigint, avg_amount double",
        comment="Volume by quarter and card type",
    ),
    "quarterly_region": TableSpec(
        "txn_quarter int, quarter_label string, region string, txn_count bigint, "
        "total_amount bigint",
        comment="Volume by quarter and region",
    ),
    "quarterly_installment": TableSpec(
        "txn_quarter int, quarter_label string, installment_months int, txn_count bigint, "
        "total_amount bigint",
        comment="Volume by quarter and instalment plan",
    ),
    "daily_approval_rate": TableSpec(
        "txn_date string, category string, txn_count bigint, approved_count bigint, "
        "cancelled_count bigint, approval_rate double",
        comment="Approvals by day and category, all statuses",
    ),
    "merchant_amount_rank": TableSpec(
        "merchant string, category string, txn_count bigint, total_amount bigint, "
        "avg_amount double, unique_cards bigint, amount_rank bigint",
        comment="Merchants with their true revenue rank",
    ),
    "hourly_ratios": TableSpec(
        "txn_hour int, time_slot string, txn_count bigint, credit_ratio double, "
        "cancel_rate double",
        comment="Credit and cancellation shares by hour, all statuses",
    ),
    "regional_profile": TableSpec(
        "region string, txn_count bigint, total_amount bigint, avg_amount double, "
        "unique_merchants bigint, top_category string, credit_ratio double",
        comment="One row per region",
    ),
    "monthly_mom_growth": TableSpec(
        "txn_month string, txn_count bigint, total_amount bigint, avg_amount double, "
        "mom_growth_rate double, unique_cards bigint, unique_merchants bigint",
        comment="Approved volume by yyyy-MM with growth",
    ),
    "quarterly_category_qoq": TableSpec(
        "quarter string, category string, txn_count bigint, total_amount bigint, "
        "avg_amount double, qoq_growth_rate double",
        comment="Growth from quarter to quarter by category",
    ),
    "quality_report": TableSpec(
        "check_no int, check_category string, check_name string, status string, "
        "issue_count bigint, issue_pct double, issue_ratio string, detail string, "
        "total_records bigint, checked_at timestamp",
        comment="One row per quality check",
    ),
}

_MONTH = ("txn_year", "txn_month")

# What incremental runs keep beside the outputs: partial results by day, from which all
# summaries can be made again.
STATE: dict[str, TableSpec] = {
    "daily_status_counts": TableSpec(
        "txn_date string, txn_hour int, category string, txn_count bigint, approved_count bigint, "
        "cancelled_count bigint, credit_count bigint, txn_year int, txn_month int",
        _MONTH,
        "Counts by day, hour and category, all statuses",
        few_rows_per_partition=False,
    ),
    "daily_totals": TableSpec(
        "txn_date string, grain string, category string, txn_hour int, region string, "
        "merchant string, sub_category string, txn_count bigint, row_count bigint, "
        "total_amount bigint, amount_count bigint, max_amount bigint, min_amount bigint, "
        "no_card bigint, no_merchant bigint, txn_year int, txn_month int",
        _MONTH,
        "Approved volume by day, summed at several grains",
        few_rows_per_partition=False,
    ),
    "daily_members": TableSpec(
        "txn_date string, grain string, category string, txn_hour int, region string, "
        "member string, bucket bigint, bits binary, txn_year int, txn_month int",
        _MONTH,
        "Cards and merchants of approved transactions by day, as bitmaps",
        few_rows_per_partition=False,
    ),
    "daily_merchant_cards": TableSpec(
        "txn_date string, merchant string, category string, sub_category string, card bigint, "
        "txn_year int, txn_month int",
        _MONTH,
        "Distinct cards of approved transactions by day and merchant",
        few_rows_per_partition=False,
    ),
    "member_numbers": TableSpec(
        "value string, number bigint, member string", ("member",), "Numbers of cards and merchants",
        few_rows_per_partition=False,
    ),
}


def spec_of(name: str) -> TableSpec:
    """An output table or a table of the incremental state."""
    return TABLES[name] if name in TABLES else STATE[name]
