"""The named queries: each takes (spark, data_dir) and returns a DataFrame over the
whole tables in `data_dir`."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.domains import Rules
from tillwise.functions.calendar_cols import with_calendar
from tillwise.functions.measures import approved
from tillwise.operators import (
    clustered,
    daily_state,
    declared,
    explore,
    joins,
    layout,
    quality,
    quarterly,
    summaries,
)
from tillwise.plans import jobs
from tillwise.schema import FACT_COLUMNS
from tillwise.sinks import catalog
from tillwise.sinks.merge import replace_days
from tillwise.sinks.scratch import fresh_path, materialize
from tillwise.sinks.tables import (
    output_manifest as manifest_of,
    preview,
    read_output,
    write_benchmark_report,
    write_csv,
    write_json_report,
    write_output,
    write_parquet,
)
from tillwise.sources import footers, literals, readers, views

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that stand in for the card domain on the star-schema tables.
YEAR = 1998
SHORT_YEAR = 2001  # has three quarters only
DAY, NEXT_DAY = "2024-01-15", "2024-01-16"
COMMUTE_SLOTS = (("way there", 7, 9), ("way back", 16, 18))
AS_OF = "2026-01-01 00:00:00"
CREDIT_STATUS = "O"
RULES = Rules(
    categories=("STANDARD", "ECONOMY", "MEDIUM", "PROMO", "SMALL", "LARGE"),
    card_types=("O", "F"),
    regions=("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    credit_type=CREDIT_STATUS,
    installments=(0, 3, 6),
    installment_min_amount=500_000,
    date_from="1995-06-01",
    date_to="2001-06-30",
)
# SMALL and LARGE are left out on purpose: the left join must keep their rows.
CATEGORY_GROUPS = (
    ("STANDARD", "core", 1),
    ("ECONOMY", "core", 2),
    ("MEDIUM", "core", 3),
    ("PROMO", "campaign", 4),
)
CATEGORY_RANGES = (
    ("STANDARD", 200_000, 9_000_000),
    ("ECONOMY", 150_000, 6_000_000),
    ("MEDIUM", 100_000, 8_000_000),
    ("PROMO", 500_000, 10_000_000),
    ("SMALL", 300_000, 5_000_000),
    ("LARGE", 900_000, 10_500_000),
)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def txn(spark: SparkSession, data_dir: str, columns: str, approved: bool = True) -> DataFrame:
    fact = views.transactions(spark, data_dir, columns.split(), approved)
    return with_calendar(fact) if "transaction_ts" in fact.columns else fact


def evt(spark: SparkSession, data_dir: str, approved: bool = True) -> DataFrame:
    return with_calendar(views.events(spark, data_dir, approved))


def dirty(spark: SparkSession, data_dir: str, *columns: str) -> DataFrame:
    """The damaged fact with its numbers cast, in fact columns."""
    names = {"amount": "amount_raw", "installment_months": "installment_raw"}
    raw = views.dirty_transactions(
        spark, data_dir, [names.get(c, c) for c in columns or FACT_COLUMNS]
    )
    if not columns:
        return readers.cast_numbers(raw, *names.values()).drop(*names.values())
    casts = {"amount": "bigint", "installment_months": "int"}
    numbers = {c: F.col(names[c]).try_cast(casts[c]) for c in columns if c in names}
    return raw.withColumns(numbers).select(*columns)


# --- summaries --------------------------------------------------------------


@query
def daily_category_summary(spark, d):
    fact = txn(spark, d, "transaction_id transaction_ts card_no category amount")
    return summaries.daily_category_summary(fact)


@query
def merchant_ranking(spark, d):
    fact = txn(spark, d, "transaction_id card_no merchant category sub_category amount")
    return summaries.merchant_ranking(fact)


@query
def hourly_pattern(spark, d):
    return summaries.hourly_pattern(evt(spark, d))


@query
def regional_analysis(spark, d):
    return summaries.regional_analysis(
        txn(spark, d, "transaction_id card_no region category amount")
    )


@query
def monthly_trend(spark, d):
    return summaries.monthly_trend(
        txn(spark, d, "transaction_id transaction_ts card_no merchant amount")
    )


@query
def etl_report(spark, d):
    return summaries.etl_report(txn(spark, d, "transaction_ts card_no merchant amount"))


@query
def calendar_columns(spark, d):
    return evt(spark, d, approved=False).select(
        "transaction_id",
        "txn_year",
        "txn_month",
        "txn_quarter",
        "txn_date",
        "txn_hour",
        "txn_day_of_week",
    )


@query
def quarter_label(spark, d):
    fact = txn(spark, d, "transaction_id transaction_ts", approved=False)
    return fact.select("transaction_id", "txn_date", "txn_quarter", "quarter_label")


# --- quarterly --------------------------------------------------------------


@query
def quarterly_category_summary(spark, d):
    fact = txn(spark, d, "transaction_id transaction_ts card_no category amount")
    return quarterly.quarterly_category_summary(fact, YEAR)


@query
def quarterly_merchant_top10(spark, d):
    fact = txn(spark, d, "transaction_id transaction_ts card_no merchant category amount")
    return quarterly.quarterly_merchant_top(fact, YEAR)


@query
def qoq_growth(spark, d):
    return quarterly.qoq_growth(txn(spark, d, "transaction_id transaction_ts card_no amount"), YEAR)


@query
def qoq_growth_calendar(spark, d):
    fact = txn(spark, d, "transaction_id transaction_ts card_no amount")
    return quarterly.qoq_growth(fact, SHORT_YEAR, calendar=True)


@query
def quarterly_card_type(spark, d):
    fact = txn(spark, d, "transaction_id transaction_ts card_type amount")
    return quarterly.quarterly_card_type(fact, YEAR)


@query
def quarterly_region(spark, d):
    fact = txn(spark, d, "transaction_id transaction_ts region amount")
    return quarterly.quarterly_region(fact, YEAR)


@query
def quarterly_installment(spark, d):
    fact = txn(spark, d, "transaction_id transaction_ts installment_months amount")
    return quarterly.quarterly_installment(fact, YEAR)


@query
def quarterly_report(spark, d):
    fact = txn(spark, d, "transaction_ts card_no merchant amount")
    return quarterly.quarterly_report(fact, SHORT_YEAR)


# --- exploration ------------------------------------------------------------


@query
def notebook_category(spark, d):
    return explore.by_category(txn(spark, d, "category amount"))


@query
def notebook_hourly(spark, d):
    return explore.by_hour(evt(spark, d))


@query
def notebook_monthly(spark, d):
    return explore.by_month(txn(spark, d, "transaction_ts amount"))


@query
def notebook_regional(spark, d):
    return explore.by_region(txn(spark, d, "region amount"))


@query
def merchant_top15(spark, d):
    return explore.top_merchants(txn(spark, d, "merchant category amount"))


@query
def notebook_summary(spark, d):
    return explore.summary(txn(spark, d, "card_no merchant amount"))


@query
def amount_describe(spark, d):
    return explore.amount_describe(txn(spark, d, "amount"))


@query
def category_distribution(spark, d):
    return explore.category_distribution(txn(spark, d, "category amount", approved=False))


@query
def approval_distribution(spark, d):
    return explore.approval_distribution(txn(spark, d, "approval_status", approved=False))


@query
def preview_merchants(spark, d):
    fact = txn(spark, d, "transaction_id card_no merchant category sub_category amount")
    ranked = summaries.merchant_ranking(fact)
    return preview(
        ranked.orderBy(F.desc("total_revenue"), "merchant", "category", "sub_category"), 15
    )


# --- declared tables and sample queries -------------------------------------


@query
def daily_approval_rate(spark, d):
    return declared.daily_approval_rate(
        txn(spark, d, "transaction_id transaction_ts category approval_status", approved=False)
    )


@query
def merchant_amount_rank(spark, d):
    return declared.merchant_amount_rank(
        txn(spark, d, "transaction_id card_no merchant category amount")
    )


@query
def hourly_ratios(spark, d):
    return declared.hourly_ratios(evt(spark, d, approved=False))


@query
def hourly_ratios_by_commute(spark, d):
    """The same with another table of slots."""
    return declared.hourly_ratios(
        evt(spark, d, approved=False), slots=COMMUTE_SLOTS, rest="rest of the day"
    )


@query
def regional_profile(spark, d):
    fact = txn(spark, d, "transaction_id region category merchant card_type amount")
    return declared.regional_profile(fact, CREDIT_STATUS)


@query
def monthly_mom_growth(spark, d):
    return declared.monthly_mom_growth(
        txn(spark, d, "transaction_id transaction_ts card_no merchant amount")
    )


@query
def quarterly_category_qoq(spark, d):
    fact = txn(spark, d, "transaction_id transaction_ts category amount")
    return declared.quarterly_category_qoq(fact, YEAR)


@query
def daily_top5_category(spark, d):
    fact = txn(spark, d, "transaction_id transaction_ts card_no category amount")
    return declared.daily_top_categories(summaries.daily_category_summary(fact))


@query
def time_slot_share(spark, d):
    return declared.time_slot_share(summaries.hourly_pattern(evt(spark, d)))


@query
def regional_monthly_trend(spark, d):
    return declared.regional_monthly_trend(
        txn(spark, d, "transaction_id transaction_ts region amount")
    )


# --- joins ------------------------------------------------------------------


def _master(spark):
    return literals.category_master(spark, CATEGORY_GROUPS)


def _by_group(joined):
    return joined.groupBy("category_group", "priority").agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("total_amount")
    )


@query
def join_category_left(spark, d):
    fact = txn(spark, d, "transaction_id category amount", approved=False)
    return joins.with_category_master(fact, _master(spark))


@query
def join_category_broadcast(spark, d):
    fact = txn(spark, d, "category amount", approved=False)
    return _by_group(joins.with_category_master(fact, _master(spark), "broadcast"))


@query
def join_category_merge(spark, d):
    # folded first: the join moves one row per category, not the fact by six values
    fact = txn(spark, d, "category amount", approved=False)
    folded = fact.groupBy("category").agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("total_amount")
    )
    joined = joins.with_category_master(folded, _master(spark), "merge")
    return joined.groupBy("category_group", "priority").agg(
        F.sum("txn_count").alias("txn_count"), F.sum("total_amount").alias("total_amount")
    )


@query
def dq_merchant_master(spark, d):
    fact = txn(spark, d, "merchant amount", approved=False)
    return joins.unknown_merchants(fact, views.merchant_master(spark, d))


@query
def dq_category_amount_range(spark, d):
    fact = txn(spark, d, "category amount", approved=False)
    return joins.outside_amount_range(
        fact, literals.amount_ranges(spark, CATEGORY_RANGES), RULES.amount_range_tolerance
    )


# --- quality ----------------------------------------------------------------


def _checks(spark, d):
    """Three passes, each over the tables its columns need; nothing is staged."""
    return quality.quality_checks(
        dirty(spark, d),
        RULES,
        AS_OF,
        ids=dirty(spark, d, "transaction_id"),
        payments=dirty(spark, d, *quality.DOUBLE_PAYMENT_KEYS),
    )


@query
def dq_checks(spark, d):
    return _checks(spark, d).drop("checked_at")


@query
def dq_verdict(spark, d):
    return quality.verdict(_checks(spark, d))


@query
def dq_report_json(spark, d):
    """Written as one JSON document, read back, one row per check line."""
    path = fresh_path(spark, "quality-report")
    document = quality.report(_checks(spark, d))
    write_json_report(document, path)
    return (
        spark.read.schema(document.schema)
        .json(path)
        .select("total_records", "overall_status", F.inline("checks"))
    )


@query
def dq_duplicate_ids(spark, d):
    return quality.duplicate_groups(dirty(spark, d, "transaction_id"))


@query
def dq_duplicate_sample(spark, d):
    return quality.duplicate_sample(txn(spark, d, "transaction_id", approved=False))


@query
def dq_double_payment(spark, d):
    same_hour = ("txn_date", "txn_hour", "card_no", "category")
    return quality.duplicate_groups(evt(spark, d, approved=False), same_hour)


@query
def dq_declined_rate(spark, d):
    return quality.declined_rate(txn(spark, d, "approval_status", approved=False), RULES)


@query
def dq_business_rules(spark, d):
    fact = txn(
        spark,
        d,
        "transaction_id transaction_ts card_type amount installment_months",
        approved=False,
    )
    return quality.business_rule_checks(fact, RULES, AS_OF).drop("checked_at")


@query
def amount_stats(spark, d):
    return quality.amount_stats(dirty(spark, d, "amount"))


@query
def csv_raw_try_cast(spark, d):
    path = fresh_path(spark, "raw-csv")
    raw = views.dirty_transactions(spark, d).withColumnsRenamed(
        {"amount_raw": "amount", "installment_raw": "installment_months"}
    )
    write_csv(raw.select(*FACT_COLUMNS), path)
    return quality.unparseable_numbers(
        readers.read_csv_text(spark, path), "amount", "installment_months"
    )


# --- sinks, catalog and layout ----------------------------------------------


def full_fact(spark: SparkSession, d: str, approved: bool = True) -> DataFrame:
    """All columns of `partitioned_transactions`."""
    fact = txn(spark, d, " ".join(views.TXN_COLUMNS), approved)
    return fact.withColumn("transaction_date", F.col("transaction_ts").cast("string"))


@query
def csv_parquet_roundtrip(spark, d):
    root = fresh_path(spark, "roundtrip")
    write_csv(full_fact(spark, d, approved=False).select(*FACT_COLUMNS), f"{root}/csv")
    loaded, _ = readers.load_transactions(spark, f"{root}/csv")
    write_parquet(loaded, f"{root}/parquet")
    return readers.read_parquet(spark, f"{root}/parquet", loaded.schema).select(
        *FACT_COLUMNS, "txn_date", "txn_quarter"
    )


def _written(df: DataFrame, name: str, year: int | None = None) -> DataFrame:
    path = write_output(df, fresh_path(df.sparkSession, "output"), name, year)
    return read_output(df.sparkSession, path, name)


@query
def sink_by_day(spark, d):
    return _written(daily_category_summary(spark, d), "daily_category_summary")


@query
def sink_by_region(spark, d):
    return _written(regional_analysis(spark, d), "regional_analysis")


@query
def sink_by_quarter(spark, d):
    return _written(quarterly_category_summary(spark, d), "quarterly_category_summary", YEAR)


@query
def partitioned_transactions(spark, d):
    kept = _written(full_fact(spark, d), "partitioned_transactions")
    return kept.drop("transaction_ts")


# --- days run again ---------------------------------------------------------
# Each query stores all transactions with some days damaged (amounts doubled, every other row
# missing, some rows too many), then replaces these days by the true ones and answers from what is
# stored. The result must be that of a run over the true transactions.

RERUN_DAYS = ("1998-06-10", "1998-06-30")
RERUN_EVENT_DAYS = ("2024-01-10", "2024-01-12")


def _rerun(spark: SparkSession, fact: DataFrame, days: tuple[str, str], tables: tuple[str, ...], grains=()) -> str:
    """Store `fact` (all statuses) as above; returns the output folder.

    Where no table counts other statuses, the approved rows are picked before the joined fact is written.
    The days to run again are written apart, so that the passes over the damaged table read each of its
    other rows once."""
    output = fresh_path(spark, "rerun")
    again = F.col("txn_date").between(*days)
    if "daily_status_counts" not in tables:
        fact = approved(fact)
    fact = materialize(fact, "rerun-input")
    batch = materialize(fact.where(again), "rerun-batch")
    doubled = batch.where(F.xxhash64("transaction_id") % 2 == 0).withColumn("amount", F.col("amount") * 2)
    extra = batch.where(F.xxhash64("transaction_id") % 5 == 0).withColumn("transaction_id", F.concat(F.lit("+"), "transaction_id"))
    damaged = fact.where(~again).unionByName(doubled).unionByName(extra)
    replaced = [r["txn_date"] for r in batch.select("txn_date").distinct().collect()]
    of_fact = "partitioned_transactions" in tables
    state = [name for name in tables if name != "partitioned_transactions"]
    if of_fact:
        write_output(approved(damaged), output, "partitioned_transactions")
        replace_days(approved(batch), output, "partitioned_transactions", replaced)
    if state:
        jobs.write_state(spark, damaged, approved(damaged), output, None, state, grains)
        jobs.write_state(spark, batch, approved(batch), output, replaced, state, grains)
    return output


@query
def etl_day_rerun(spark, d):
    """The stored fact after some days of it were run again."""
    output = _rerun(spark, full_fact(spark, d, approved=False), RERUN_DAYS, ("partitioned_transactions",))
    kept = read_output(spark, f"{output}/partitioned_transactions", "partitioned_transactions")
    return kept.drop("transaction_ts")


@query
def rerun_daily_approval_rate(spark, d):
    columns = "transaction_id transaction_ts category card_type amount approval_status"
    fact = txn(spark, d, columns, approved=False)
    output = _rerun(spark, fact, RERUN_DAYS, ("daily_status_counts",))
    return declared.daily_rate_of_counts(jobs.read_state(spark, output, "daily_status_counts"))


@query
def rerun_hourly_ratios(spark, d):
    output = _rerun(spark, evt(spark, d, approved=False), RERUN_EVENT_DAYS, ("daily_status_counts",))
    return declared.hourly_ratios_of_counts(jobs.read_state(spark, output, "daily_status_counts"))


def _state(spark: SparkSession, d: str, columns: str, *grains: str, tables: tuple[str, ...] = ("daily_totals", "daily_members")):
    """The partial results of approved transactions at some grains after days were run again."""
    fact = txn(spark, d, f"transaction_id transaction_ts approval_status amount {columns}", approved=False)
    used = [*daily_state.DAY, "transaction_id", "approval_status", "amount", *columns.split()]
    output = _rerun(spark, fact.select(*used), RERUN_DAYS, tables, grains)
    return [jobs.read_state(spark, output, name) for name in tables]


@query
def rerun_daily_category(spark, d):
    return daily_state.daily_category_summary(*_state(spark, d, "card_no category", "category"))


@query
def rerun_hourly_pattern(spark, d):
    tables = ("daily_totals", "daily_members")
    output = _rerun(spark, evt(spark, d, approved=False), RERUN_EVENT_DAYS, tables, ("hour",))
    return daily_state.hourly_pattern(*[jobs.read_state(spark, output, name) for name in tables])


@query
def rerun_regional_analysis(spark, d):
    return daily_state.regional_analysis(*_state(spark, d, "card_no region category", "region"))


@query
def rerun_monthly_trend(spark, d):
    return daily_state.monthly_trend(*_state(spark, d, "card_no merchant", "day"))


@query
def rerun_monthly_mom_growth(spark, d):
    return daily_state.monthly_mom_growth(*_state(spark, d, "card_no merchant", "day"))


@query
def rerun_merchant_ranking(spark, d):
    tables = ("daily_totals", "daily_merchant_cards")
    found = _state(spark, d, "card_no merchant category sub_category", "merchant", tables=tables)
    return daily_state.merchant_ranking(*found)


@query
def rerun_etl_report(spark, d):
    return daily_state.etl_report(*_state(spark, d, "card_no merchant", "day"))


@query
def rerun_quarterly_category(spark, d):
    found = _state(spark, d, "card_no category", "category")
    return daily_state.quarterly_category_summary(*found, YEAR)


@query
def rerun_quarterly_region(spark, d):
    (totals,) = _state(spark, d, "region category", "region", tables=("daily_totals",))
    return daily_state.quarterly_region(totals, YEAR)


@query
def rerun_qoq_growth(spark, d):
    return daily_state.qoq_growth(*_state(spark, d, "card_no", "day"), YEAR)


@query
def dq_history(spark, d):
    """A batch (the transactions of one year) against all that was stored before it. Every seventh order
    of the batch is stored too, and a payment of every eleventh under another id."""
    columns = "transaction_id transaction_ts card_no merchant amount"
    fact = txn(spark, d, columns, approved=False).withColumn("transaction_date", F.col("transaction_ts").cast("string"))
    number = F.substring("transaction_id", 4, 9).cast("bigint")  # of the order
    kept = ("transaction_id", *quality.DOUBLE_PAYMENT_KEYS, "txn_year", "txn_month")

    def entry(role, where, **other):
        values = [other.get(c, F.col(c)).alias(c) for c in kept]
        return F.when(where, F.struct(F.lit(role).alias("role"), *values))

    old, new = F.col("txn_year") < YEAR, F.col("txn_year") == YEAR
    # under another day, as ids come back
    elsewhere = {"txn_year": F.lit(YEAR - 3), "txn_month": F.lit(1), "transaction_date": F.lit("")}
    entries = [
        entry("stored", old),
        entry("stored", new & (number % 7 == 0), **elsewhere),
        entry("stored", new & (number % 11 == 0), transaction_id=F.concat(F.lit("OLD"), "transaction_id")),
        entry("batch", new),
    ]
    # the joined rows make all their entries at once: one pass, and the checks read what it wrote
    rows = fact.where(old | new).select(F.inline(F.array_compact(F.array(*entries))))
    path = fresh_path(spark, "history")
    write_parquet(rows, path, ("role", "txn_year", "txn_month"))
    written = readers.read_parquet(spark, path, rows.schema)
    batch, stored = (written.where(F.col("role") == role).drop("role") for role in ("batch", "stored"))
    with quality.with_key_filter(spark):
        checks = quality.history_checks(batch, stored, AS_OF, (f"{YEAR}-01-01", f"{YEAR}-12-31"))
        return materialize(checks.drop("checked_at"), "history-checks")


CARD = "****-****-****-1037"


@query
def lookup_card_clustered(spark, d):
    """All transactions of one card from files clustered by card."""
    path = fresh_path(spark, "by-card")
    fact = txn(spark, d, "transaction_id card_no category amount", approved=False)
    clustered.write_clustered(fact, path, "card_no", ("transaction_id",))
    return clustered.lookup_value(readers.read_parquet(spark, path, fact.schema), "card_no", CARD)


@query
def bucketed_merchant_join(spark, d):
    """Transactions joined with the merchant master in buckets, with no shuffle under the join."""
    root = fresh_path(spark, "buckets")
    fact = txn(spark, d, "merchant category amount", approved=False)
    master = views.merchant_master(spark, d).withColumn("good", F.lit(True))
    with _database(spark, root) as database:
        names = [f"`{database}`.facts", f"`{database}`.master"]
        for df, name in ((fact, names[0]), (master, names[1])):
            clustered.write_bucketed(df, name, "merchant", 16, f"{root}/{name.split('.')[-1]}")
        joined = clustered.bucketed_join(spark, *names, "merchant")
        found = joined.groupBy("category", F.coalesce("good", F.lit(False)).alias("in_master")).agg(
            F.count("*").alias("txn_count"), F.sum("amount").alias("total_amount")
        )
        return materialize(found, "bucket-result")


@query
def catalog_touched_months(spark, d):
    """A registered table to which months are added: the catalog is told which, no folder is listed."""
    root, name = fresh_path(spark, "catalog"), "partitioned_transactions"
    fact = materialize(full_fact(spark, d), "catalog-input")
    new = F.col("txn_year") == YEAR
    path = write_output(fact.where(~new), root, name)
    with _database(spark, root) as database:
        table = catalog.register_table(spark, database, name, path)
        batch = fact.where(new)
        days = [r["txn_date"] for r in batch.select("txn_date").distinct().collect()]
        catalog.refresh_partitions(spark, table, path, replace_days(batch, root, name, days))
        by_month = (
            readers.read_table(spark, table)
            .groupBy("txn_year", "txn_month", "category")
            .agg(F.count("transaction_id").alias("txn_count"), F.sum("amount").alias("total_amount"))
        )
        return materialize(by_month, "catalog-result")


@query
def footer_profile(spark, d):
    """Rows, nulls, minimum and maximum of stored columns, from the files' footers alone."""
    path = fresh_path(spark, "footers")
    fact = txn(spark, d, "transaction_id merchant amount", approved=False)
    clustered.write_clustered(fact, path, "amount")
    whole = F.col("column") == "amount"
    low, high = (F.when(whole, F.col(c)).cast("bigint") for c in ("minimum", "maximum"))
    stored = footers.row_groups(spark, path).withColumns({"low": low, "high": high})
    return stored.groupBy(F.col("column").alias("column_name")).agg(
        F.sum("rows").alias("row_count"),
        F.sum("nulls").alias("null_count"),
        F.min("minimum").alias("min_text"),
        F.max("maximum").alias("max_text"),
        F.min("low").alias("min_amount"),
        F.max("high").alias("max_amount"),
    ).withColumns({c: F.when(F.col("column_name") != "amount", F.col(c)) for c in ("min_text", "max_text")})


@query
def output_manifest(spark, d):
    """Files of each written table, and whether their bytes are those the table's own scan
    names. The root has a folder that repeats its name and a plus sign, and one table lies
    below a year. A summary has one file in each of its partition folders."""
    root = f"{fresh_path(spark, 'manifest')}/a+b"
    outputs = {
        "regional_analysis": (regional_analysis(spark, d), None),
        f"{YEAR}/quarterly_category_summary": (quarterly_category_summary(spark, d), YEAR),
        "a+b/regional_analysis": (regional_analysis(spark, d), None),
    }
    stored = []
    for table, (df, year) in outputs.items():
        name = table.split("/")[-1]
        below = f"{root}/a+b" if table.startswith("a+b/") else root
        kept = read_output(spark, write_output(df, below, name, year), name)
        sizes = kept.groupBy("_metadata.file_path").agg(
            F.max("_metadata.file_size").alias("size"), F.count("*").alias("rows")
        )
        stored.append(
            sizes.agg(
                F.sum("size").alias("scanned"),
                F.sum("rows").alias("rows"),
                F.bool_and(F.endswith("file_path", F.lit(".snappy.parquet"))).alias("snappy"),
            ).withColumn("table_name", F.lit(table))
        )
    tables = manifest_of(spark, root, depth=2).withColumn(
        "table_name", F.regexp_replace("table_name", "^regional_analysis/.*", "regional_analysis")
    )
    return (
        tables.groupBy("table_name")
        .agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
        .join(reduce(DataFrame.unionByName, stored), "table_name")
        .select("table_name", "files", (F.col("bytes") == F.col("scanned")).alias("bytes_match"), "snappy", "rows")
    )


@contextmanager
def _database(spark: SparkSession, root: str):
    """A database of its own at `root`, dropped at the end; the tables' files stay."""
    name = f"tillwise_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, root)
    try:
        yield name
    finally:
        catalog.drop_database(spark, name)


@query
def catalog_external_table(spark, d):
    name = "partitioned_transactions"
    root = fresh_path(spark, "catalog")
    path = write_output(full_fact(spark, d), root, name)
    with _database(spark, root) as database:
        table = catalog.register_table(spark, database, name, path)
        catalog.refresh(spark, table)
        by_month = (
            readers.read_table(spark, table)
            .groupBy("txn_year", "txn_month", "category")
            .agg(F.count("transaction_id").alias("txn_count"), F.sum("amount").alias("total_amount"))
        )
        return materialize(by_month, "catalog-result")


@query
def catalog_tables(spark, d):
    """Unpartitioned external tables, one of them refreshed after its folder was rewritten."""
    root = fresh_path(spark, "catalog")
    fact = txn(spark, d, "transaction_id transaction_ts card_no merchant amount")
    region = txn(spark, d, "transaction_id transaction_ts region amount")
    outputs = {
        "hourly_pattern": (hourly_pattern(spark, d), None),
        "monthly_trend": (summaries.monthly_trend(fact), None),
        "qoq_growth": (quarterly.qoq_growth(fact, YEAR), YEAR),
        "quarterly_region": (quarterly.quarterly_region(region, YEAR), YEAR),
    }
    paths = {name: write_output(df, root, name, year) for name, (df, year) in outputs.items()}
    with _database(spark, root) as database:
        tables = {n: catalog.register_table(spark, database, n, p) for n, p in paths.items()}
        for table in tables.values():
            readers.read_table(spark, table).count()  # now its file listing is known
        write_output(quarterly.quarterly_region(region, SHORT_YEAR), root, "quarterly_region", YEAR)
        catalog.refresh(spark, tables["quarterly_region"])
        counted = [
            readers.read_table(spark, table)
            .agg(F.count("*").alias("rows"), F.sum("txn_count").alias("txn_count"))
            .withColumn("table_name", F.lit(name))
            for name, table in tables.items()
        ]
        return materialize(reduce(DataFrame.unionAll, counted), "catalog-result")


@query
def catalog_comments(spark, d):
    """Columns of a registered table with their comments, and how many rows have a value."""
    root = fresh_path(spark, "catalog")
    name = "regional_analysis"
    path = write_output(regional_analysis(spark, d), root, name)
    with _database(spark, root) as database:
        table = catalog.register_table(spark, database, name, path)
        described = [(c.name, c.description, c.isPartition) for c in spark.catalog.listColumns(table)]
        stored = readers.read_table(spark, table)
        filled = stored.agg(*[F.count(c).alias(c) for c in stored.columns]).unpivot(
            [], stored.columns, "column_name", "filled"
        )
        lines = spark.createDataFrame(described, "column_name string, comment string, is_partition boolean")
        return materialize(lines.join(filled, "column_name"), "catalog-result")


LOOKUP_COLUMNS = ("transaction_id", "card_no", "category", "amount", "txn_date")


@query
def lookup_day_plain(spark, d):
    found = layout.lookup_day_by_time(evt(spark, d, approved=False), DAY, NEXT_DAY)
    return found.select(*LOOKUP_COLUMNS)


@query
def lookup_day_partitioned(spark, d):
    path = fresh_path(spark, "by-day")
    stored = evt(spark, d, approved=False).select(*LOOKUP_COLUMNS)
    write_parquet(stored, path, ("txn_date",))
    return layout.lookup_day(readers.read_parquet(spark, path, stored.schema), DAY)


@query
def lookup_month_partitioned(spark, d):
    path = fresh_path(spark, "by-month")
    fact = txn(spark, d, "transaction_id transaction_ts category amount", approved=False)
    stored = fact.select("transaction_id", "category", "amount", "txn_year", "txn_month")
    write_parquet(stored, path, ("txn_year", "txn_month"))
    return layout.lookup_month(readers.read_parquet(spark, path, stored.schema), YEAR, 6)


@query
def cached_reuse(spark, d):
    """The same roll-up twice over one cached frame, with how often each row came out."""
    with layout.cached(txn(spark, d, "category amount")) as narrow:
        runs = [
            materialize(explore.category_rollup(narrow), f"cached-run-{n}") for n in range(2)
        ]
    both = reduce(DataFrame.unionAll, runs)
    return both.groupBy("category", "txn_count", "total_amount").agg(F.count("*").alias("runs"))


@query
def category_rollup_for_cache(spark, d):
    return explore.category_rollup(txn(spark, d, "category amount"))


@query
def repartition_invariance(spark, d):
    fact = txn(spark, d, "category amount")
    return layout.repartition_invariance(fact, layout.scaled_counts(spark))


@query
def partition_profile(spark, d):
    """Rows dealt in turn to 16 partitions: none is missing, none has much more than its share."""
    summary = layout.partition_summary(txn(spark, d, "category amount").repartition(16))
    return summary.select(
        "total_rows", "partitions", (F.col("max_rows") <= F.col("total_rows") / 16 * 1.5 + 16).alias("even")
    )


@query
def benchmark_report_roundtrip(spark, d):
    """Timed variants of one join and one aggregate, saved as a report and read back.

    Elapsed times are in the saved report; here only what must not vary.
    """
    fact = txn(spark, d, "category amount", approved=False)
    variants = {
        "join_merge": joins.with_category_master(fact, _master(spark), "merge"),
        "join_broadcast": joins.with_category_master(fact, _master(spark), "broadcast"),
        "aggregate": explore.category_rollup(fact),
    }
    rows = []
    for name, df in variants.items():
        start = time.perf_counter()
        found = df.count()
        rows.append((name, time.perf_counter() - start, f"{found} rows"))
    path = write_benchmark_report(spark, rows, fresh_path(spark, "benchmark"))
    saved = readers.read_parquet(spark, path, literals.BENCHMARK_REPORT)
    return saved.select("test_name", "detail", (F.col("elapsed_sec") > 0).alias("timed"))
