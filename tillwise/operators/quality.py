"""The quality suite: a table of checks, one verdict, a report and a gate.

All per-row checks are counted in a single aggregate over one scan. The two
duplicate checks need their own grouping; they read only their key columns and
add one counter each. The check table is then built from that handful of
numbers, so nothing but counts ever leaves the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.domains import CHECK_TEXTS, DECLINED, DECLINED_DETAIL, MISSING_CHECK, Rules
from tillwise.functions.calendar_cols import parse_timestamp
from tillwise.functions.measures import fixed, mean_amount, share
from tillwise.operators.joins import unknown_merchants
from tillwise.schema import FACT_COLUMNS, NUMBER_TEXTS

DOUBLE_PAYMENT_KEYS = ("transaction_date", "card_no", "amount", "merchant")


@dataclass(frozen=True)
class Check:
    """One line of the check table; `found` marks the rows that violate it."""

    key: str
    category: str
    name: str
    severity: str
    found: Column | None = None  # None: counted by grouping, not by row
    detail: str = ""
    detail_if_clean: str | None = None  # None: same text either way
    fail_share: float | None = None  # FAIL above this share of rows, else `severity`
    warn_share: float | None = None  # listed only above this share of rows
    share_detail: bool = False  # the detail states the share and its limit


def is_missing(column: str, kind: T.DataType) -> Column:
    """NULL; for text also empty or the word null."""
    text = f" or `{column}` in ('', 'null')" if isinstance(kind, T.StringType) else ""
    return F.expr(f"`{column}` is null{text}")


def not_in(column: str, allowed: tuple) -> Column:
    """Outside the allowed set. NULL is missing, not invalid: the test is NULL then."""
    return ~F.col(column).isin(*allowed)


def _now(as_of: str | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def standard_checks(df: DataFrame, rules: Rules, as_of: str | None = None) -> list[Check]:
    """The 23 fixed checks, in report order, and those listed only when they find something:
    the declined share and, where the text of the numbers is there, text that is no number."""
    parsed = parse_timestamp("transaction_date", rules.timestamp_format)
    amount = F.col("amount")

    def check(key: str, category: str, severity: str, found: Column | None, **more) -> Check:
        name, detail = CHECK_TEXTS[key]
        detail = detail.format(amount_max=rules.amount_max, categories=list(rules.categories))
        return Check(key, category, name, severity, found, detail, **more)

    missing = [
        Check(
            f"missing_{column}",
            "missing",
            MISSING_CHECK[0].format(column=column),
            "WARN",
            is_missing(column, df.schema[column].dataType),
            MISSING_CHECK[1].format(column=column),
            detail_if_clean="",
            fail_share=rules.missing_fail_share,
        )
        for column in FACT_COLUMNS
    ]
    unreadable = [
        Check(
            f"unreadable_{column}",
            "format",
            f"unreadable_{column}",
            "FAIL",
            ~is_missing(text, df.schema[text].dataType) & F.col(column).isNull(),
            warn_share=0.0,
        )
        for column, text in NUMBER_TEXTS.items()
        if text in df.columns
    ]
    return [
        *missing,
        check("duplicate_id", "duplicates", "FAIL", None, detail_if_clean=""),
        check("double_payment", "duplicates", "WARN", None, detail_if_clean=""),
        check("amount_negative", "amount", "FAIL", amount < rules.amount_min),
        check("amount_excessive", "amount", "WARN", amount > rules.amount_max),
        check("amount_zero", "amount", "WARN", amount == 0),
        check("date_format", "date", "FAIL", parsed.isNull()),
        check("date_future", "date", "WARN", parsed > _now(as_of)),
        check("category_domain", "domain", "FAIL", not_in("category", rules.categories)),
        check("card_type_domain", "domain", "FAIL", not_in("card_type", rules.card_types)),
        check("status_domain", "domain", "FAIL", not_in("approval_status", rules.statuses)),
        check("region_domain", "domain", "FAIL", not_in("region", rules.regions)),
        check("card_mask", "card", "FAIL", ~F.col("card_no").rlike(rules.card_pattern)),
        check(
            "declined_share",
            "distribution",
            "WARN",
            F.col("approval_status") == DECLINED,
            warn_share=rules.declined_warn_share,
            share_detail=True,
        ),
        *unreadable,
    ]


def duplicate_groups(df: DataFrame, keys: tuple[str, ...] = ("transaction_id",)) -> DataFrame:
    """Key values that occur more than once; NULL keys form a group like any other."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).filter("count > 1")


def duplicate_sample(df: DataFrame, top: int = 5) -> DataFrame:
    """The most repeated transaction ids."""
    return duplicate_groups(df).orderBy(F.desc("count"), "transaction_id").limit(top)


CHECK_LINES = (
    "check_no int, check_category string, check_name string, metric string, severity string, "
    "fail_share double, warn_share double, share_detail boolean, detail string, "
    "detail_if_clean string"
)


def _counts(df: DataFrame, checks: list[Check], values: dict[str, DataFrame]) -> DataFrame:
    """(metric, value) rows: one per check, and `total`."""
    by_row = [c for c in checks if c.found is not None]
    counted = df.agg(
        F.count("*").alias("total"), *[F.count_if(c.found).alias(c.key) for c in by_row]
    ).unpivot([], ["total", *[c.key for c in by_row]], "metric", "value")
    for key, value in values.items():
        counted = counted.unionAll(value.select(F.lit(key).alias("metric"), "value"))
    return counted


def _check_rows(
    df: DataFrame,
    checks: list[Check],
    as_of: str | None,
    grouped: dict[str, DataFrame] | None = None,
    counts: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """The check table: the counts looked up for each check's line. `grouped` frames are
    counted, `counts` frames hold a value."""
    lines = df.sparkSession.createDataFrame(
        [
            (
                number,
                c.category,
                c.name,
                c.key,
                c.severity,
                c.fail_share,
                c.warn_share,
                c.share_detail,
                c.detail,
                c.detail if c.detail_if_clean is None else c.detail_if_clean,
            )
            for number, c in enumerate(checks, 1)
        ],
        CHECK_LINES,
    )
    # every frame from here on has one row per check
    total = F.max(F.when(F.col("metric") == "total", F.col("value"))).over(Window.partitionBy())
    values = {key: groups.agg(F.count("*").alias("value")) for key, groups in (grouped or {}).items()}
    counts = _counts(df, checks, {**values, **(counts or {})}).withColumn("total_records", total)
    count, total = F.col("value"), F.col("total_records")
    pct = F.when(total > 0, count / total * 100).otherwise(F.lit(0.0))
    limit = F.col("warn_share") * 100
    return (
        lines.join(counts, "metric")
        .filter(F.col("warn_share").isNull() | (pct > limit))
        .select(
            "check_no",
            "check_category",
            "check_name",
            F.when(count > total * F.col("fail_share"), "FAIL")
            .when(count > 0, F.col("severity"))
            .otherwise("PASS")
            .alias("status"),
            count.alias("issue_count"),
            pct.alias("issue_pct"),
            F.concat(fixed(pct, 4), F.lit("%")).alias("issue_ratio"),
            F.when(F.col("share_detail"), F.format_string(DECLINED_DETAIL, fixed(pct, 2), fixed(limit, 0)))
            .when(count > 0, F.col("detail"))
            .otherwise(F.col("detail_if_clean"))
            .alias("detail"),
            "total_records",
            _now(as_of).alias("checked_at"),
        )
        .orderBy("check_no")
    )


def quality_checks(
    df: DataFrame,
    rules: Rules = Rules(),
    as_of: str | None = None,
    ids: DataFrame | None = None,
    payments: DataFrame | None = None,
    more: list[Check] | None = None,
) -> DataFrame:
    """The check table over all rows of a fact whose numbers were cast already.

    `as_of` is the time later than which a transaction lies in the future; by
    default now. Give one to make a run repeatable. `ids` and `payments` may be
    narrower views of the same rows for the two duplicate checks, where the fact is
    a join and those need fewer tables. `more` checks by row follow the standard ones.
    """
    checks = [*standard_checks(df, rules, as_of), *(more or [])]
    grouped = {
        "duplicate_id": duplicate_groups(df if ids is None else ids),
        "double_payment": duplicate_groups(df if payments is None else payments, DOUBLE_PAYMENT_KEYS),
    }
    return _check_rows(df, checks, as_of, grouped)


def business_rules(rules: Rules = Rules()) -> list[Check]:
    """Checks of rows that are well-formed but should not occur.

    Instalments need a credit card and a minimum amount and come in fixed plans;
    amounts are whole steps; ids follow a pattern; dates lie in the batch.
    """
    has_plan = F.col("installment_months") > 0
    entitled = (F.col("card_type") == rules.credit_type) & (
        F.col("amount") >= rules.installment_min_amount
    )
    day = F.to_date("transaction_ts")
    return [
        Check(
            "plan_not_entitled",
            "business",
            "installment_eligibility",
            "WARN",
            has_plan & ~entitled,
        ),
        Check(
            "plan_unknown",
            "business",
            "installment_plan",
            "WARN",
            not_in("installment_months", rules.installments),
        ),
        Check(
            "amount_step",
            "business",
            "amount_step",
            "WARN",
            F.col("amount") % rules.amount_step != 0,
        ),
        Check(
            "id_pattern",
            "business",
            "transaction_id_format",
            "WARN",
            ~F.col("transaction_id").rlike(rules.id_pattern),
        ),
        Check(
            "date_range",
            "business",
            "date_in_batch",
            "WARN",
            ~day.between(F.lit(rules.date_from).cast("date"), F.lit(rules.date_to).cast("date")),
        ),
    ]


def business_rule_checks(
    df: DataFrame, rules: Rules = Rules(), as_of: str | None = None
) -> DataFrame:
    """The business rules as a check table of their own."""
    return _check_rows(df, business_rules(rules), as_of)


def range_check(ranges: list[tuple[str, int, int]], rules: Rules = Rules()) -> Check:
    """Amounts outside the range of their category; categories without one are not judged."""
    slack = rules.amount_range_tolerance
    outside = F.lit(False)
    for category, low, high in ranges:
        amount = F.col("amount")
        beyond = (amount < low - slack) | (amount > high + slack)
        outside = outside | ((F.col("category") == category) & beyond)
    return Check("category_amount_range", "business", "category_amount_range", "WARN", outside)


def merchant_check(df: DataFrame, master: DataFrame, as_of: str | None = None) -> DataFrame:
    """One check line: transactions whose merchant the master lacks."""
    check = Check("merchant_master", "business", "merchant_master", "WARN")
    unknown = unknown_merchants(df, master).agg(
        F.coalesce(F.sum("txn_count"), F.lit(0)).alias("value")
    )
    return _check_rows(df, [check], as_of, counts={"merchant_master": unknown})


def stored_already(batch: DataFrame, stored: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Groups of equal keys of the batch that are stored too, with their rows in the batch.

    The batch is folded to its keys and meets the stored keys in a semi join, so neither
    a key with many rows nor a large table is brought together. Where the batch is small
    enough to be broadcast nothing stored is shuffled, and where it is not, Spark tests stored keys with
    a Bloom filter of the batch's before the shuffle (`with_key_filter`). NULL keys are no duplicates of anything.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    groups = batch.where(complete).groupBy(*keys).agg(F.count("*").alias("rows"))
    return groups.join(stored.select(*keys).where(complete), list(keys), "left_semi")


@contextmanager
def with_key_filter(spark: SparkSession) -> Iterator[None]:
    """Let Spark build Bloom filters for joins with a small side, whatever the size of the large one."""
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def history_checks(
    batch: DataFrame, stored: DataFrame, as_of: str | None = None, days: tuple[str, str] | None = None
) -> DataFrame:
    """Two check lines on a batch to be added to a stored fact: ids, and payments (time, card,
    amount, merchant), that are stored already.

    An id may be stored under any day, so of the whole fact its id column is read. Equal payments have equal
    times, so only the months of the batch are read for them: `days` are its first and last day
    (yyyy-MM-dd; else they are looked up).
    """
    if days is None:
        days = tuple(batch.agg(F.min("txn_date"), F.max("txn_date")).first())
    payments = stored
    if days[0] is not None:
        month = F.col("txn_year") * 12 + F.col("txn_month")
        years = F.col("txn_year").between(int(days[0][:4]), int(days[1][:4]))  # prunes year folders
        first, last = (int(day[:4]) * 12 + int(day[5:7]) for day in days)
        payments = stored.where(years & month.between(first, last))
    found = {
        "id_stored": stored_already(batch, stored, ("transaction_id",)),
        "payment_stored": stored_already(batch, payments, DOUBLE_PAYMENT_KEYS),
    }
    checks = [
        Check("id_stored", "duplicates", "id_stored_already", "FAIL"),
        Check("payment_stored", "duplicates", "payment_stored_already", "WARN"),
    ]
    counts = {name: groups.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("value")) for name, groups in found.items()}
    return _check_rows(batch, checks, as_of, counts=counts)


def renumbered(tables: list[DataFrame]) -> DataFrame:
    """Check tables one below the other, numbered through."""
    stacked = reduce(
        DataFrame.unionAll, (t.withColumn("_table", F.lit(n)) for n, t in enumerate(tables))
    )
    # one row per check
    in_order = Window.partitionBy(F.lit(0)).orderBy("_table", "check_no")
    return stacked.withColumn("check_no", F.row_number().over(in_order)).drop("_table").orderBy("check_no")


def unparseable_numbers(
    df: DataFrame, amount: str = "amount_raw", installment: str = "installment_raw"
) -> DataFrame:
    """How many raw texts are no numbers, next to how many are usable."""

    def broken(column: str) -> Column:
        return F.col(column).isNotNull() & F.col(column).try_cast("bigint").isNull()

    return df.agg(
        F.count("*").alias("total_records"),
        F.count(F.col(amount).try_cast("bigint")).alias("amount_ok"),
        F.count_if(broken(amount)).alias("amount_unparseable"),
        F.count(F.col(installment).try_cast("bigint")).alias("installment_ok"),
        F.count_if(broken(installment)).alias("installment_unparseable"),
        F.sum(F.col(amount).try_cast("bigint")).alias("amount_sum"),
    )


def amount_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        mean_amount(None).alias("avg_amount"),
        F.count_if(F.col("amount") < 0).alias("negative_count"),
    )


def declined_rate(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The declined count and share, only when the share is above the threshold."""
    pct = F.col("issue_count") / F.nullif("_total", F.lit(0)) * 100
    return (
        df.agg(
            F.count_if(F.col("approval_status") == DECLINED).alias("issue_count"),
            F.count("*").alias("_total"),
        )
        .filter(pct > rules.declined_warn_share * 100)
        .select(
            F.lit(DECLINED).alias("approval_status"),
            "issue_count",
            share(F.col("issue_count"), F.col("_total")).alias("declined_pct"),
        )
    )


def _overall_status() -> Column:
    code = F.when(F.col("status") == "FAIL", 2).when(F.col("status") == "WARN", 1).otherwise(0)
    worst = F.max(code)
    status = F.when(worst == 2, "FAIL").when(worst == 1, "WARN").otherwise("PASS")
    return status.alias("overall_status")


def verdict(checks: DataFrame) -> DataFrame:
    """One row: FAIL if any check failed, else WARN if any warned, else PASS."""
    return checks.agg(
        _overall_status(),
        F.count("*").alias("check_count"),
        F.count_if(F.col("status") == "PASS").alias("pass_count"),
        F.count_if(F.col("status") == "WARN").alias("warn_count"),
        F.count_if(F.col("status") == "FAIL").alias("fail_count"),
    )


def report(checks: DataFrame) -> DataFrame:
    """The whole report as one row: header, verdict and the check lines in order."""
    line = F.struct(
        "check_no",
        F.col("check_name").alias("check"),
        "status",
        "issue_count",
        "issue_ratio",
        "detail",
    )
    return checks.agg(
        F.date_format(F.max("checked_at"), "yyyy-MM-dd HH:mm:ss").alias("check_timestamp"),
        F.max("total_records").alias("total_records"),
        F.sort_array(F.collect_list(line)).alias("checks"),  # two dozen lines at most
        _overall_status(),
    )


def quality_gate(checks: DataFrame) -> str:
    """The verdict as text. The caller decides; only FAIL is meant to stop a run."""
    return verdict(checks).first()["overall_status"]
