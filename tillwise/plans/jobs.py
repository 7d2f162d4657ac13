"""The four batch jobs: quality gate, summaries, quarterly tables, layout benchmark.

What repeats reads Parquet written from one parse of the CSV input: a table then
only costs the columns it needs, and a lost executor costs no second parse.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.domains import AMOUNT_RANGES, CATEGORY_MASTER, Rules
from tillwise.functions.calendar_cols import between_times, in_year, parse_timestamp, with_calendar
from tillwise.functions.measures import approved
from tillwise.operators import (
    daily_state,
    declared,
    explore,
    joins,
    layout,
    quality,
    quarterly,
    summaries,
)
from tillwise.schema import BENCHMARK_REPORT
from tillwise.sinks import catalog, scratch
from tillwise.sinks.merge import Folder, months_of, replace_days
from tillwise.sinks.numbering import number_members
from tillwise.sinks.tables import (
    read_output,
    write_benchmark_report,
    write_json_report,
    write_output,
    write_parquet,
)
from tillwise.session import size_shuffles
from tillwise.sources import literals, readers

SUMMARIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily_category_summary": summaries.daily_category_summary,
    "merchant_ranking": summaries.merchant_ranking,
    "hourly_pattern": summaries.hourly_pattern,
    "regional_analysis": summaries.regional_analysis,
    "monthly_trend": summaries.monthly_trend,
}
# described by the catalog next to the summaries; these read approved transactions ...
DECLARED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "merchant_amount_rank": declared.merchant_amount_rank,
    "regional_profile": declared.regional_profile,
    "monthly_mom_growth": declared.monthly_mom_growth,
}
# ... and these the counts of all transactions
DECLARED_ALL_STATUSES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily_approval_rate": declared.daily_rate_of_counts,
    "hourly_ratios": declared.hourly_ratios_of_counts,
}
# partial results by day, from which all summaries can be made
STATE_OF_APPROVED = ("daily_totals", "daily_members", "daily_merchant_cards")
QUARTERLY: dict[str, Callable[[DataFrame, int], DataFrame]] = {
    "quarterly_category_summary": quarterly.quarterly_category_summary,
    "quarterly_merchant_top10": quarterly.quarterly_merchant_top,
    "qoq_growth": quarterly.qoq_growth,
    "quarterly_card_type": quarterly.quarterly_card_type,
    "quarterly_region": quarterly.quarterly_region,
    "quarterly_installment": quarterly.quarterly_installment,
    "quarterly_category_qoq": declared.quarterly_category_qoq,
}


def run_etl(
    spark: SparkSession,
    input_path: str,
    output: str,
    with_declared: bool = False,
    only_touched_partitions: bool = False,
) -> DataFrame:
    """Write the approved fact by month and the five summaries; return the one-row report.

    The summaries read the fact just written, not the CSV. `with_declared` adds the
    tables of `operators.declared`; two of these need all statuses and share one more
    pass over the CSV. Below {output}/state partial results by day are kept.

    With `only_touched_partitions` the input holds whole days, one or many: they
    replace what is stored for these days, all others stay. The summaries are then made from
    the partial results, so the fact is read only in the months that are touched (by
    `with_declared` for two tables as a whole). The same input can be run again as often as
    wanted. A full run must have come before, and every row must have a date.
    """
    with scratch.owned(spark):
        everything, kept = readers.load_transactions(spark, input_path)
        size_shuffles(spark, everything)
        if only_touched_partitions:
            return _rerun_days(spark, everything, output, with_declared)
        fact_path = write_output(kept, output, "partitioned_transactions")
        fact = read_output(spark, fact_path, "partitioned_transactions")
        tables = {**SUMMARIES, **(DECLARED if with_declared else {})}
        for name, summarize in tables.items():
            write_output(summarize(fact), output, name)
        write_state(spark, everything, fact, output)
        if with_declared:
            counts = read_output(spark, f"{state_root(output)}/daily_status_counts", "daily_status_counts")
            for name, summarize in DECLARED_ALL_STATUSES.items():
                write_output(summarize(counts), output, name)
    return summaries.etl_report(fact)


def state_root(output: str) -> str:
    return f"{output}/state"


def write_state(
    spark: SparkSession,
    everything: DataFrame,
    kept: DataFrame,
    output: str,
    days: Iterable[str] | None = None,
    tables: Iterable[str] = (*STATE_OF_APPROVED, "daily_status_counts"),
    grains: Iterable[str] = tuple(daily_state.GRAINS),
) -> None:
    """Write the partial results of these transactions, or put them in the place of those of
    `days`. `kept` are the approved ones."""
    root, tables, grains = state_root(output), set(tables), list(grains)
    made: dict[str, DataFrame] = {}
    if "daily_status_counts" in tables:
        made["daily_status_counts"] = daily_state.daily_status_counts(everything)
    if "daily_totals" in tables:
        made["daily_totals"] = daily_state.daily_totals(kept, grains)
    if tables & {"daily_members", "daily_merchant_cards"}:
        of_day = "daily_members" in tables and "day" in grains  # merchants are counted by day only
        members = ("card", "merchant") if of_day else ("card",)
        numbers = number_members(daily_state.members_to_number(kept, members), root)
        if "daily_members" in tables:
            made["daily_members"] = daily_state.daily_members(kept, numbers, grains)
        if "daily_merchant_cards" in tables:
            made["daily_merchant_cards"] = daily_state.daily_merchant_cards(kept, numbers)
    for name, df in made.items():
        if days is None:
            write_output(df, root, name)
        else:
            replace_days(df, root, name, days)


def read_state(spark: SparkSession, output: str, name: str) -> DataFrame:
    return read_output(spark, f"{state_root(output)}/{name}", name)


def summaries_from_state(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    """The summaries of the approved transactions, from the partial results by day."""
    totals, members, pairs = (read_state(spark, output, name) for name in STATE_OF_APPROVED)
    return {
        "daily_category_summary": daily_state.daily_category_summary(totals, members),
        "merchant_ranking": daily_state.merchant_ranking(totals, pairs),
        "hourly_pattern": daily_state.hourly_pattern(totals, members),
        "regional_analysis": daily_state.regional_analysis(totals, members),
        "monthly_trend": daily_state.monthly_trend(totals, members),
    }


def _rerun_days(spark: SparkSession, everything: DataFrame, output: str, with_declared: bool) -> DataFrame:
    """`run_etl` for whole days of a table that is already stored."""
    fact_path = f"{output}/partitioned_transactions"
    if not all(Folder(spark, path).exists() for path in (fact_path, f"{state_root(output)}/daily_status_counts")):
        raise ValueError(f"nothing to add days to: run the whole table to {output} first")
    # one parse of the batch, then read by all passes below
    everything = scratch.materialize(everything, "etl-days")
    days = [r["txn_date"] for r in everything.select("txn_date").distinct().collect()]  # calendar days
    if None in days:
        raise ValueError("rows without a readable date cannot replace a day: mend them or run the whole table")
    kept = approved(everything)
    replace_days(kept, output, "partitioned_transactions", days)
    write_state(spark, everything, kept, output, days)
    found = summaries_from_state(spark, output)
    # this table has a folder for each day: only those of the batch are written
    daily = found.pop("daily_category_summary").where(F.col("txn_date").isin(days))
    write_output(daily, output, "daily_category_summary", only_touched_partitions=True)
    written = {r["txn_date"] for r in daily.select("txn_date").distinct().collect()}
    folder = Folder(spark, f"{output}/daily_category_summary")
    for day in set(days) - written:  # no approved row is left
        folder.remove(f"txn_date={day}")
    for name, df in found.items():
        write_output(df, output, name)
    totals, members = (read_state(spark, output, name) for name in STATE_OF_APPROVED[:2])
    if with_declared:
        write_output(daily_state.monthly_mom_growth(totals, members), output, "monthly_mom_growth")
        fact = read_output(spark, fact_path, "partitioned_transactions")
        for name in ("merchant_amount_rank", "regional_profile"):
            write_output(DECLARED[name](fact), output, name)
        counts = read_state(spark, output, "daily_status_counts")
        for name, summarize in DECLARED_ALL_STATUSES.items():
            write_output(summarize(counts), output, name)
    report = daily_state.etl_report(totals, members)
    return spark.createDataFrame(report.collect(), report.schema)  # one row


def run_quarterly(
    spark: SparkSession,
    input_path: str,
    output: str,
    year: int,
    input_format: str = "csv",
    calendar: bool = False,
) -> DataFrame:
    """Write one year's quarterly tables below {output}/{year}; return the quarter report.

    The input is CSV ("csv": a file, a folder or a pattern) or the fact folder of
    `run_etl` ("fact"). The folder is read as it is, with other years' directories pruned;
    of a CSV the year is staged first, with `calendar` also the last quarter before it.
    `calendar` compares each quarter with its calendar predecessor.
    """
    if input_format not in ("csv", "fact"):
        raise ValueError(f"unknown input format: {input_format}")
    with scratch.owned(spark):
        if input_format == "csv":
            _, kept = readers.load_transactions(spark, input_path)
            size_shuffles(spark, kept)
            first = f"{year - 1}-10-01" if calendar else f"{year}-01-01"
            rows = between_times(kept, first, f"{year + 1}-01-01")
            fact = scratch.materialize(rows, f"quarterly-{year}")
        else:
            fact = read_output(spark, input_path, "partitioned_transactions")
            size_shuffles(spark, in_year(fact, year))
        tables = dict(QUARTERLY)
        if calendar:
            tables["qoq_growth"] = lambda df, y: quarterly.qoq_growth(df, y, calendar=True)
        for name, summarize in tables.items():
            write_output(summarize(fact, year), output, name, year)
        report = quarterly.quarterly_report(fact, year)
        four_quarters = report.collect()
    return spark.createDataFrame(four_quarters, report.schema)


RULE_SETS = ("standard", "business", "ranges", "merchants")


def run_quality(
    spark: SparkSession,
    input_path: str,
    output: str | None = None,
    rules: Rules = Rules(),
    as_of: str | None = None,
    rule_sets: Iterable[str] = ("standard",),
    ranges: Iterable[tuple[str, int, int]] = AMOUNT_RANGES,
    merchants: DataFrame | None = None,
    history: DataFrame | None = None,
) -> str:
    """Check a CSV file and return PASS, WARN or FAIL.

    `rule_sets` adds to the standard checks the business rules, the amount ranges of the
    categories, and the merchant master (`merchants`, with a column merchant). With
    `history`, the stored fact that the file is to be added to, ids and payments that are stored already
    are looked for. All count in the verdict. With `output` the check table and the JSON report are
    written there.
    """
    wanted = set(rule_sets)
    if not wanted <= set(RULE_SETS):
        raise ValueError(f"unknown rule sets: {sorted(wanted - set(RULE_SETS))}")
    if "merchants" in wanted and merchants is None:
        raise ValueError("the merchant checks need a merchant master")
    more = quality.business_rules(rules) if "business" in wanted else []
    if "ranges" in wanted:
        more = [*more, quality.range_check(list(ranges), rules)]
    with scratch.owned(spark):
        raw = readers.cast_numbers(readers.read_csv_text(spark, input_path))
        size_shuffles(spark, raw)
        # parsed once, read by three passes that need few columns each; removed at the end
        fact = scratch.materialize(raw, "quality-input")
        timed = fact.withColumn("transaction_ts", parse_timestamp("transaction_date"))
        tables = [quality.quality_checks(timed, rules, as_of, more=more)]
        if "merchants" in wanted:
            tables.append(quality.merchant_check(fact, merchants, as_of))
        if history is not None:
            with quality.with_key_filter(spark):
                found = quality.history_checks(with_calendar(timed), history, as_of)
                tables.append(scratch.materialize(found, "history-checks"))
        checks = tables[0] if len(tables) == 1 else quality.renumbered(tables)
        checks = scratch.materialize(checks, "quality-checks")
        if output is not None:
            write_output(checks, output, "quality_report")
            write_json_report(quality.report(checks), f"{output}/quality_report_json")
        return quality.quality_gate(checks)


def register_days(
    spark: SparkSession, database: str, etl: str, days: Iterable[str], name: str = "partitioned_transactions"
) -> None:
    """Tell the catalog which months of the fact a re-run of these days touched: their folders
    alone are looked at, the rest of the table is not listed."""
    months = [{"txn_year": year, "txn_month": month} for year, month in months_of(days)]
    catalog.refresh_partitions(spark, f"`{database}`.`{name}`", f"{etl}/{name}", months)


def register_outputs(
    spark: SparkSession,
    database: str,
    etl: str,
    with_declared: bool = False,
    quarterly: str | None = None,
    year: int | None = None,
    quality: str | None = None,
) -> list[str]:
    """Create the database at the output folder of `run_etl` and an external table for
    everything written there, and below the quarterly and quality folders if given."""
    names = ["partitioned_transactions", *SUMMARIES]
    if with_declared:
        names += [*DECLARED, *DECLARED_ALL_STATUSES]
    folders = {name: f"{etl}/{name}" for name in names}
    if quarterly is not None:
        folders.update({name: f"{quarterly}/{year}/{name}" for name in QUARTERLY})
    if quality is not None:
        folders["quality_report"] = f"{quality}/quality_report"
    catalog.create_database(spark, database, etl)
    return [catalog.register_table(spark, database, n, path) for n, path in folders.items()]


class Stopwatch:
    """Collects (test name, seconds, detail) rows."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, float, str]] = []

    def time(self, name: str, action: Callable[[], object]) -> object:
        start = time.perf_counter()
        result = action()
        seconds = round(time.perf_counter() - start, 3)
        self.rows.append((name, seconds, "" if result is None else f"{result} rows"))
        return result

    def compare(self, name: str, slow: str, fast: str) -> None:
        """Add what `fast` saves against `slow`; less than nothing if it is the slower one."""
        seconds = {test: s for test, s, _ in self.rows}
        saved = seconds[slow] - seconds[fast]
        percent = 100 * saved / seconds[slow] if seconds[slow] else 0.0
        self.rows.append((f"improvement_{name}", round(saved, 3), f"{percent:.1f} %"))


IMPROVEMENTS = (
    ("parquet_read", "csv_read", "parquet_read"),
    ("lookup_by_day", "lookup_day_plain", "lookup_day_by_day"),
    ("cached_aggregate", "aggregate_uncached_2", "aggregate_cached_2"),
    ("broadcast_join", "join_merge", "join_broadcast"),
)


def run_benchmark(
    spark: SparkSession,
    input_path: str,
    output: str,
    day: str = "2024-06-15",
    year: int = 2024,
    month: int = 6,
    category_rows: tuple[tuple[str, str, int], ...] = CATEGORY_MASTER,
    counts: list[int] | None = None,
) -> DataFrame:
    """Compare formats, layouts, caching, join strategies and partition counts.

    Every step computes its full result; the two `_read` steps decode all columns, the two
    `_count` steps only count rows. Rows named improvement_* hold the seconds saved and the
    share of the slower step. Returns the saved report.
    """
    watch = Stopwatch()

    def decode(df: DataFrame) -> int:
        found = df.agg(F.sum(F.hash("*")).alias("hashes"), F.count("*").alias("rows")).first()
        return found["rows"]

    csv = readers.read_csv(spark, input_path)
    watch.time("csv_count", csv.count)
    watch.time("csv_read", lambda: decode(csv))
    loaded = readers.with_timestamps(csv)
    plain, by_day, by_month = (f"{output}/{n}" for n in ("plain", "by_day", "by_month"))
    watch.time("write_plain", lambda: write_parquet(loaded, plain))
    fact = readers.read_parquet(spark, plain, loaded.schema)
    watch.time("parquet_count", fact.count)
    watch.time("parquet_read", lambda: decode(fact.select(*csv.columns)))
    # a day is a small folder here: a hash spread keeps all writers busy
    watch.time("write_by_day", lambda: write_parquet(fact, by_day, ("txn_date",), few_rows_per_partition=True))
    watch.time("write_by_month", lambda: write_parquet(fact, by_month, ("txn_year", "txn_month")))

    stored_by_day = readers.read_parquet(spark, by_day, loaded.schema)
    stored_by_month = readers.read_parquet(spark, by_month, loaded.schema)
    watch.time("lookup_day_plain", lambda: layout.lookup_day(fact, day).count())
    watch.time("lookup_day_by_day", lambda: layout.lookup_day(stored_by_day, day).count())
    watch.time(
        "lookup_month_by_month", lambda: layout.lookup_month(stored_by_month, year, month).count()
    )

    def rollup(df: DataFrame) -> None:
        explore.category_rollup(df).write.format("noop").mode("overwrite").save()

    for run in (1, 2):
        watch.time(f"aggregate_uncached_{run}", lambda: rollup(fact))
    with layout.cached(fact.select("category", "amount")) as kept:
        for run in (1, 2):
            watch.time(f"aggregate_cached_{run}", lambda: rollup(kept))

    master = literals.category_master(spark, category_rows)
    for strategy in ("merge", "broadcast"):
        joined = joins.with_category_master(fact, master, strategy)
        watch.time(f"join_{strategy}", lambda joined=joined: joined.count())

    narrow = fact.select("category", "amount")
    for n in counts or layout.scaled_counts(spark):
        watch.time(f"aggregate_repartition_{n}", lambda n=n: rollup(narrow.repartition(n)))

    for name, slow, fast in IMPROVEMENTS:
        watch.compare(name, slow, fast)
    path = write_benchmark_report(spark, watch.rows, output)
    return readers.read_parquet(spark, path, BENCHMARK_REPORT)
