"""The batch jobs end to end on a CSV file."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.rows import transactions
from tillwise.plans import jobs
from tillwise.sinks import scratch
from tillwise.schema import FACT_COLUMNS, TABLES
from tillwise.sinks.tables import read_output, write_csv
from tillwise.sources.readers import load_transactions, read_csv_text

CHANGES = [
    {
        "transaction_ts": f"2024-{m:02d}-{d:02d} {h:02d}:00:00",
        "merchant": merchant,
        "category": category,
        "amount": 1000 * m + d,
        "card_no": f"****-****-****-{1000 + d}",
        "approval_status": "declined" if d == 9 and m == 1 else "approved",
        "card_type": "체크" if d % 2 else "신용",
        "region": "부산" if m > 6 else "서울",
        "installment_months": 3 if d == 3 else 0,
    }
    for m in range(1, 13)
    for d, h, merchant, category in ((3, 7, "CU", "식비"), (9, 15, "CGV", "문화"), (20, 22, "KT", "통신"))
]


@pytest.fixture(scope="module")
def csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("input") / "card.csv")
    rows = transactions(spark, *CHANGES).withColumn(
        "transaction_date", F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss")
    )
    write_csv(rows.select(*FACT_COLUMNS), path)
    return path


def test_load(spark, csv):
    everything, approved = load_transactions(spark, csv)
    assert (everything.count(), approved.count()) == (36, 35)
    assert dict(everything.dtypes)["amount"] == "bigint"
    assert {t for _, t in read_csv_text(spark, csv).dtypes} == {"string"}


def test_etl(spark, csv, tmp_path):
    report = jobs.run_etl(spark, csv, str(tmp_path), with_declared=True).first()
    assert (report.txn_count, report.unique_cards, report.unique_merchants) == (35, 3, 3)
    assert (report.min_date, report.max_date) == ("2024-01-03", "2024-12-20")
    total = sum(c["amount"] for c in CHANGES if c["approval_status"] == "approved")
    for name in ("daily_category_summary", "hourly_pattern", "regional_analysis", "monthly_trend"):
        stored = read_output(spark, f"{tmp_path}/{name}", name)
        assert stored.agg(F.sum("total_amount")).first()[0] == total, name
    for name in ("merchant_amount_rank", "regional_profile", "monthly_mom_growth",
                 "daily_approval_rate", "hourly_ratios", "merchant_ranking"):
        stored = read_output(spark, f"{tmp_path}/{name}", name)
        assert stored.columns == TABLES[name].schema.names
        assert stored.count() > 0
    rates = read_output(spark, f"{tmp_path}/daily_approval_rate", "daily_approval_rate")
    assert rates.filter("txn_date = '2024-01-09'").first().approval_rate == 0.0


def test_quarterly_from_csv_and_from_stored_fact(spark, csv, tmp_path):
    jobs.run_etl(spark, csv, str(tmp_path / "etl"))
    results = []
    stored = f"{tmp_path}/etl/partitioned_transactions"
    for source, kind, root in ((csv, "csv", "a"), (stored, "fact", "b")):
        report = jobs.run_quarterly(spark, source, str(tmp_path / root), 2024, kind)
        tables = {
            name: sorted(
                map(str, read_output(spark, f"{tmp_path}/{root}/2024/{name}", name).collect())
            )
            for name in jobs.QUARTERLY
        }
        results.append((report.collect(), tables))
    assert results[0] == results[1]
    assert [r.txn_count for r in results[0][0]] == [8, 9, 9, 9]
    assert all(results[0][1].values())


def test_quality(spark, csv, tmp_path):
    assert jobs.run_quality(spark, csv, str(tmp_path), as_of="2025-01-01 00:00:00") == "PASS"
    checks = read_output(spark, f"{tmp_path}/quality_report", "quality_report")
    assert checks.count() == 23
    (part,) = Path(tmp_path / "quality_report_json").glob("part-*.json")
    assert json.loads(part.read_text())["total_records"] == 36


def test_registered_tables_have_every_declared_column(spark, csv, tmp_path):
    root = str(tmp_path)
    jobs.run_etl(spark, csv, root, with_declared=True)
    jobs.run_quarterly(spark, csv, f"{root}/quarterly", 2024)
    jobs.run_quality(spark, csv, f"{root}/quality")
    names = jobs.register_outputs(
        spark, "jobs_test", root, True, f"{root}/quarterly", 2024, f"{root}/quality"
    )
    assert len(names) == len(TABLES)
    for name in names:
        table = spark.table(name)
        assert table.count() > 0, name
        stored = table.select([F.count(c).alias(c) for c in table.columns]).first().asDict()
        # growth has no predecessor in a first period; every other column has values
        assert all(n > 0 for c, n in stored.items()), (name, stored)


def test_quality_of_unparseable_amount_is_a_verdict_not_an_error(spark, tmp_path):
    path = str(tmp_path / "bad.csv")
    bad = transactions(spark, *CHANGES).withColumn(
        "transaction_date", F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss")
    ).withColumn("amount", F.lit("abc"))
    write_csv(bad.select(*FACT_COLUMNS), path)
    assert jobs.run_quality(spark, path) == "FAIL"


def _csv_of(spark, path, *changes):
    rows = transactions(spark, *changes).withColumn(
        "transaction_date", F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss")
    )
    write_csv(rows.select(*FACT_COLUMNS), path)
    return path


def test_large_amounts_are_kept(spark, tmp_path):
    big = [{"amount": 3_000_000_000, "merchant": "a"}, {"amount": 1_000, "merchant": "b"}]
    path = _csv_of(spark, str(tmp_path / "big.csv"), *big)
    everything, _ = load_transactions(spark, path)
    assert everything.agg(F.sum("amount")).first()[0] == 3_000_001_000
    assert jobs.run_quality(spark, path, str(tmp_path), as_of="2025-01-01 00:00:00") == "WARN"
    checks = read_output(spark, f"{tmp_path}/quality_report", "quality_report").collect()
    found = {r.check_name: r.issue_count for r in checks}
    assert (found["과도 금액 검사"], found["Null 검사 [amount]"]) == (1, 0)


def test_text_that_is_no_number_has_its_own_line(spark, tmp_path):
    path = str(tmp_path / "bad.csv")
    rows = transactions(spark, *CHANGES).withColumn(
        "transaction_date", F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss")
    )
    write_csv(rows.withColumn("amount", F.lit("abc")).select(*FACT_COLUMNS), path)
    jobs.run_quality(spark, path, str(tmp_path))
    checks = read_output(spark, f"{tmp_path}/quality_report", "quality_report").collect()
    found = {r.check_name: (r.issue_count, r.status) for r in checks}
    assert found["unreadable_amount"] == (36, "FAIL") and "unreadable_installment_months" not in found


def test_rule_sets_count_in_the_verdict(spark, csv, tmp_path):
    master = spark.createDataFrame([("CU",), ("CGV",)], "merchant string")
    rules = dict(as_of="2025-01-01 00:00:00", rule_sets=jobs.RULE_SETS, merchants=master)
    assert jobs.run_quality(spark, csv, str(tmp_path), **rules) == "WARN"
    checks = read_output(spark, f"{tmp_path}/quality_report", "quality_report").orderBy("check_no").collect()
    assert [r.check_no for r in checks] == list(range(1, 31))
    found = {r.check_name: r.issue_count for r in checks}
    assert found["merchant_master"] == 12  # KT
    assert found["category_amount_range"] > 0 and found["amount_step"] == 36
    with pytest.raises(ValueError, match="merchant master"):
        jobs.run_quality(spark, csv, rule_sets=["merchants"])
    with pytest.raises(ValueError, match="unknown"):
        jobs.run_quality(spark, csv, rule_sets=["colour"])


def test_one_month_again_leaves_the_others(spark, csv, tmp_path):
    root = tmp_path / "etl"
    jobs.run_etl(spark, csv, str(root))
    files = lambda month: sorted(
        (f.name, f.stat().st_mtime_ns)
        for f in (root / "partitioned_transactions/txn_year=2024" / f"txn_month={month}").glob("*.parquet")
    )
    before = {m: files(m) for m in (2, 3)}
    march = [{**c, "amount": 7} for c in CHANGES if c["transaction_ts"].startswith("2024-03")]
    again = _csv_of(spark, str(tmp_path / "march.csv"), *march)
    report = jobs.run_etl(spark, again, str(root), only_touched_partitions=True).first()
    assert report.txn_count == 35 and files(2) == before[2] and files(3) != before[3]
    monthly = read_output(spark, str(root / "monthly_trend"), "monthly_trend")
    assert {r.txn_month: r.total_amount for r in monthly.collect()}[3] == 21


def test_calendar_growth_in_the_job(spark, tmp_path):
    days = ("2023-10-05", "2024-01-05", "2024-07-05")
    path = _csv_of(
        spark,
        str(tmp_path / "in"),  # a folder of files, whatever its name
        *[{"transaction_ts": f"{d} 10:00:00", "amount": 100 * n} for n, d in enumerate(days, 1)],
    )
    jobs.run_quarterly(spark, path, str(tmp_path / "out"), 2024, calendar=True)
    growth = read_output(spark, f"{tmp_path}/out/2024/qoq_growth", "qoq_growth").collect()
    assert {r.txn_quarter: r.amount_growth_rate for r in growth} == {1: 100.0, 2: None, 3: None, 4: None}
    with pytest.raises(ValueError, match="input format"):
        jobs.run_quarterly(spark, path, str(tmp_path / "out"), 2024, "orc")


def test_jobs_leave_no_scratch_tables(spark, csv, tmp_path):
    folder = Path(scratch.shared_dir(spark).removeprefix("file:")) / "tillwise"
    before = set(folder.glob("*")) if folder.exists() else set()
    jobs.run_etl(spark, csv, str(tmp_path / "etl"), with_declared=True)
    jobs.run_quality(spark, csv, str(tmp_path / "quality"))
    jobs.run_quarterly(spark, csv, str(tmp_path / "quarterly"), 2024)
    assert set(folder.glob("*")) == before


def test_benchmark(spark, csv, tmp_path):
    report = jobs.run_benchmark(
        spark, csv, str(tmp_path), day="2024-06-20", year=2024, month=6, counts=[2, 3]
    )
    rows = {r.test_name: r for r in report.collect()}
    assert rows["csv_read"].detail == rows["parquet_read"].detail == "36 rows"
    assert rows["lookup_day_plain"].detail == rows["lookup_day_by_day"].detail == "1 rows"
    assert rows["lookup_month_by_month"].detail == "3 rows"
    assert rows["join_merge"].detail == rows["join_broadcast"].detail == "36 rows"
    assert {"aggregate_cached_2", "aggregate_repartition_3", "write_by_day"} <= set(rows)
    assert rows["csv_count"].detail == rows["parquet_count"].detail == "36 rows"
    saved = rows["csv_read"].elapsed_sec - rows["parquet_read"].elapsed_sec
    assert rows["improvement_parquet_read"].elapsed_sec == pytest.approx(saved, abs=0.002)
    assert sum(name.startswith("improvement_") for name in rows) == 4
