import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.rows import fact, raw
from tillwise.domains import AMOUNT_RANGES, Rules
from tillwise.functions.measures import fixed
from tillwise.operators import joins, quality
from tillwise.sinks.tables import write_json_report
from tillwise.sources import literals

AS_OF = "2025-01-01 00:00:00"


def checks(spark, *changes):
    rows = quality.quality_checks(raw(spark, *changes), as_of=AS_OF).collect()
    return {r.check_name: r for r in rows}


def distinct(n):
    return [{"merchant": f"m{i}"} for i in range(n)]


def test_clean_data_passes(spark):
    found = checks(spark, *distinct(5))
    assert len(found) == 23
    assert {r.status for r in found.values()} == {"PASS"}
    assert {r.total_records for r in found.values()} == {5}


def test_one_percent_missing_warns_and_more_fails(spark):
    rows = distinct(200)
    rows[0]["region"] = rows[1]["region"] = None
    assert checks(spark, *rows)["Null 검사 [region]"].status == "WARN"
    rows = distinct(200)
    rows[0]["region"], rows[1]["region"], rows[2]["region"] = None, "", "null"
    line = checks(spark, *rows)["Null 검사 [region]"]
    assert (line.status, line.issue_count, line.issue_ratio) == ("FAIL", 3, "1.5000%")


def test_declined_share_is_listed_only_above_ten_percent(spark):
    rows = distinct(20)
    rows[0]["approval_status"] = rows[1]["approval_status"] = "declined"
    assert "거절률 이상 탐지" not in checks(spark, *rows)
    rows = distinct(20)
    for row in rows[:3]:
        row["approval_status"] = "declined"
    line = checks(spark, *rows)["거절률 이상 탐지"]
    assert (line.status, line.issue_count) == ("WARN", 3)
    assert line.detail == "거절률 15.00% (기준: 10% 이하)"


def test_ratios_are_rounded_from_the_exact_value(spark):
    """1 of 3200 is 0.03125 % and 388 are 12.125 %, ties that go to the even digit."""
    rows = distinct(3200)
    rows[0]["region"] = None
    for row in rows[:388]:
        row["approval_status"] = "declined"
    found = checks(spark, *rows)
    assert found["Null 검사 [region]"].issue_ratio == f"{1 / 3200 * 100:.4f}%" == "0.0312%"
    assert found["거절률 이상 탐지"].detail == "거절률 12.12% (기준: 10% 이하)"


def test_fixed_decimals_are_those_of_python(spark):
    total = 3_600_000
    ratio = (F.col("id") / total * 100).alias("ratio")
    df = spark.range(0, total, 97).select(ratio)
    found = df.select("ratio", fixed(F.col("ratio"), 4).alias("four"), fixed(F.col("ratio"), 0).alias("none")).collect()
    assert [(r.four, r.none) for r in found] == [(f"{r.ratio:.4f}", f"{r.ratio:.0f}") for r in found]


def test_null_is_missing_but_not_invalid(spark):
    found = checks(spark, {"category": None, "card_no": None, "merchant": "a"}, {"merchant": "b"})
    assert found["카테고리 유효성 검사"].issue_count == 0
    assert found["카드번호 마스킹 검사"].issue_count == 0
    assert found["Null 검사 [category]"].issue_count == 1


def test_duplicates_count_groups_and_null_ids_are_a_group(spark):
    rows = [
        {"transaction_id": "TXN1", "merchant": "a"},
        {"transaction_id": "TXN1", "merchant": "b"},
        {"transaction_id": "TXN1", "merchant": "c"},
        {"transaction_id": None, "merchant": "d"},
        {"transaction_id": None, "merchant": "e"},
    ]
    found = checks(spark, *rows)
    assert (found["거래ID 중복 검사"].issue_count, found["거래ID 중복 검사"].status) == (2, "FAIL")
    assert found["이중결제 의심 검사"].status == "PASS"
    assert checks(spark, {}, {})["이중결제 의심 검사"].status == "WARN"


def test_dates(spark):
    found = checks(
        spark,
        {"transaction_date": "2024-02-30 00:00:00", "merchant": "a"},
        {"transaction_date": "2099-01-01 00:00:00", "merchant": "b"},
        {"transaction_date": None, "merchant": "c"},
    )
    assert found["날짜 형식 검사"].issue_count == 2  # also the missing one
    assert (found["미래 날짜 검사"].issue_count, found["미래 날짜 검사"].status) == (1, "WARN")


def test_amounts(spark):
    found = checks(
        spark,
        *[{"amount": a, "merchant": str(a)} for a in (-1, 0, 1, 10_000_000, 10_000_001, None)],
    )
    lines = [found[n] for n in ("음수 금액 검사", "과도 금액 검사", "0원 거래 검사")]
    assert [(r.issue_count, r.status) for r in lines] == [(1, "FAIL"), (1, "WARN"), (1, "WARN")]


def test_empty_input(spark):
    df = quality.quality_checks(raw(spark, {}).limit(0), as_of=AS_OF)
    rows = df.collect()
    assert len(rows) == 23
    assert {(r.status, r.issue_count, r.issue_pct) for r in rows} == {("PASS", 0, 0.0)}
    assert quality.quality_gate(df) == "PASS"
    assert quality.declined_rate(raw(spark, {}).limit(0)).count() == 0


@pytest.mark.parametrize(
    "statuses, expected",
    [(["PASS", "PASS"], "PASS"), (["PASS", "WARN"], "WARN"), (["WARN", "FAIL", "PASS"], "FAIL")],
)
def test_verdict(spark, statuses, expected):
    df = spark.createDataFrame([(s,) for s in statuses], "status string")
    assert quality.quality_gate(df) == expected


def test_report_can_be_written_twice(spark, tmp_path):
    table = quality.quality_checks(raw(spark, {}, {}), as_of=AS_OF)
    for _ in range(2):
        write_json_report(quality.report(table), str(tmp_path / "report"))
    (part,) = Path(tmp_path / "report").glob("part-*.json")
    document = json.loads(part.read_text())
    assert document["overall_status"] == "WARN"
    assert document["check_timestamp"] == AS_OF
    assert [c["check_no"] for c in document["checks"]] == list(range(1, 24))


def test_report_states_ratios_rounded_from_the_exact_value(spark, tmp_path):
    rows = distinct(3200)
    rows[0]["region"] = None
    table = quality.quality_checks(raw(spark, *rows), as_of=AS_OF)
    write_json_report(quality.report(table), str(tmp_path / "report"))
    (part,) = Path(tmp_path / "report").glob("part-*.json")
    ratios = {c["check"]: c["issue_ratio"] for c in json.loads(part.read_text())["checks"]}
    assert ratios["Null 검사 [region]"] == "0.0312%"


def test_amount_range_has_rounding_tolerance(spark):
    # minimum 1,250 rounds to 1,200; 1,199 is out of range
    rows = raw(spark, *[{"category": "교통", "amount": a} for a in (1200, 1199, 150_050, 150_051)])
    ranges = literals.amount_ranges(spark, AMOUNT_RANGES)
    found = joins.outside_amount_range(rows, ranges, Rules().amount_range_tolerance).first()
    assert (found.below_count, found.above_count) == (1, 1)


def test_unknown_merchants(spark):
    master = spark.createDataFrame([("CU",)], "merchant string")
    rows = raw(spark, {}, {"merchant": "x", "amount": 3}, {"merchant": "x", "amount": 4})
    assert [tuple(r) for r in joins.unknown_merchants(rows, master).collect()] == [("x", 2, 7)]


def test_unparseable_numbers(spark):
    df = spark.createDataFrame([("1", "x"), ("abc", "2"), (None, "3")], "a string, i string")
    row = quality.unparseable_numbers(df, "a", "i").first()
    assert tuple(row) == (3, 1, 1, 2, 1, 1)


def test_business_rules(spark):
    rows = fact(
        spark,
        {"amount": 50_000, "installment_months": 3},  # as it should be
        {"amount": 50_000, "installment_months": 3, "card_type": "체크"},
        {"amount": 49_900, "installment_months": 3},
        {"amount": 60_000, "installment_months": 4},
        {"amount": 1_050},
        {"amount": 1_000, "transaction_id": "TXN1"},
        {"amount": 1_000, "transaction_ts": "2025-01-01 00:00:00"},
        {"amount": None, "transaction_ts": None, "transaction_id": None},
    )
    found = quality.business_rule_checks(rows, as_of=AS_OF).collect()
    assert [(r.check_name, r.issue_count, r.status) for r in found] == [
        ("installment_eligibility", 2, "WARN"),
        ("installment_plan", 1, "WARN"),
        ("amount_step", 1, "WARN"),
        ("transaction_id_format", 1, "WARN"),
        ("date_in_batch", 1, "WARN"),
    ]


def test_checked_at_is_the_given_time(spark):
    row = quality.quality_checks(raw(spark, {}), as_of=AS_OF).first()
    assert str(row.checked_at) == AS_OF
