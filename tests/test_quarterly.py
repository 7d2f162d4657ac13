from tests.rows import fact
from tillwise.operators import declared, quarterly, summaries

Q1, Q2, Q3, Q4 = (f"2024-{m:02d}-15 09:00:00" for m in (2, 5, 8, 11))


def test_ties_keep_more_than_ten(spark):
    rows = [{"transaction_ts": Q1, "merchant": f"m{i}", "amount": 100 * i} for i in range(1, 13)]
    rows.append({"transaction_ts": Q1, "merchant": "tie", "amount": 300})  # rank 10, like m3
    top = quarterly.quarterly_merchant_top(fact(spark, *rows), 2024).collect()
    assert len(top) == 11
    assert sorted(r.merchant for r in top if r["rank"] == 10) == ["m3", "tie"]


def test_growth_goes_to_previous_quarter_with_data(spark):
    rows = fact(
        spark,
        {"transaction_ts": "2023-12-01 00:00:00", "amount": 50},
        {"transaction_ts": Q1, "amount": 100},
        {"transaction_ts": Q3, "amount": 150},
    )
    found = quarterly.qoq_growth(rows, 2024).collect()
    assert [r.txn_quarter for r in found] == [1, 3]
    assert [r.prev_amount for r in found] == [None, 100]
    assert [r.amount_growth_rate for r in found] == [None, 50.0]


def test_calendar_growth_uses_calendar_predecessor(spark):
    rows = fact(
        spark,
        {"transaction_ts": "2023-12-01 00:00:00", "amount": 50},
        {"transaction_ts": Q1, "amount": 100},
        {"transaction_ts": Q3, "amount": 150},
    )
    found = quarterly.qoq_growth(rows, 2024, calendar=True).collect()
    assert [r.txn_quarter for r in found] == [1, 2, 3, 4]
    assert [r.amount_growth_rate for r in found] == [100.0, None, None, None]
    assert [r.txn_count for r in found] == [1, 0, 1, 0]
    assert [r.count_growth_rate for r in found] == [0.0, -100.0, None, -100.0]


def test_growth_over_zero_is_null(spark):
    rows = fact(
        spark,
        {"transaction_ts": Q1, "amount": 0},
        {"transaction_ts": Q2, "amount": 10},
    )
    assert quarterly.qoq_growth(rows, 2024).collect()[1].amount_growth_rate is None
    assert [r.qoq_growth_rate for r in declared.quarterly_category_qoq(rows, 2024).collect()] == [
        None,
        None,
    ]


def test_report_names_empty_quarters(spark):
    rows = fact(
        spark,
        {"transaction_ts": Q2, "amount": 10, "card_no": None},
        {"transaction_ts": Q2, "amount": 15},
    )
    found = quarterly.quarterly_report(rows, 2024).collect()
    assert [r.txn_count for r in found] == [0, 2, 0, 0]
    assert [r.note for r in found] == ["데이터 없음", None, "데이터 없음", "데이터 없음"]
    # the NULL card counts as one more card; the mean is floored
    assert (found[1].unique_cards, found[1].avg_amount, found[1].months) == (2, 12, "4-6")


def test_empty_input(spark):
    empty = fact(spark, {}).limit(0)
    report = summaries.etl_report(empty).first()
    assert (report.txn_count, report.total_amount, report.unique_cards) == (0, None, 0)
    assert quarterly.qoq_growth(empty, 2024).count() == 0
    assert [r.txn_count for r in quarterly.quarterly_report(empty, 2024).collect()] == [0] * 4


def test_monthly_growth_crosses_years(spark):
    rows = fact(
        spark,
        {"transaction_ts": "2023-12-31 00:00:00", "amount": 100},
        {"transaction_ts": "2024-01-01 00:00:00", "amount": 125},
    )
    found = declared.monthly_mom_growth(rows).collect()
    assert [(r.txn_month, r.mom_growth_rate) for r in found] == [
        ("2023-12", None),
        ("2024-01", 25.0),
    ]


def test_regional_profile(spark):
    rows = fact(
        spark,
        {"category": "a", "merchant": "x", "card_type": "신용", "amount": 10},
        {"category": "a", "merchant": "y", "card_type": "체크", "amount": 20},
        {"category": None, "merchant": "y", "card_type": "체크", "amount": None},
        {"category": "b", "merchant": None, "card_type": "신용", "amount": 31},
        {"region": None, "category": "c", "amount": 5},
    )
    found = {r.region: r for r in declared.regional_profile(rows).collect()}
    seoul = found["서울"]
    assert (seoul.txn_count, seoul.total_amount, seoul.avg_amount) == (4, 61, 20.0)
    assert (seoul.unique_merchants, seoul.top_category, seoul.credit_ratio) == (2, "a", 50.0)
    assert found[None].top_category == "c"
