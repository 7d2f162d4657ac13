"""Totals that have to agree between queries."""

from pyspark.sql import functions as F

from tests.conftest import DATA
from tillwise.operators import layout, quarterly
from tillwise.plans.registry import QUERIES, YEAR, txn

DIR = f"{DATA}/sf0.01"


def total(df, column="total_amount"):
    return df.agg(F.sum("txn_count"), F.sum(column)).first()[:]


def test_totals_agree(spark):
    report = QUERIES["etl_report"](spark, DIR).first()
    expected = (report.txn_count, report.total_amount)
    for name in (
        "daily_category_summary",
        "regional_analysis",
        "monthly_trend",
        "notebook_category",
        "notebook_monthly",
        "notebook_regional",
        "regional_profile",
        "regional_monthly_trend",
        "monthly_mom_growth",
        "merchant_amount_rank",
    ):
        assert total(QUERIES[name](spark, DIR)) == expected, name
    assert total(QUERIES["merchant_ranking"](spark, DIR), "total_revenue") == expected


def test_quarters_add_up_to_the_year(spark):
    fact = txn(spark, DIR, "transaction_id transaction_ts card_no card_type region category amount")
    year = fact.filter(F.col("txn_year") == YEAR).agg(F.count("*"), F.sum("amount")).first()[:]
    for build in (
        quarterly.quarterly_category_summary,
        quarterly.quarterly_card_type,
        quarterly.quarterly_region,
        quarterly.qoq_growth,
    ):
        assert total(build(fact, YEAR)) == year


def test_shares_add_up(spark):
    for name, column in (
        ("category_distribution", "share_pct"),
        ("approval_distribution", "share_pct"),
        ("time_slot_share", "pct"),
    ):
        assert abs(QUERIES[name](spark, DIR).agg(F.sum(column)).first()[0] - 100) < 0.5


def test_approximate_counts_are_close(spark):
    from tillwise.operators import summaries

    fact = txn(spark, DIR, "transaction_id card_no region category amount")
    exact = {(r.region, r.category): r for r in summaries.regional_analysis(fact).collect()}
    for row in summaries.regional_analysis(fact, exact=False).collect():
        twin = exact[(row.region, row.category)]
        assert row.txn_count == twin.txn_count
        assert abs(row.unique_cards - twin.unique_cards) <= 0.2 * twin.unique_cards


def test_result_does_not_depend_on_partitions(spark):
    fact = txn(spark, DIR, "category amount")
    found = layout.repartition_invariance(fact, [2, 7, 31])
    assert {r.distinct_results for r in found.collect()} == {1}
