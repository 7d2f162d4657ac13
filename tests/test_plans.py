"""The shape of the physical plans, which is what has to hold at scale."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tillwise.functions.sizing import broadcast_if_small, estimated_bytes
from tillwise.operators import explore, joins, layout, quality, quarterly
from tillwise.plans import registry
from tillwise.sinks.tables import write_parquet
from tillwise.sources import views

SMALL = f"{DATA}/sf0.001"


@contextlib.contextmanager
def conf(spark, **settings):
    """Set spark.sql.* entries for a while; __ stands for a dot."""
    names = {"spark.sql." + k.replace("__", "."): v for k, v in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def scans(text: str) -> list[str]:
    return re.findall(r"sf0\.001/(\w+)\.parquet", text)


def query_plan(spark, name):
    return plan(registry.QUERIES[name](spark, SMALL))


@pytest.mark.parametrize(
    "name, tables",
    [
        ("dq_duplicate_ids", ["lineitem"]),
        ("approval_distribution", ["lineitem", "orders"]),
        ("notebook_category", ["lineitem", "orders", "part"]),
        ("merchant_top15", ["lineitem", "orders", "part", "supplier"]),
        ("notebook_regional", ["lineitem", "orders", "customer", "nation", "region"]),
        ("dq_merchant_master", ["lineitem", "supplier", "supplier"]),
        ("regional_profile",
         ["lineitem", "orders", "customer", "nation", "region", "part", "supplier"]),
    ],
)
def test_each_needed_table_is_read_once(spark, name, tables):
    assert sorted(scans(query_plan(spark, name))) == sorted(tables)


def test_approved_and_year_reach_the_parquet_reader(spark, capsys):
    text = formatted(registry.QUERIES["quarterly_region"](spark, SMALL), capsys)
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    assert any("EqualTo(o_orderstatus,F)" in p for p in pushed)
    assert any("GreaterThanOrEqual(o_orderdate,1998-01-01" in p for p in pushed)
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string," in text


@pytest.mark.parametrize("name", ["hourly_pattern", "notebook_hourly", "time_slot_share"])
def test_event_approval_reaches_the_parquet_reader(spark, capsys, name):
    text = formatted(registry.QUERIES[name](spark, SMALL), capsys)
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    assert pushed and all("Not(EqualTo(event_type,error))" in p for p in pushed)


def test_calendar_growth_prunes_years(spark, tmp_path):
    fact = registry.full_fact(spark, SMALL)
    path = str(tmp_path / "fact")
    write_parquet(fact, path, ("txn_year", "txn_month"))
    stored = spark.read.schema(fact.schema).parquet(path)
    text = plan(quarterly.qoq_growth(stored, 1998, calendar=True))
    assert re.search(r"PartitionFilters: \[[^\]]*txn_year#\d+ IN \(1997,1998\)", text)


def test_duplicate_checks_read_their_own_tables(spark):
    assert scans(plan(registry.dirty(spark, SMALL, "transaction_id"))) == ["lineitem"]
    payments = registry.dirty(spark, SMALL, *quality.DOUBLE_PAYMENT_KEYS)
    assert sorted(scans(plan(payments))) == ["lineitem", "orders", "supplier"]
    assert scans(query_plan(spark, "dq_checks")).count("lineitem") == 3


def test_merge_join_spreads_a_hot_category(spark):
    fact = spark.range(4000).select(F.lit("STANDARD").alias("category"), F.col("id").alias("amount"))
    joined = joins.with_category_master(fact, registry._master(spark), "merge")
    assert joined.count() == 4000 and joined.where("priority = 1").count() == 4000
    assert "_salt" in plan(joined) and "_salt" not in joined.columns


def test_only_needed_columns_are_read(spark, capsys):
    text = formatted(registry.QUERIES["notebook_category"](spark, SMALL), capsys)
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in text


def test_day_lookup_is_pushed_down(spark, capsys):
    text = formatted(registry.QUERIES["lookup_day_plain"](spark, SMALL), capsys)
    assert "GreaterThanOrEqual(ts,2024-01-15" in text and "LessThan(ts,2024-01-16" in text


def test_top_per_group_limits_before_the_shuffle(spark):
    for name in ("quarterly_merchant_top10", "daily_top5_category"):
        assert query_plan(spark, name).count("WindowGroupLimit") == 2


def test_top_n_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in query_plan(spark, "merchant_top15")


def test_row_checks_share_one_scan(spark):
    df = registry.dirty(spark, SMALL)
    checks = [c for c in quality.standard_checks(df, registry.RULES) if c.found is not None]
    text = plan(quality._counts(df, checks, {}))
    assert scans(text).count("lineitem") == 1


def test_no_python_no_cross_join_in_any_plan(spark):
    for name, query in registry.QUERIES.items():
        text = plan(query(spark, SMALL))
        for word in ("CartesianProduct", "BroadcastNestedLoop", "PythonUDF", "ArrowEvalPython"):
            assert word not in text, (name, word)


def test_partition_folders_are_pruned(spark, tmp_path):
    fact = registry.evt(spark, SMALL)
    path = str(tmp_path / "by_day")
    write_parquet(fact, path, ("txn_date",))
    stored = spark.read.schema(fact.schema).parquet(path)
    text = plan(layout.lookup_day(stored, "2024-01-15"))
    assert re.search(r"PartitionFilters: \[[^\]]*txn_date#\d+ = 2024-01-15", text)
    scanned = layout.lookup_day(stored, "2024-01-15").select(F.input_file_name()).distinct()
    assert all("txn_date=2024-01-15" in r[0] for r in scanned.collect())


def test_join_strategies(spark):
    fact = registry.txn(spark, SMALL, "category amount", approved=False)
    master = registry._master(spark)
    with conf(spark, autoBroadcastJoinThreshold="-1"):
        broadcast = plan(joins.with_category_master(fact, master, "broadcast"))
        merge = plan(joins.with_category_master(fact, master, "merge"))
    assert broadcast.count("BroadcastHashJoin") == 1
    assert "BroadcastHashJoin" not in merge and "SortMergeJoin" in merge
    with pytest.raises(ValueError):
        joins.with_category_master(fact, master, "other")


def test_broadcast_hint_only_below_the_limit(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    dimension = spark.range(20)
    size = estimated_bytes(dimension)
    assert size >= 20 * 8
    assert hinted(broadcast_if_small(dimension, size))
    assert not hinted(broadcast_if_small(dimension, size - 1))


def test_fact_joins_do_not_broadcast_beyond_the_threshold(spark):
    with conf(spark, autoBroadcastJoinThreshold="-1"):
        text = query_plan(spark, "merchant_ranking")
    assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") == 3


def test_cached_frame_is_scanned_from_memory(spark):
    with layout.cached(registry.txn(spark, SMALL, "category amount")) as kept:
        assert "InMemoryTableScan" in plan(explore.category_rollup(kept))
    assert not kept.is_cached


def test_global_rank_has_no_single_task_sort_of_rows(spark):
    text = query_plan(spark, "merchant_amount_rank")
    # the only single-partition exchange carries one row per slice
    assert text.count("Exchange SinglePartition") == 1
    single = text[text.index("Exchange SinglePartition"):]
    assert "_slice" in single.splitlines()[1]


def test_distinct_counts_shuffle_group_and_value(spark):
    text = query_plan(spark, "regional_analysis")
    assert re.search(r"hashpartitioning\(region#\d+, category#\d+, card_no#\d+", text)


def test_unknown_view_column_is_refused(spark):
    with pytest.raises(ValueError, match="colour"):
        views.transactions(spark, SMALL, ["amount", "colour"])


def test_texts_are_made_after_the_joins(spark):
    with conf(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(registry.txn(spark, SMALL, "transaction_id card_no amount", approved=False))
    top = text.index("SortMergeJoin")
    assert 0 < text.rindex("TXN") < top and 0 < text.rindex("****") < top


def test_damaged_days_cost_one_pass_over_the_other_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(registry.jobs, "write_state", lambda _, everything, *more: seen.append(everything))
    columns = "transaction_id transaction_ts approval_status amount"
    fact = registry.txn(spark, SMALL, columns, approved=False)
    registry._rerun(spark, fact, registry.RERUN_DAYS, ("daily_totals",))
    leaves = seen[0]._jdf.queryExecution().optimizedPlan().collectLeaves()
    paths = [leaves.apply(k).relation().location().rootPaths().mkString() for k in range(leaves.size())]
    (whole,) = [p for p in paths if "rerun-input" in p]
    assert {r[0] for r in spark.read.parquet(whole).select("approval_status").distinct().collect()} == {"approved"}


def test_history_joins_the_fact_once(spark, monkeypatch):
    seen, write, check = [], registry.write_parquet, quality.history_checks
    monkeypatch.setattr(registry, "write_parquet", lambda df, *more: (seen.append(df), write(df, *more)))
    monkeypatch.setattr(quality, "history_checks", lambda *given: (seen.extend(given[:2]), check(*given))[1])
    registry.QUERIES["dq_history"](spark, SMALL)
    assert [scans(plan(df)).count("lineitem") for df in seen] == [1, 0, 0]
