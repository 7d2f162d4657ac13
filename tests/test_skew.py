"""Data where one key of every kind holds a third of the rows, joined without broadcasts."""

import pytest

from tests.compare import TABLES, connect, duck_rows, spark_rows
from tests.conftest import DATA
from tests.test_plans import conf, plan
from tillwise.plans import registry
from tillwise.plans.oracles import oracle_sql

SOURCE = f"{DATA}/sf0.001"


def hot(test: str, key: str, column: str) -> str:
    return f"CASE WHEN {test} % 3 = 0 THEN {key} ELSE {column} END AS {column}"


LINE = "hash(l_orderkey, l_linenumber, {})"
HOT = {
    "lineitem": [
        hot(LINE.format(1), "7", "l_orderkey"),
        hot(LINE.format(2), "5", "l_partkey"),
        hot(LINE.format(3), "3", "l_suppkey"),
    ],
    "orders": [
        hot("hash(o_orderkey)", "11", "o_custkey"),
        "CASE WHEN o_orderkey = 7 THEN 'F' ELSE o_orderstatus END AS o_orderstatus",
    ],
    "events": [hot("event_id", "'view'", "event_type")],
}
QUERIES = [
    "daily_category_summary",
    "merchant_ranking",
    "regional_analysis",
    "monthly_trend",
    "etl_report",
    "quarterly_merchant_top10",
    "quarterly_report",
    "regional_profile",
    "merchant_amount_rank",
    "join_category_left",
    "join_category_merge",
    "dq_merchant_master",
    "dq_checks",
    "dq_duplicate_ids",
    "dq_duplicate_sample",
    "partitioned_transactions",
    "hourly_pattern",
]
NO_BROADCAST = {
    "autoBroadcastJoinThreshold": "-1",
    "adaptive__autoBroadcastJoinThreshold": "-1",
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "4k",
    "adaptive__skewJoin__skewedPartitionFactor": "1.1",
    "adaptive__advisoryPartitionSizeInBytes": "8k",
    "adaptive__forceOptimizeSkewedJoin": "true",
    # several scan tasks, as any large table has: a hot partition is split by them
    "files__maxPartitionBytes": "20k",
    "files__openCostInBytes": "0",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    source = connect(SOURCE)
    for name in TABLES:
        columns = f"* REPLACE ({', '.join(HOT[name])})" if name in HOT else "*"
        source.execute(
            f"COPY (SELECT {columns} FROM {name}) TO '{folder}/{name}.parquet' "
            "(ROW_GROUP_SIZE 2048)"
        )
    return str(folder), connect(str(folder))


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, skewed, name):
    folder, connection = skewed
    with conf(spark, **NO_BROADCAST):
        found = spark_rows(registry.QUERIES[name](spark, folder))
    assert found == duck_rows(connection, oracle_sql()[name])


def test_hot_keys_are_split(spark, skewed):
    folder, _ = skewed
    with conf(spark, **NO_BROADCAST):
        df = registry.QUERIES["merchant_top15"](spark, folder)
        df.collect()
        assert "skew=true" in plan(df)
        merge = registry.QUERIES["join_category_merge"](spark, folder)
        merge.collect()
        assert "skew=true" in plan(merge)
