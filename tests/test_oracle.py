"""Every named query against the same question in DuckDB."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from tests.compare import TABLES, connect, duck_rows, spark_rows, type_differences
from tests.conftest import DATA
from tillwise.plans import oracles, registry

QUERIES = registry.QUERIES
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def data(request):
    data_dir = f"{DATA}/{request.param}"
    return data_dir, connect(data_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, data, name):
    data_dir, connection = data
    found = QUERIES[name](spark, data_dir)
    columns, rows = spark_rows(found)
    expected_columns, expected = duck_rows(connection, SQL[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert type_differences(found, connection, SQL[name]) == {}


@pytest.fixture(scope="module")
def repeated(tmp_path_factory):
    """sf0.001 with orders and lines repeated 8 times under shifted keys: of 48,000 rows a share in
    percent can lie halfway between two texts of four decimals, as 471 and 6,231 here do."""
    source, folder = Path(DATA, "sf0.001"), tmp_path_factory.mktemp("repeated")
    connection = connect(str(source))
    (step,) = connection.execute("SELECT max(o_orderkey) + 1 FROM orders").fetchone()
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    for name in TABLES:
        file = f"{name}.parquet"
        if name in keys:
            key = keys[name]
            connection.execute(
                f"COPY (SELECT t.* REPLACE ({key} + n * {step} AS {key}) FROM {name} t, range(8) r(n)) "
                f"TO '{folder / file}'"
            )
        else:
            (folder / file).symlink_to(source / file)
    return str(folder), connect(str(folder))


@pytest.mark.parametrize("name", ["dq_checks", "dq_report_json"])
def test_same_rows_where_shares_end_on_a_half(spark, repeated, name):
    data_dir, connection = repeated
    columns, rows = spark_rows(QUERIES[name](spark, data_dir))
    assert {"0.9812%", "12.9812%"} <= {row[columns.index("issue_ratio")] for row in rows}
    assert (columns, rows) == duck_rows(connection, SQL[name])


def test_entry_names_every_query():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0
