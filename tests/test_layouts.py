"""Clustered files, buckets, footers, partitions told to the catalog, history checks, shuffle width."""

import pytest
from pyspark.sql import functions as F

from tests.rows import fact, raw
from tests.test_incremental import change, typed_fact
from tillwise.functions.calendar_cols import with_calendar
from tillwise.functions.sizing import scanned_bytes
from tillwise.operators import clustered, quality
from tillwise.session import _OURS, _WIDTH, size_shuffles
from tillwise.sinks import catalog, merge
from tillwise.sinks.tables import read_output, write_output
from tillwise.sources import footers
from tillwise.sources.readers import read_parquet


def rows_read(spark, df):
    """Rows that the scan of a collected query gave to the operators above it."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    total = 0
    for k in range(leaves.size()):
        total += leaves.apply(k).metrics().apply("numOutputRows").value()
    return total


def test_a_card_is_found_in_few_row_groups(spark, tmp_path):
    rows = spark.range(400_000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.concat(F.lit("card"), F.lpad((F.xxhash64("id") % 20_000).cast("string"), 6, "0")).alias("card_no"),
    )
    path = str(tmp_path / "by_card")
    clustered.write_clustered(rows, path, "card_no", ("transaction_id",), row_group_bytes=64 << 10)
    stored = read_parquet(spark, path, rows.schema)
    wanted = rows.select("card_no").first()[0]
    expected = sorted(r.transaction_id for r in rows.where(F.col("card_no") == wanted).collect())
    found = clustered.lookup_value(stored, "card_no", wanted)
    assert sorted(r.transaction_id for r in found.collect()) == expected
    assert rows_read(spark, found) < 40_000
    assert "PushedFilters: [IsNotNull(card_no), EqualTo(card_no," in found._jdf.queryExecution().toString()
    # the id is spread over all row groups: there it is the Bloom filter that rules them out
    other = clustered.lookup_value(stored, "transaction_id", "123456")
    assert other.count() == 1
    found = clustered.lookup_value(stored, "transaction_id", "123456")
    found.collect()
    assert rows_read(spark, found) < 100_000
    assert clustered.lookup_value(stored, "transaction_id", "no such id").count() == 0


def test_a_hot_card_takes_several_files(spark, tmp_path):
    rows = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("card_no"), "id")
    clustered.write_clustered(rows, str(tmp_path / "hot"), "card_no")
    stored = spark.read.parquet(str(tmp_path / "hot"))
    assert stored.where("card_no = 'hot'").select(F.input_file_name()).distinct().count() > 1
    assert stored.count() == 100_000


def test_bucketed_join_shuffles_nothing(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucket_test LOCATION '{tmp_path}'")
    facts = spark.range(1000).select((F.col("id") % 7).cast("string").alias("merchant"), "id")
    master = spark.createDataFrame([("1", "a"), ("2", "b"), ("9", "c")], "merchant string, kind string")
    clustered.write_bucketed(facts, "bucket_test.facts", "merchant", 4, f"{tmp_path}/facts")
    clustered.write_bucketed(master, "bucket_test.master", "merchant", 4, f"{tmp_path}/master")
    joined = clustered.bucketed_join(spark, "bucket_test.facts", "bucket_test.master", "merchant")
    assert joined.where("kind = 'a'").count() == 143 and joined.count() == 1000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert len(list((tmp_path / "facts").glob("*.parquet"))) <= 4
    spark.sql("DROP DATABASE bucket_test CASCADE")


def test_footers_say_what_is_stored(spark, tmp_path):
    rows = spark.range(50_000).select(
        F.when(F.col("id") % 10 != 0, F.col("id") - 5).alias("n"), F.lit(None).cast("string").alias("empty"), F.array("id").alias("list")
    )
    path = str(tmp_path / "f")
    rows.repartition(3).write.option("parquet.block.size", 64 << 10).parquet(path)
    found = footers.row_groups(spark, path).collect()
    mine = [r for r in found if r.column == "n"]
    assert len({r.file for r in found}) == 3 and sum(r.rows for r in mine) == 50_000
    assert len(mine) > 3 and {r.row_group for r in mine} >= {0, 1}
    assert sum(r.nulls for r in mine) == 5000
    assert (min(int(r.minimum) for r in mine), max(int(r.maximum) for r in mine)) == (-4, 49_994)
    empty = [r for r in found if r.column == "empty"]
    assert sum(r.nulls for r in empty) == 50_000 and {r.minimum for r in empty} == {None}
    assert any(r.column.startswith("list.") for r in found)
    assert all(0 < r.bytes < r.file_bytes for r in mine)


def test_the_catalog_learns_touched_months_only(spark, tmp_path, monkeypatch):
    name, root = "partitioned_transactions", str(tmp_path)
    path = write_output(typed_fact(spark, change("2024-05-01"), change("2024-06-01")), root, name)
    catalog.create_database(spark, "touched_test", root)
    table = catalog.register_table(spark, "touched_test", name, path)
    merge.replace_days(typed_fact(spark, change("2024-08-01")), root, name, ["2024-08-01"])  # nobody tells the catalog
    touched = merge.replace_days(typed_fact(spark, change("2024-07-01", amount=5)), root, name, ["2024-06-01", "2024-07-01"])
    assert touched == [{"txn_year": 2024, "txn_month": 6}, {"txn_year": 2024, "txn_month": 7}]
    catalog.refresh_partitions(spark, table, path, touched)
    months = {r.txn_month: r.amount for r in spark.table(table).collect()}
    assert months == {5: 1000, 7: 5}  # June is empty and gone, August was not looked for
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} == {"txn_year=2024/txn_month=5", "txn_year=2024/txn_month=7"}
    catalog.drop_database(spark, "touched_test")


def stored_fact(spark, tmp_path, *changes):
    rows = with_calendar(raw(spark, *changes).withColumn("transaction_ts", F.to_timestamp("transaction_date")))
    path = write_output(rows, str(tmp_path), "partitioned_transactions")
    return read_output(spark, path, "partitioned_transactions")


def test_history_checks(spark, tmp_path):
    old = stored_fact(
        spark,
        tmp_path,
        change("2023-01-05", transaction_id="A"),
        change("2024-06-01", transaction_id="B", card_no="c1", amount=7, merchant="m"),
        change("2024-06-01", transaction_id=None),
        change("2024-06-01", transaction_id="C", card_no=None, amount=9),
    )
    batch = typed_fact(
        spark,
        change("2024-06-01", transaction_id="A", amount=1),
        change("2024-06-01", transaction_id="A", amount=2),
        change("2024-06-01", transaction_id="new", card_no="c1", amount=7, merchant="m"),
        change("2024-06-02", transaction_id=None, amount=3),
        change("2024-06-02", transaction_id="D", card_no=None, amount=9),
    )
    with quality.with_key_filter(spark):
        checks = quality.history_checks(batch, old, "2025-01-01 00:00:00").collect()
    assert [(c.check_name, c.status, c.issue_count) for c in checks] == [("id_stored_already", "FAIL", 2), ("payment_stored_already", "WARN", 1)]
    clean = quality.history_checks(batch.where("transaction_id = 'D'"), old, "2025-01-01 00:00:00").collect()
    assert {(c.status, c.issue_count) for c in clean} == {("PASS", 0)}
    nothing = quality.history_checks(batch.where("false"), old, "2025-01-01 00:00:00").collect()
    assert {(c.status, c.issue_count) for c in nothing} == {("PASS", 0)}


def test_history_is_pruned(spark, tmp_path):
    old = stored_fact(spark, tmp_path, *[change(f"{y}-{m:02d}-01") for y in (2022, 2023, 2024) for m in (5, 6)])
    batch = fact(spark, change("2024-06-01")).withColumn("transaction_date", F.col("transaction_ts").cast("string"))
    checks = quality.history_checks(batch, old, "2025-01-01 00:00:00", ("2024-06-01", "2024-06-30"))
    plan = checks._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(txn_year" in plan and "(txn_year#" in plan
    # payments read four columns of the batch's months, ids one column
    assert "ReadSchema: struct<transaction_id:string>" in plan


def test_key_filter_restores_what_was_set(spark):
    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(key)
    with quality.with_key_filter(spark):
        assert spark.conf.get(key) == "0"
    assert spark.conf.get(key) == before


@pytest.fixture
def width(spark):
    before = {k: spark.conf.get(k, None) for k in (_WIDTH, _OURS)}
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_shuffles_follow_the_bytes_to_read(spark, width, tmp_path, monkeypatch):
    spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert 0 < scanned_bytes(table.select("id")) < scanned_bytes(table) < 100 << 20
    # as with dynamic allocation without an upper bound: two cores when the session begins
    spark.conf.set(_WIDTH, "16")
    spark.conf.set(_OURS, "16")
    monkeypatch.setattr("tillwise.session.SHUFFLE_BYTES", 64 << 10)
    wanted = size_shuffles(spark, table)
    assert wanted > 100 and spark.conf.get(_WIDTH) == str(wanted)
    assert size_shuffles(spark, table.select("id")) == wanted  # never narrower
    # what a user sets meanwhile stays
    spark.conf.set(_WIDTH, "40")
    assert size_shuffles(spark, table) == 40 and spark.conf.get(_WIDTH) == "40"
