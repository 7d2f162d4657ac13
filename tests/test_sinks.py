from pathlib import Path

from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.rows import fact
from tillwise.operators import layout, quarterly, summaries
from tillwise.plans import registry
from tillwise.schema import TABLES
from tillwise.sinks import catalog
from tillwise.sinks.tables import (
    output_manifest,
    preview,
    read_output,
    write_output,
    write_parquet,
)

SMALL = f"{DATA}/sf0.001"


def days(spark, *stamps):
    return fact(spark, *[{"transaction_ts": s} for s in stamps])


def test_text_partition_column_stays_text(spark, tmp_path):
    daily = summaries.daily_category_summary(days(spark, "2024-01-02 00:00:00"))
    path = write_output(daily, str(tmp_path), "daily_category_summary")
    assert dict(spark.read.parquet(path).dtypes)["txn_date"] == "date"
    stored = read_output(spark, path, "daily_category_summary")
    assert dict(stored.dtypes)["txn_date"] == "string"
    assert stored.first().txn_date == "2024-01-02"


def test_one_file_per_small_directory(spark, tmp_path):
    daily = registry.QUERIES["daily_category_summary"](spark, SMALL)
    path = Path(write_output(daily, str(tmp_path), "daily_category_summary"))
    for folder in path.glob("txn_date=*"):
        assert len(list(folder.glob("*.parquet"))) == 1


def test_rebalanced_write_makes_few_files(spark, tmp_path):
    rows = registry.txn(spark, SMALL, "transaction_id transaction_ts amount").repartition(16)
    path = tmp_path / "by_month"
    write_parquet(rows, str(path), ("txn_year", "txn_month"))
    folders = list(path.glob("txn_year=*/txn_month=*"))
    files = list(path.glob("txn_year=*/txn_month=*/*.parquet"))
    assert len(files) <= 2 * len(folders)
    assert all("snappy" in f.name for f in files)


def test_hot_directory_is_split(spark, tmp_path):
    from tests.test_plans import conf

    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise((F.col("id") % 9).cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    path = tmp_path / "hot"
    with conf(spark, adaptive__advisoryPartitionSizeInBytes="2m"):
        write_parquet(rows, str(path), ("k",))
    assert len(list((path / "k=hot").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(path)).count() == 400_000


def test_rerun_of_one_quarter_keeps_the_others(spark, tmp_path):
    name = "quarterly_category_summary"
    both = days(spark, "2024-02-01 00:00:00", "2024-05-01 00:00:00")
    write_output(quarterly.quarterly_category_summary(both, 2024), str(tmp_path), name, 2024)
    again = days(spark, "2024-05-01 00:00:00", "2024-05-02 00:00:00")
    path = write_output(
        quarterly.quarterly_category_summary(again, 2024),
        str(tmp_path),
        name,
        2024,
        only_touched_partitions=True,
    )
    assert path == f"{tmp_path}/2024/{name}"
    counts = {r.txn_quarter: r.txn_count for r in read_output(spark, path, name).collect()}
    assert counts == {1: 1, 2: 2}


def test_overwrite_replaces_everything_by_default(spark, tmp_path):
    name = "quarterly_category_summary"
    for stamp in ("2024-02-01 00:00:00", "2024-05-01 00:00:00"):
        rows = quarterly.quarterly_category_summary(days(spark, stamp), 2024)
        path = write_output(rows, str(tmp_path), name, 2024)
    assert [r.txn_quarter for r in read_output(spark, path, name).collect()] == [2]


def test_manifest_counts_files_and_bytes(spark, tmp_path):
    root = tmp_path / "out"
    hourly = summaries.hourly_pattern(days(spark, "2024-02-01 00:00:00"))
    write_output(hourly, str(root), "hourly_pattern")
    rows = output_manifest(spark, str(root)).collect()
    files = list((root / "hourly_pattern").glob("*.parquet"))
    assert [(r.table_name, r.files, r.bytes) for r in rows] == [
        ("hourly_pattern", len(files), sum(f.stat().st_size for f in files))
    ]


def test_manifest_takes_the_root_literally(spark, tmp_path):
    root = tmp_path / "a+b (1)"
    rows = spark.range(3)
    rows.write.parquet(str(root / "quarterly" / root.name / "x"))
    rows.write.parquet(str(root / "2024" / "x"))
    tables = lambda depth: [r.table_name for r in output_manifest(spark, str(root), depth).collect()]
    assert tables(1) == ["2024", "quarterly"]
    assert tables(2) == ["2024/x", f"quarterly/{root.name}"]


def test_external_table(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    name = "partitioned_transactions"
    full = registry.full_fact(spark, SMALL)
    catalog.create_database(spark, "card_test", root)
    table = catalog.register_table(spark, "card_test", name, write_output(full, root, name))
    assert spark.table(table).count() == full.count()
    described = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {table}").collect()}
    assert described["card_no"] == "Masked card number"


def test_refresh_finds_new_files(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    monthly = summaries.monthly_trend(registry.full_fact(spark, SMALL))
    catalog.create_database(spark, "refresh_test", root)
    path = write_output(monthly, root, "monthly_trend")
    table = catalog.register_table(spark, "refresh_test", "monthly_trend", path)
    before = spark.table(table).count()
    monthly.write.mode("append").parquet(path)
    catalog.refresh(spark, table)
    assert spark.table(table).count() == 2 * before


def test_statement_quotes_comments():
    spec = TABLES["merchant_ranking"]
    text = catalog.create_table_statement("d", "t", spec, "/x/it's")
    assert r"LOCATION '/x/it\'s'" in text


def test_preview_returns_rows(spark):
    assert preview(spark.range(50), 7).count() == 7


def test_repartition_counts_follow_the_cluster(spark):
    assert layout.scaled_counts(spark) == [2, 4, 8, 16, 50, 200]  # eight cores in tests


def test_partition_profile(spark):
    profile = layout.partition_profile(spark.range(0, 100, 1, 5))
    assert sorted(r.rows for r in profile.collect()) == [20] * 5
    assert tuple(layout.partition_summary(spark.range(0, 100, 1, 5)).first()) == (5, 20, 20, 100)
