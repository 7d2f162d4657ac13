"""Days that are run again: merge by day, partial results, numbers, bitmaps."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.rows import fact, transactions
from tests.test_jobs import CHANGES, _csv_of
from tillwise.operators import daily_state, declared, quarterly, summaries
from tillwise.plans import jobs, registry
from tillwise.schema import STATE, TABLES
from tillwise.sinks import merge
from tillwise.sinks.numbering import number_members, read_numbers
from tillwise.sinks.tables import read_output, write_output

TABLE = "partitioned_transactions"


def rows_of(spark, root, names=None):
    """Every stored output as sorted texts."""
    names = names or [TABLE, *jobs.SUMMARIES, *jobs.DECLARED, *jobs.DECLARED_ALL_STATUSES]
    return {n: sorted(map(str, read_output(spark, f"{root}/{n}", n).collect())) for n in names}


def change(day, **more):
    return {"transaction_ts": f"{day} 10:00:00", **more}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Twelve months and five more days of June, run in full."""
    base = tmp_path_factory.mktemp("incremental")
    june = [change(f"2024-06-{d:02d}", amount=100 * d, card_no=f"c{d % 3}", merchant=f"m{d % 2}") for d in (1, 2, 3, 4)]
    june.append(change("2024-06-02", approval_status="declined", amount=5))
    changes = [*CHANGES, *june]
    return base, changes


def run(spark, base, name, changes, output, again=False):
    path = _csv_of(spark, str(base / name), *changes)
    return jobs.run_etl(spark, path, str(output), with_declared=True, only_touched_partitions=again).first()


def test_one_day_again_equals_a_full_run(spark, stored):
    base, changes = stored
    run(spark, base, "a.csv", changes, base / "a")
    before = rows_of(spark, base / "a")
    # the same day once more, as the command line runs it: nothing changes
    same = [c for c in changes if c["transaction_ts"].startswith("2024-06-02")]
    report = run(spark, base, "same.csv", same, base / "a", again=True)
    again = rows_of(spark, base / "a")
    assert again[TABLE] != [] and {n: len(r) for n, r in again.items()} == {n: len(r) for n, r in before.items()}
    assert {n: r for n, r in again.items() if n != TABLE} == {n: r for n, r in before.items() if n != TABLE}
    # other rows for that day, and a day that was not there: equal to a full run over all of it
    new = [change("2024-06-02", amount=7, card_no="new", merchant="m9"), change("2024-06-05", amount=9), change("2025-01-01")]
    report = run(spark, base, "new.csv", new, base / "a", again=True)
    whole = [c for c in changes if not c["transaction_ts"].startswith("2024-06-02")] + new
    expected = run(spark, base, "b.csv", whole, base / "b")
    assert report == expected
    found, wanted = rows_of(spark, base / "a"), rows_of(spark, base / "b")
    ids = lambda rows: sorted(r.split("transaction_date", 1)[1] for r in rows)  # noqa: E731  ids are counted by file
    assert ids(found.pop(TABLE)) == ids(wanted.pop(TABLE))
    assert found == wanted
    # and once more
    run(spark, base, "new.csv2", new, base / "a", again=True)
    assert {n: r for n, r in rows_of(spark, base / "a").items() if n != TABLE} == wanted


def test_a_day_without_approved_rows_is_emptied(spark, stored, tmp_path):
    base, _ = stored
    run(spark, tmp_path, "x.csv", [change("2024-06-01"), change("2024-06-02"), change("2024-07-01")], tmp_path / "x")
    gone = [change("2024-06-02", approval_status="declined"), change("2024-07-01", approval_status="declined")]
    run(spark, tmp_path, "y.csv", gone, tmp_path / "x", again=True)
    fact_rows = read_output(spark, f"{tmp_path}/x/{TABLE}", TABLE)
    assert [r.txn_date for r in fact_rows.collect()] == ["2024-06-01"]
    daily = read_output(spark, f"{tmp_path}/x/daily_category_summary", "daily_category_summary")
    assert [r.txn_date for r in daily.collect()] == ["2024-06-01"]
    rates = read_output(spark, f"{tmp_path}/x/daily_approval_rate", "daily_approval_rate").collect()
    assert {r.txn_date: r.approval_rate for r in rates} == {"2024-06-01": 100.0, "2024-06-02": 0.0, "2024-07-01": 0.0}


def test_days_are_refused_without_a_full_run_or_a_date(spark, tmp_path):
    with pytest.raises(ValueError, match="whole table"):
        run(spark, tmp_path, "a.csv", [change("2024-06-01")], tmp_path / "out", again=True)
    run(spark, tmp_path, "b.csv", [change("2024-06-01")], tmp_path / "out")
    before = rows_of(spark, tmp_path / "out")
    rows = transactions(spark, change("2024-06-01")).withColumn("transaction_date", F.lit("1998-13-45 00:00:00"))
    from tillwise.schema import FACT_COLUMNS
    from tillwise.sinks.tables import write_csv

    write_csv(rows.select(*FACT_COLUMNS), str(tmp_path / "c.csv"))
    with pytest.raises(ValueError, match="readable date"):
        jobs.run_etl(spark, str(tmp_path / "c.csv"), str(tmp_path / "out"), True, True)
    assert rows_of(spark, tmp_path / "out") == before


def test_quality_against_the_stored_fact(spark, tmp_path):
    run(spark, tmp_path, "a.csv", [change("2024-06-01", amount=n * 100) for n in (1, 2)], tmp_path / "out")
    fact_rows = read_output(spark, f"{tmp_path}/out/{TABLE}", TABLE)
    again = _csv_of(spark, str(tmp_path / "b.csv"), change("2024-06-01", amount=100), change("2024-06-03"))
    # ids are counted by file, so both rows have ids that are stored; one payment is
    rules = dict(as_of="2025-01-01 00:00:00")
    assert jobs.run_quality(spark, again, **rules) == "PASS"
    assert jobs.run_quality(spark, again, str(tmp_path / "q"), history=fact_rows, **rules) == "FAIL"
    checks = {r.check_name: (r.status, r.issue_count) for r in read_output(spark, f"{tmp_path}/q/quality_report", "quality_report").collect()}
    assert checks["id_stored_already"] == ("FAIL", 2) and checks["payment_stored_already"] == ("WARN", 1)


def test_the_catalog_is_told_of_days(spark, tmp_path):
    root = str(tmp_path / "etl")
    run(spark, tmp_path, "a.csv", [change("2024-06-01")], root)
    jobs.register_outputs(spark, "days_test", root)
    run(spark, tmp_path, "b.csv", [change("2024-07-01", amount=3)], root, again=True)
    jobs.register_days(spark, "days_test", root, ["2024-07-01"])
    assert sorted(r.amount for r in spark.table("days_test.partitioned_transactions").collect()) == [3, 1000]
    spark.sql("DROP DATABASE days_test CASCADE")


# --- the merge ----------------------------------------------------------------


def typed_fact(spark, *changes):
    return fact(spark, *changes).withColumn("transaction_date", F.col("transaction_ts").cast("string"))


def listing(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*.parquet"))


@pytest.fixture
def two_months(spark, tmp_path):
    write_output(typed_fact(spark, *[change(d) for d in ("2024-05-01", "2024-06-01", "2024-06-02", "2024-06-03")]), str(tmp_path), TABLE)
    return tmp_path


def days_in(spark, root):
    return sorted(r.txn_date for r in read_output(spark, f"{root}/{TABLE}", TABLE).collect())


def test_other_days_and_months_stay(spark, two_months):
    may = [f for f in listing(two_months) if "txn_month=5" in f]
    merge.replace_days(typed_fact(spark, change("2024-06-02"), change("2024-06-02")), str(two_months), TABLE, ["2024-06-02"])
    assert days_in(spark, two_months) == ["2024-05-01", "2024-06-01", "2024-06-02", "2024-06-02", "2024-06-03"]
    assert [f for f in listing(two_months) if "txn_month=5" in f] == may
    assert not [p for p in (two_months / TABLE).iterdir() if p.name.startswith(("_staged", "_replaced"))]


def test_a_run_that_fails_while_writing_changes_nothing(spark, two_months):
    before = listing(two_months)
    bad = typed_fact(spark, change("2024-06-02")).withColumn("amount", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        merge.replace_days(bad, str(two_months), TABLE, ["2024-06-02"])
    assert listing(two_months) == before


def test_a_run_that_fails_while_renaming_is_undone(spark, two_months, monkeypatch):
    before, moves, move = listing(two_months), [], merge.Folder.move

    def third_fails(self, source, target):
        moves.append(source)
        if len(moves) == 3:
            raise OSError("store is gone")
        move(self, source, target)

    monkeypatch.setattr(merge.Folder, "move", third_fails)
    with pytest.raises(OSError, match="store is gone"):
        merge.replace_days(typed_fact(spark, change("2024-05-01")), str(two_months), TABLE, ["2024-05-01", "2024-06-02"])
    assert listing(two_months) == before


def test_a_killed_run_is_put_back_by_the_next(spark, two_months):
    folder = merge.Folder(spark, f"{two_months}/{TABLE}")
    # killed after June was moved aside, with its staged rows left behind
    folder.move("txn_year=2024/txn_month=6", "_replaced-x/txn_year=2024/txn_month=6")
    folder.fs.mkdirs(folder.at("_staged-x", "txn_year=2024"))
    assert days_in(spark, two_months) == ["2024-05-01"]
    merge.replace_days(typed_fact(spark, change("2024-06-09")), str(two_months), TABLE, ["2024-06-09"])
    assert days_in(spark, two_months) == ["2024-05-01", "2024-06-01", "2024-06-02", "2024-06-03", "2024-06-09"]
    assert not [n for n in folder.names() if n.startswith("_re") or n.startswith("_staged")]


def test_only_touched_months_are_read(spark, two_months):
    kept = read_output(spark, f"{two_months}/{TABLE}", TABLE).where("txn_year = 2024 AND txn_month = 6")
    assert "PartitionFilters: [isnotnull(txn_year" in kept._jdf.queryExecution().toString()
    # May cannot be read any more, and need not be
    for file in (two_months / TABLE).glob("txn_year=2024/txn_month=5/*.parquet"):
        file.write_bytes(b"no parquet")
    for file in (two_months / TABLE).glob("txn_year=2024/txn_month=5/.*.crc"):
        file.unlink()
    merge.replace_days(typed_fact(spark, change("2024-06-02", amount=3)), str(two_months), TABLE, ["2024-06-02"])
    june = read_output(spark, f"{two_months}/{TABLE}", TABLE).where("txn_month = 6")
    assert sorted(r.amount for r in june.collect()) == [3, 1000, 1000]


# --- numbers and bitmaps ------------------------------------------------------


def test_numbers_are_dense_and_stay(spark, tmp_path):
    def pairs(*values):
        return spark.createDataFrame([("card" if v[:1] == "c" else "merchant", v) for v in values], "member string, value string")

    first = {(r.member, r.value): r.number for r in number_members(pairs(*[f"c{k}" for k in range(50)], "m1", "m1"), str(tmp_path)).collect()}
    assert sorted(n for (kind, _), n in first.items() if kind == "card") == list(range(1, 51))
    assert first["merchant", "m1"] == 1
    more = pairs(*[f"c{k}" for k in range(40, 70)], "m2").unionAll(spark.createDataFrame([("card", None)], "member string, value string"))
    second = {(r.member, r.value): r.number for r in number_members(more, str(tmp_path)).collect()}
    assert all(second[k] == n for k, n in first.items())
    assert sorted(n for (kind, _), n in second.items() if kind == "card") == list(range(1, 71))
    assert second["merchant", "m2"] == 2
    assert number_members(more, str(tmp_path)).count() == 72 == read_numbers(spark, str(tmp_path)).count()


@pytest.fixture(scope="module")
def odd_fact(spark):
    """NULLs in every key, 40,000 cards (two buckets), one card with a third of the rows."""
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 != 1, F.concat(F.lit("c"), F.col("id"))).alias("card_no"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("m"), F.col("id") % 11)).alias("merchant"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("k"), F.col("id") % 4)).alias("category"),
        F.when(F.col("id") % 2 != 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("sub_category"),
        F.when(F.col("id") % 13 != 0, F.concat(F.lit("r"), F.col("id") % 3)).alias("region"),
        F.when(F.col("id") % 17 != 0, F.col("id") % 900 - 20).alias("amount"),
        F.lit("approved").alias("approval_status"),
        F.lit("신용").alias("card_type"),
        (F.lit("2024-01-31 00:30:00").cast("timestamp_ntz") + F.make_interval(hours=(F.col("id") % 3000).cast("int"))).alias("transaction_ts"),
    )
    from tillwise.functions.calendar_cols import with_calendar

    return with_calendar(rows)


def test_summaries_from_the_state_equal_those_of_the_rows(spark, odd_fact, tmp_path):
    jobs.write_state(spark, odd_fact, odd_fact, str(tmp_path))
    found = jobs.summaries_from_state(spark, str(tmp_path))
    for name, summarize in jobs.SUMMARIES.items():
        direct = summarize(odd_fact)
        assert found[name].dtypes == direct.dtypes, name
        assert sorted(map(str, found[name].collect())) == sorted(map(str, direct.collect())), name
    totals, members = (jobs.read_state(spark, str(tmp_path), n) for n in ("daily_totals", "daily_members"))
    others = [
        (daily_state.etl_report(totals, members), summaries.etl_report(odd_fact)),
        (daily_state.monthly_mom_growth(totals, members), declared.monthly_mom_growth(odd_fact)),
        (daily_state.quarterly_category_summary(totals, members, 2024), quarterly.quarterly_category_summary(odd_fact, 2024)),
        (daily_state.quarterly_region(totals, 2024), quarterly.quarterly_region(odd_fact, 2024)),
        (daily_state.qoq_growth(totals, members, 2024), quarterly.qoq_growth(odd_fact, 2024)),
    ]
    for mine, direct in others:
        assert mine.columns == direct.columns
        assert sorted(map(str, mine.collect())) == sorted(map(str, direct.collect()))
    assert members.where("member = 'card'").select("bucket").distinct().count() == 2


def test_state_of_nothing(spark, odd_fact, tmp_path):
    none = odd_fact.where("false")
    jobs.write_state(spark, none, none, str(tmp_path))
    found = jobs.summaries_from_state(spark, str(tmp_path))
    assert {name: df.count() for name, df in found.items()} == dict.fromkeys(jobs.SUMMARIES, 0)
    report = daily_state.etl_report(*(jobs.read_state(spark, str(tmp_path), n) for n in ("daily_totals", "daily_members")))
    assert report.first() == summaries.etl_report(none).first()


def test_the_state_is_all_that_summaries_read(spark, tmp_path):
    data = f"{DATA}/sf0.001"
    fact_rows = registry.full_fact(spark, data)
    jobs.write_state(spark, fact_rows, fact_rows, str(tmp_path))
    for name, df in jobs.summaries_from_state(spark, str(tmp_path)).items():
        files = {f.removeprefix("file://").rsplit("/txn_year=", 1)[0] for f in df.inputFiles()}
        assert files and files <= {f"{tmp_path}/state/{n}" for n in STATE}, name
        plan = df._jdf.queryExecution().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name
    totals, members = (jobs.read_state(spark, str(tmp_path), n) for n in ("daily_totals", "daily_members"))
    quarter = daily_state.quarterly_category_summary(totals, members, 1998)
    assert quarter._jdf.queryExecution().toString().count("(txn_year") >= 2  # folders are pruned


def test_specs_do_not_clash():
    assert not set(STATE) & set(TABLES)
