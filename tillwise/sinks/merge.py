"""Replace single days in a table that is partitioned by month.

A month is the smallest folder, so a day cannot be overwritten as a partition. The months
that a batch touches are read, their rows of the batch's days replaced, and the result is
written aside, below the table but in a folder that readers skip. Only when all of it is
there, whole month folders change places by renaming. If anything fails before, the
table is as it was; if it fails between two renames, what was moved is moved back. A run
that was killed there has left the old months aside: the next one puts them back
first. A batch can be run again as often as wanted, the table stays the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.sinks.tables import read_output, typed, write_parquet

STAGED, REPLACED = "_staged-", "_replaced-"


class Folder:
    """The few file operations a swap needs, in whatever store Hadoop knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.root = self._path(path)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, *below: str):
        return self._path(self.root, "/".join(below)) if below else self.root

    def exists(self, *below: str) -> bool:
        return self.fs.exists(self.at(*below))

    def names(self, *below: str) -> list[str]:
        place = self.at(*below)
        return [s.getPath().getName() for s in self.fs.listStatus(place)] if self.fs.exists(place) else []

    def move(self, source: str, target: str) -> None:
        place = self.at(target)
        self.fs.mkdirs(place.getParent())
        if not self.fs.rename(self.at(source), place):
            raise OSError(f"{self.at(source).toString()} cannot be renamed")

    def remove(self, *below: str) -> None:
        self.fs.delete(self.at(*below), True)


def _part(year: int, month: int) -> str:
    return f"txn_year={year}/txn_month={month}"


def put_back(folder: Folder) -> None:
    """Months that a killed run left aside return to their places; its staged rows go."""
    for name in folder.names():
        if name.startswith(REPLACED):
            for year in folder.names(name):
                for month in folder.names(name, year):
                    if folder.exists(year, month):
                        folder.remove(year, month)
                    folder.move(f"{name}/{year}/{month}", f"{year}/{month}")
        if name.startswith((REPLACED, STAGED)):
            folder.remove(name)


def swap(folder: Folder, staged: str, months: Iterable[tuple[int, int]]) -> None:
    """Move the months below `staged` to their places; a month that is not there is emptied."""
    aside = f"{REPLACED}{uuid.uuid4().hex}"
    moved, placed = [], []
    try:
        for part in (_part(*m) for m in months):
            if folder.exists(part):
                folder.move(part, f"{aside}/{part}")
                moved.append(part)
            if folder.exists(staged, part):
                folder.move(f"{staged}/{part}", part)
                placed.append(part)
    except BaseException:
        for part in placed:
            folder.remove(part)
        for part in moved:
            folder.move(f"{aside}/{part}", part)
        raise
    finally:
        folder.remove(staged)
        folder.remove(aside)


def months_of(days: Iterable[str]) -> list[tuple[int, int]]:
    return sorted({(int(day[:4]), int(day[5:7])) for day in days})


def replace_days(df: DataFrame, root: str, name: str, days: Iterable[str]) -> list[dict[str, int]]:
    """Put the rows of `df` in the place of all stored rows of these days (yyyy-MM-dd; also
    where `df` has none for a day). Other days stay. Reads and writes the touched months
    only. Returns the partitions of these, for the catalog."""
    spark, path, days = df.sparkSession, f"{root}/{name}", sorted(set(days))
    folder, months = Folder(spark, path), months_of(days)
    put_back(folder)
    rows = typed(df, name)
    if folder.exists() and days:
        touched = [(F.col("txn_year") == y) & (F.col("txn_month") == m) for y, m in months if folder.exists(_part(y, m))]
        if touched:
            pruned = touched[0]
            for more in touched[1:]:
                pruned = pruned | more
            stored = read_output(spark, path, name).where(pruned)
            rows = stored.where(~F.col("txn_date").isin(days)).unionByName(rows)
    staged = f"{STAGED}{uuid.uuid4().hex}"
    try:
        write_parquet(rows, f"{path}/{staged}", ("txn_year", "txn_month"))
    except BaseException:
        folder.remove(staged)
        raise
    swap(folder, staged, months)
    return [{"txn_year": year, "txn_month": month} for year, month in months]
