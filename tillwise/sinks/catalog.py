"""External tables over the written Parquet folders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from tillwise.schema import TABLES, TableSpec
from tillwise.sinks.merge import Folder


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(
    spark: SparkSession, database: str, location: str, comment: str = "Transaction analytics"
) -> None:
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS `{database}` "
        f"COMMENT {_quoted(comment)} LOCATION {_quoted(location)}"
    )


def drop_database(spark: SparkSession, database: str) -> None:
    """Drop a database and its tables; the files of external tables stay."""
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def create_table_statement(database: str, name: str, spec: TableSpec, location: str) -> str:
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT {_quoted(f.metadata['comment'])}" if "comment" in f.metadata else "")
        for f in spec.schema.fields
    )
    partitions = (
        f" PARTITIONED BY ({', '.join(f'`{c}`' for c in spec.partition_by)})"
        if spec.partition_by
        else ""
    )
    return (
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING PARQUET{partitions} "
        f"LOCATION {_quoted(location)} COMMENT {_quoted(spec.comment)}"
    )


def register_table(
    spark: SparkSession,
    database: str,
    name: str,
    location: str,
    spec: TableSpec | None = None,
    discover: bool = True,
) -> str:
    """Create the external table, discover its partitions and return its full name.

    Discovery lists every folder of the table. After a run that touched few of them,
    `refresh_partitions` needs to look at these alone.
    """
    spec = spec or TABLES[name]
    spark.sql(create_table_statement(database, name, spec, location))
    full_name = f"`{database}`.`{name}`"
    if spec.partition_by and discover:
        spark.sql(f"MSCK REPAIR TABLE {full_name}")
    return full_name


def refresh_partitions(
    spark: SparkSession, full_name: str, location: str, partitions: Iterable[dict[str, object]]
) -> None:
    """Make the catalog know the partitions that a write touched, and no others.

    Those that have a folder are added, those that lost theirs are dropped; no other folder
    is listed. Then cached file listings of the table go.
    """
    folder, added, dropped = Folder(spark, location), [], []
    for values in partitions:
        clause = ", ".join(f"`{k}`={_quoted(v) if isinstance(v, str) else v}" for k, v in values.items())
        there = folder.exists(*[f"{k}={v}" for k, v in values.items()])
        (added if there else dropped).append(f"PARTITION ({clause})")
    if added:
        spark.sql(f"ALTER TABLE {full_name} ADD IF NOT EXISTS {' '.join(added)}")
    if dropped:
        spark.sql(f"ALTER TABLE {full_name} DROP IF EXISTS {', '.join(dropped)}")
    refresh(spark, full_name)


def refresh(spark: SparkSession, full_name: str) -> None:
    """Drop cached file listings after the folder was rewritten by someone else."""
    spark.catalog.refreshTable(full_name)
