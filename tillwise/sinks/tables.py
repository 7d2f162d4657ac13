"""Parquet, CSV and JSON sinks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.sizing import spread
from tillwise.schema import spec_of
from tillwise.sources.literals import benchmark_rows


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    few_rows_per_partition: bool = False,
    only_touched_partitions: bool = False,
) -> None:
    """Overwrite `path` with snappy Parquet.

    A partitioned write first gathers rows by the partition columns, so that a
    directory does not get a file from every task. By default it rebalances: small
    directories share a task and one with most of the rows is split over several.
    With `few_rows_per_partition` (a summary by day, say) the cost is the number of
    files, not bytes, and adaptive execution would merge everything into one
    writer; a fixed hash spread then keeps all writers busy, one file per directory.

    With `only_touched_partitions` directories that `df` has no rows for are kept,
    so one quarter can be re-run alone.
    """
    keys = [F.col(c) for c in partition_by]
    if keys and few_rows_per_partition:
        df = df.repartition(spread(df.sparkSession), *keys)
    elif keys:
        df = df.hint("rebalance", *keys)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if keys:
        writer = writer.partitionBy(*partition_by)
        mode = "dynamic" if only_touched_partitions else "static"
        writer = writer.option("partitionOverwriteMode", mode)
    writer.parquet(path)


def write_output(
    df: DataFrame,
    root: str,
    name: str,
    year: int | None = None,
    only_touched_partitions: bool = False,
) -> str:
    """Write one of `schema.TABLES` or `schema.STATE`, in its declared types, to {root}/[{year}/]{name}.

    Returns the path.
    """
    path = f"{root}/{name}" if year is None else f"{root}/{year}/{name}"
    spec = spec_of(name)
    write_parquet(
        typed(df, name), path, spec.partition_by, spec.few_rows_per_partition, only_touched_partitions
    )
    return path


def typed(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a table in their declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in spec_of(name).schema.fields])


def read_output(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a table of `schema.TABLES` or `schema.STATE` back in its declared types."""
    return spark.read.schema(spec_of(name).schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line in each file."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_json_report(report: DataFrame, path: str) -> None:
    """A report of a few rows as one JSON text file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_benchmark_report(
    spark: SparkSession, rows: Iterable[tuple[str, float, str]], root: str
) -> str:
    path = f"{root}/benchmark_report"
    write_parquet(benchmark_rows(spark, rows), path)
    return path


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows for display, returned rather than printed."""
    return df.limit(rows)


def output_manifest(spark: SparkSession, root: str, depth: int = 1) -> DataFrame:
    """Data files and bytes of every table below `root`.

    A table is the first `depth` folders below the root: 1 for {root}/{table}, 2 for
    {root}/{year}/{table}. Lists file metadata only: the content column is never read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "[!_.]*")
        .load(root)
        .select("path", "length")
    )
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # as the reader lists it: with scheme, unescaped
    prefix = system.makeQualified(folder).toString()
    below = F.substring(F.col("path"), len(prefix) + 2, 1 << 30)
    return (
        files.withColumn("table_name", F.substring_index(below, "/", depth))
        .groupBy("table_name")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .orderBy("table_name")
    )
