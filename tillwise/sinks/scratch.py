"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a local session without that setting
    uses its warehouse.

    On a cluster the setting is required, since no machine-local folder is visible
    to the executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


_owned: list[list[str]] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/tillwise/{name}-{uuid.uuid4().hex}"
    if _owned:
        _owned[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was written to fresh paths meanwhile. Frames that read it are
    of no use afterwards, so a job that returns one collects its few rows first."""
    shared_dir(spark)  # fail now rather than after the first tables have been written
    _owned.append([])
    try:
        yield
    finally:
        for path in _owned.pop():
            remove(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and go on from the written table.

    Later steps neither recompute what is above nor depend on executors that
    held it, and Catalyst sees the true size of the result.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
