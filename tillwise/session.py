"""Session factory: one place for the settings every job relies on."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

from tillwise.functions.sizing import UNKNOWN, scanned_bytes

BASE_CONF = {
    # implicit timestamp casts must not move a transaction to another day
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # columns are pruned, so a task reads a fraction of its split
    "spark.sql.files.maxPartitionBytes": "256m",
    # split a hot join key even where that costs one more exchange above the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def conf_for_cores(cores: int) -> dict[str, str]:
    """Settings that follow the size of the cluster."""
    return {
        # start wide, let adaptive execution merge what turns out small
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(8 * cores),
        # listing tasks for tables of many directories; the default starts one per directory
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * cores),
    }


def most_cores(conf: SparkConf, now: int) -> int:
    """Cores the application may come to have: with dynamic allocation those of all
    executors it may ask for, not of those it has when it starts."""
    if conf.get("spark.dynamicAllocation.enabled", "false") != "true":
        return now
    executors = int(conf.get("spark.dynamicAllocation.maxExecutors", "0"))
    return max(now, executors * int(conf.get("spark.executor.cores", "1")))


#: Bytes of a shuffle partition that wide tables start with; adaptive execution merges smaller ones.
SHUFFLE_BYTES = 128 << 20
_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_OURS = "tillwise.shuffleWidth"


def size_shuffles(spark: SparkSession, *inputs: DataFrame) -> int:
    """Start shuffles wide enough for these inputs: SHUFFLE_BYTES in a partition if all that their scans
    read were shuffled, and never fewer than `get_session` chose by the cores.

    Cores say little where executors come and go (dynamic allocation without an upper
    bound begins with one or two), the bytes to read are known from the scans without a job.
    A width set at submit or by the user stays. Returns the width.
    """
    width = int(spark.conf.get(_WIDTH, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.conf.get(_OURS, None) == str(width):
        known = [n for n in map(scanned_bytes, inputs) if n < UNKNOWN]
        wanted = max(width, -(-sum(known) // SHUFFLE_BYTES))
        spark.conf.set(_WIDTH, str(wanted))
        spark.conf.set(_OURS, str(wanted))
        return wanted
    return width


def is_object_store(path: str) -> bool:
    return path.startswith(("s3://", "s3a://", "s3n://"))


def object_store_conf(env: dict[str, str] | None = None) -> dict[str, str]:
    """S3A settings from the standard environment variables.

    Keys that are not set are left to the default credential chain, and the
    endpoint is only overridden (with path-style access) when one is named.
    """
    env = os.environ if env is None else env
    conf = {"spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    endpoint = env.get("S3_ENDPOINT")
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
        conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
        conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(
            endpoint.startswith("https")
        ).lower()
    if env.get("AWS_ACCESS_KEY_ID") and env.get("AWS_SECRET_ACCESS_KEY"):
        conf["spark.hadoop.fs.s3a.access.key"] = env["AWS_ACCESS_KEY_ID"]
        conf["spark.hadoop.fs.s3a.secret.key"] = env["AWS_SECRET_ACCESS_KEY"]
    return conf


def get_session(
    app_name: str = "tillwise",
    path: str | Iterable[str] = "",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session tuned for these jobs; S3A is configured when one of the paths, or the
    folder in `spark.checkpoint.dir`, needs it.

    Master and resources come from spark-submit. `conf` overrides the settings here, and
    so does whatever was set at submit or in the session already.
    """
    submitted, chosen = SparkConf(), conf or {}
    settings = dict(chosen)
    shared = chosen.get("spark.checkpoint.dir") or submitted.get("spark.checkpoint.dir", "")
    paths = [path] if isinstance(path, str) else list(path)
    if any(is_object_store(p) for p in [*paths, shared] if p):
        for key, value in object_store_conf().items():
            if not submitted.contains(key):
                settings.setdefault(key, value)
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    context = spark.sparkContext
    set_already = {**dict(context.getConf().getAll()), **spark.conf.getAll, **chosen}
    cores = most_cores(context.getConf(), context.defaultParallelism)
    for key, value in {**BASE_CONF, **conf_for_cores(cores)}.items():
        if key not in set_already:
            spark.conf.set(key, value)
            if key == _WIDTH:
                spark.conf.set(_OURS, value)
    context.setLogLevel("WARN")
    return spark
