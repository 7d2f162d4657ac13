"""Sizes of broadcasts and of fixed spreads."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 16 << 20
MAX_MEASURED_ROWS = 100_000
UNKNOWN = 1 << 62

log = logging.getLogger(__name__)


def estimated_bytes(df: DataFrame) -> int:
    """Size by the statistics of the optimized plan, without a job. Where there are none
    (rows given from Python) the rows are measured, MAX_MEASURED_ROWS of them at most; one
    row more counts as unknown, which is beyond any limit."""
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known < UNKNOWN:
        return known
    text = F.length(F.to_json(F.struct("*")))
    found = df.limit(MAX_MEASURED_ROWS + 1).agg(F.count("*").alias("rows"), F.sum(text).alias("bytes"))
    row = found.first()
    return (row["bytes"] or 0) if row["rows"] <= MAX_MEASURED_ROWS else UNKNOWN


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of all inputs below `df`, by the statistics of its plan and without a job; the share of a file
    scan that its columns take of the stored ones. UNKNOWN if an input has none."""
    found, todo = 0, [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        plan = todo.pop()
        below = plan.children()
        if below.isEmpty():
            found += int(str(plan.stats().sizeInBytes()))
        elif below.size() == 1 and below.apply(0).children().isEmpty():
            # a projection or filter right above its input: its size follows the columns it needs
            found += min(int(str(p.stats().sizeInBytes())) for p in (plan, below.apply(0)))
        else:
            todo += [below.apply(k) for k in range(below.size())]
    return min(found, UNKNOWN)


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a dimension of at most `max_bytes`, `df` itself otherwise.

    Without the hint Catalyst and AQE choose by estimated and measured size, so
    a larger dimension becomes a sort-merge join whose hot keys AQE splits.
    """
    size = estimated_bytes(df)
    if size <= max_bytes:
        return F.broadcast(df)
    log.warning("no broadcast: %d bytes estimated, %d allowed", size, max_bytes)
    return df


def spread(spark: SparkSession) -> int:
    """Tasks for a shuffle that adaptive execution must not merge: all cores get work."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, spark.sparkContext.defaultParallelism)
