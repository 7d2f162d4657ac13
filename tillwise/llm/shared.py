"""What several operators need: word counts, checkpoints, joins with a checked small side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.sinks.scratch import shared_dir

#: Words are runs of anything but the space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"

#: A side of a join is broadcast only if it was counted and has no more rows than this.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_text(doc_id: Column) -> Column:
    """The id as text; a null id counts as the empty string."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`: the fold of a document."""
    return F.crc32(F.encode(id_text(doc_id), "UTF-8")) % modulus


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder, its lineage cut."""
    use_shared_checkpoints(df.sparkSession)
    return df.checkpoint()


def use_shared_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def with_hint(df: DataFrame, rows: int = BROADCAST_ROWS, blob: str | None = None) -> DataFrame:
    """`df` with a broadcast hint if it has at most `rows` rows and, in its column `blob`,
    at most BROADCAST_BYTES; else as it is.

    Reads `df`, so give it something checkpointed. Without the hint Spark
    shuffles both sides and splits hot keys.
    """
    size = F.sum(F.length(blob)) if blob else F.lit(0)
    found = df.agg(F.count(F.lit(1)).alias("rows"), size.alias("bytes")).head()
    return F.broadcast(df) if found["rows"] <= rows and (found["bytes"] or 0) <= BROADCAST_BYTES else df


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until no column of `df` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
