"""Statistics of stored Parquet files, from their footers alone."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession

ROW_GROUPS = (
    "file string, file_bytes long, row_group int, column string, rows long, bytes long, nulls long,"
    " minimum string, maximum string, bloom_filter boolean"
)


def open_file(address: str):
    """A file by its address, as Spark lists it; pyarrow's stores (file, hdfs, s3, gs)."""
    if address.startswith("file:") or "://" not in address:
        return pyarrow.fs.LocalFileSystem().open_input_file("/" + address.removeprefix("file:").lstrip("/"))
    store, path = pyarrow.fs.FileSystem.from_uri(address.replace("s3a://", "s3://", 1))
    return store.open_input_file(path)


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, row group and column: rows, compressed bytes of the column, nulls,
    minimum and maximum as text.

    Spark lists the files and deals them to the tasks; a task reads a footer at a time and no
    data. Columns of nested types have a row for each leaf, named by its path.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for address, length in zip(batch["path"], batch["length"]):
                with open_file(address) as file:
                    footer = pyarrow.parquet.ParquetFile(file).metadata
                rows = []
                for number in range(footer.num_row_groups):
                    group = footer.row_group(number)
                    for k in range(group.num_columns):
                        part = group.column(k)
                        known = part.statistics if part.is_stats_set else None
                        ends = (known.min, known.max) if known is not None and known.has_min_max else (None, None)
                        nulls = known.null_count if known is not None and known.has_null_count else None
                        texts = [None if x is None else str(x) for x in ends]
                        bloom = getattr(part, "bloom_filter_offset", None)
                        rows.append(
                            (address, length, number, part.path_in_schema, group.num_rows, part.total_compressed_size, nulls, *texts, bloom and bloom > 0)
                        )
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in ROW_GROUPS.split(",")]).astype({"nulls": "Int64", "bloom_filter": "boolean"})

    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "[!_.]*.parquet")
        .load(path)
        .select("path", "length")
    )
    return files.mapInPandas(read, ROW_GROUPS)
