"""Joins of the fact with small reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.sizing import broadcast_if_small

SALTS = 16


def with_category_master(df: DataFrame, master: DataFrame, strategy: str = "auto") -> DataFrame:
    """Left join on `category`; a category the master lacks gets NULLs.

    strategy "auto" leaves the choice to Catalyst and AQE, "broadcast" hints it for
    a master measured to be small, "merge" forces the sort-merge join. That one is
    salted: every category of the master is repeated SALTS times and the fact's rows
    take turns, so that a hot category is spread over SALTS tasks.
    """
    if strategy == "broadcast":
        master = broadcast_if_small(master)
    elif strategy == "merge":
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = master.withColumn("_salt", salts).hint("merge")
        turn = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
        return df.withColumn("_salt", turn).join(salted, ["category", "_salt"], "left").drop("_salt")
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy: {strategy}")
    return df.join(master, "category", "left")


def unknown_merchants(df: DataFrame, master: DataFrame) -> DataFrame:
    """Merchants that are not in the master, with their rows and amount.

    Folded to one row per merchant first: the anti join then moves merchants, not
    transactions, and a merchant with most of the transactions is one row.
    """
    merchants = df.groupBy("merchant").agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("total_amount")
    )
    return merchants.join(master.select("merchant"), "merchant", "left_anti")


def outside_amount_range(df: DataFrame, ranges: DataFrame, tolerance: int = 0) -> DataFrame:
    """Rows of each category whose amount is more than `tolerance` outside its range.

    Categories without a range are not judged.
    """
    amount, slack = F.col("amount"), F.lit(tolerance)
    below = amount < F.col("min_amount") - slack
    above = amount > F.col("max_amount") + slack
    return (
        df.join(broadcast_if_small(ranges), "category")
        .filter(below | above)
        .groupBy("category")
        .agg(F.count_if(below).alias("below_count"), F.count_if(above).alias("above_count"))
    )
