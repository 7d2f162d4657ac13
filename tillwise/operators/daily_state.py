"""Partial results by day that can be added up: the state of incremental runs.

Totals are kept at several grains, all made in one pass with grouping sets. Distinct counts
cannot be added, so the state keeps the sets themselves: cards and merchants have numbers, and a
set of them is a bitmap for each 32,768 numbers. Bitmaps of days are combined with OR,
which makes the count of a month or a quarter exact. Where groups are many and small
(merchants), a bitmap would be mostly empty, so the distinct (merchant, card) pairs of a day
are kept instead.

Every summary of `operators.summaries` and the quarterly ones below come from this state
alone: the same rows, types and columns as from the transactions.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.domains import REST_SLOT, TIME_SLOTS
from tillwise.functions.calendar_cols import quarter_label, time_slot
from tillwise.functions.measures import growth, total, txn_count
from tillwise.operators.declared import status_counts

DAY = ("txn_year", "txn_month", "txn_date")
KEYS = ("category", "txn_hour", "region", "merchant", "sub_category")
GRAINS = {
    "category": ("category",),
    "hour": ("txn_hour",),
    "region": ("region", "category"),
    "merchant": ("merchant", "category", "sub_category"),
    "day": (),
}
#: Grains whose members are kept as bitmaps.
BITMAP_GRAINS = ("category", "hour", "region", "day")
MEASURES = ("txn_count", "row_count", "total_amount", "amount_count", "no_card", "no_merchant")


def _complete(df: DataFrame) -> DataFrame:
    """With a NULL for each key column that `df` has not."""
    kinds = {**dict.fromkeys((*KEYS, "card_no"), "string"), "txn_hour": "int"}
    return df.withColumns({n: F.lit(None).cast(k) for n, k in kinds.items() if n not in df.columns})


def _by_grain(df: DataFrame, grains: Iterable[str], more: tuple[str, ...], *measures: Column) -> DataFrame:
    """`df` aggregated by day once for each grain, in one pass: grain, all KEYS, `more`, measures."""
    grains = list(grains)
    keys = [k for k in KEYS if any(k in GRAINS[g] for g in grains)]
    columns = [*DAY, *keys, *more]
    sets = {g: [*DAY, *GRAINS[g], *more] for g in grains}
    # grouping_id() has a bit for each column, set where the set leaves it out
    ids = {sum(1 << len(columns) - 1 - i for i, c in enumerate(columns) if c not in s): g for g, s in sets.items()}
    label = reduce(lambda known, i: known.when(F.col("_set") == i, ids[i]), ids, F.when(F.lit(False), ""))
    found = df.groupingSets(list(sets.values()), *columns).agg(F.grouping_id().alias("_set"), *measures)
    missing = {k: F.lit(None).cast("int" if k == "txn_hour" else "string") for k in KEYS if k not in keys}
    return found.withColumns({"grain": label, **missing}).drop("_set")


def daily_totals(df: DataFrame, grains: Iterable[str] = GRAINS) -> DataFrame:
    """Sums of approved transactions by day at each grain."""
    return _by_grain(
        _complete(df),
        grains,
        (),
        txn_count(),
        F.count("*").alias("row_count"),
        total(),
        F.count("amount").alias("amount_count"),
        F.max("amount").alias("max_amount"),
        F.min("amount").alias("min_amount"),
        F.count_if(F.col("card_no").isNull()).alias("no_card"),
        F.count_if(F.col("merchant").isNull()).alias("no_merchant"),
    )


def members_to_number(df: DataFrame, members: Iterable[str] = ("card", "merchant")) -> DataFrame:
    """The (member, value) pairs that `daily_members` needs numbers for; `daily_merchant_cards` and
    grains other than the day need the cards only."""
    df = _complete(df)
    columns = {"card": "card_no", "merchant": "merchant"}
    parts = [df.select(F.lit(m).alias("member"), F.col(columns[m]).alias("value")) for m in members]
    return reduce(DataFrame.unionAll, parts).where("value IS NOT NULL").distinct()


def _numbered(df: DataFrame, numbers: DataFrame, member: str, column: str, *keys: str) -> DataFrame:
    """Distinct (day, keys, number); distinct first, so that a frequent card meets the numbers once a group."""
    mine = numbers.where(F.col("member") == member).select(F.col("value").alias("_value"), "number")
    pairs = df.where(F.col(column).isNotNull()).select(*DAY, *keys, F.col(column).alias("_value")).distinct()
    return pairs.join(mine, "_value").drop("_value")


def daily_members(df: DataFrame, numbers: DataFrame, grains: Iterable[str] = BITMAP_GRAINS) -> DataFrame:
    """Bitmaps of the cards by day at each grain, and of the merchants by day."""
    df, grains = _complete(df), [g for g in grains if g in BITMAP_GRAINS]
    keys = [k for k in KEYS if any(k in GRAINS[g] for g in grains)]

    def bitmaps(numbered: DataFrame, grains: list[str], member: str) -> DataFrame:
        placed = numbered.withColumns(
            {"bucket": F.bitmap_bucket_number("number"), "_position": F.bitmap_bit_position("number")}
        )
        bits = F.bitmap_construct_agg("_position").alias("bits")
        return _by_grain(placed, grains, ("bucket",), bits).withColumn("member", F.lit(member))

    found = bitmaps(_numbered(df, numbers, "card", "card_no", *keys), grains, "card")
    if "day" in grains:
        found = found.unionByName(bitmaps(_numbered(df, numbers, "merchant", "merchant"), ["day"], "merchant"))
    return found


def daily_merchant_cards(df: DataFrame, numbers: DataFrame) -> DataFrame:
    """Distinct cards by day and merchant."""
    found = _numbered(_complete(df), numbers, "card", "card_no", *GRAINS["merchant"])
    return found.withColumnRenamed("number", "card")


def daily_status_counts(df: DataFrame) -> DataFrame:
    """Counts over ALL statuses by day, hour and category."""
    day = F.col("txn_date").cast("date")
    return status_counts(df).withColumns({"txn_year": F.year(day), "txn_month": F.month(day)})


# --- from the state to the summaries ------------------------------------------


def _members(members: DataFrame, grain: str, member: str, keys: list[str]) -> DataFrame:
    """keys and the exact number of distinct members, from bitmaps combined over the days."""
    mine = members.where((F.col("grain") == grain) & (F.col("member") == member))
    return (
        mine.groupBy(*keys, "bucket")
        .agg(F.bitmap_or_agg("bits").alias("bits"))
        .groupBy(*keys)
        .agg(F.sum(F.bitmap_count("bits")).alias("found"))
    )


def _summed(totals: DataFrame, grain: str, keys: list[str]) -> DataFrame:
    extremes = [F.max("max_amount").alias("max_amount"), F.min("min_amount").alias("min_amount")]
    extremes += [F.min("txn_date").alias("min_date"), F.max("txn_date").alias("max_date")]
    sums = [F.sum(c).alias(c) for c in MEASURES]
    return totals.where(F.col("grain") == grain).groupBy(*keys).agg(*sums, *extremes)


def _together(summed: DataFrame, counted: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Sums and distinct counts of the same keys in one row. Keys may be NULL, so the parts are
    stacked and folded rather than joined."""
    values = [c for c in summed.columns if c not in keys]
    empty = {c: F.lit(None).cast(summed.schema[c].dataType) for c in values}
    unknown = {name: F.lit(None).cast("bigint") for name in counted}
    parts = [summed.select(*keys, *values, *[unknown[n].alias(n) for n in counted])]
    for name, part in counted.items():
        more = [(F.col("found") if n == name else unknown[n]).alias(n) for n in counted]
        parts.append(part.select(*keys, *[empty[c].alias(c) for c in values], *more))
    folded = reduce(DataFrame.unionAll, parts).groupBy(*keys).agg(*[F.max(c).alias(c) for c in (*values, *counted)])
    return folded.fillna(0, list(counted))


def _mean(name: str) -> Column:
    return F.round(F.try_divide("total_amount", "amount_count"), 0).alias(name)


def _standard(totals: DataFrame, members: DataFrame, grain: str, keys: list[str], **more: str) -> DataFrame:
    counted = {"unique_cards": _members(members, grain, "card", keys)}
    counted |= {name: _members(members, grain, member, keys) for name, member in more.items()}
    return _together(_summed(totals, grain, keys), counted, keys)


STANDARD = ("txn_count", "total_amount")


def daily_category_summary(totals: DataFrame, members: DataFrame) -> DataFrame:
    keys = ["txn_date", "category"]
    found = _standard(totals, members, "category", keys)
    return found.select(*keys, *STANDARD, _mean("avg_amount"), "unique_cards", "max_amount", "min_amount").orderBy(*keys)


def hourly_pattern(
    totals: DataFrame,
    members: DataFrame,
    slots: tuple[tuple[str, int, int], ...] = TIME_SLOTS,
    rest: str = REST_SLOT,
) -> DataFrame:
    found = _standard(totals, members, "hour", ["txn_hour"])
    slot = time_slot("txn_hour", slots, rest).alias("time_slot")
    return found.select("txn_hour", *STANDARD, _mean("avg_amount"), "unique_cards", slot).orderBy("txn_hour")


def regional_analysis(totals: DataFrame, members: DataFrame) -> DataFrame:
    keys = ["region", "category"]
    found = _standard(totals, members, "region", keys)
    return found.select(*keys, *STANDARD, _mean("avg_amount"), "unique_cards").orderBy("region", F.desc("total_amount"))


def monthly_trend(totals: DataFrame, members: DataFrame) -> DataFrame:
    keys = ["txn_year", "txn_month"]
    found = _standard(totals, members, "day", keys, unique_merchants="merchant")
    return found.select(*keys, *STANDARD, _mean("avg_amount"), "unique_cards", "unique_merchants").orderBy(*keys)


def monthly_mom_growth(totals: DataFrame, members: DataFrame) -> DataFrame:
    """By yyyy-MM, with growth over the previous month that has data."""
    in_order = Window.orderBy("txn_year", "txn_month")  # one row per calendar month
    grown = growth("total_amount", F.lag("total_amount").over(in_order)).alias("mom_growth_rate")
    month = F.format_string("%04d-%02d", "txn_year", "txn_month").alias("txn_month")
    found = monthly_trend(totals, members)
    return found.select(
        month, *STANDARD, "avg_amount", grown, "unique_cards", "unique_merchants"
    ).orderBy("txn_month")


def merchant_ranking(totals: DataFrame, pairs: DataFrame) -> DataFrame:
    keys = list(GRAINS["merchant"])
    cards = pairs.select(*keys, "card").distinct().groupBy(*keys).agg(F.count("card").alias("found"))
    found = _together(_summed(totals, "merchant", keys), {"unique_customers": cards}, keys)
    return found.select(
        *keys,
        "txn_count",
        "unique_customers",
        F.col("total_amount").alias("total_revenue"),
        _mean("avg_transaction"),
        F.round(F.col("total_amount") / 10000, 1).alias("revenue_rank"),
    ).orderBy(F.desc("total_revenue"))


def etl_report(totals: DataFrame, members: DataFrame) -> DataFrame:
    """One row over everything; a NULL card or merchant counts as one more."""
    found = _standard(totals, members, "day", [], unique_merchants="merchant")
    with_null = lambda name, gap: (F.col(name) + (F.col(gap) > 0).cast("bigint")).alias(name)
    return found.select(
        F.coalesce("row_count", F.lit(0)).alias("txn_count"),
        "total_amount",
        F.coalesce(with_null("unique_cards", "no_card"), F.lit(0)).alias("unique_cards"),
        F.coalesce(with_null("unique_merchants", "no_merchant"), F.lit(0)).alias("unique_merchants"),
        "min_date",
        "max_date",
    )


def _of_year(df: DataFrame, year: int) -> DataFrame:
    """One year's folders, with the quarter of each row."""
    quarter = F.ceil(F.col("txn_month") / 3).cast("int")
    return df.where(F.col("txn_year") == year).withColumn("txn_quarter", quarter)


def quarterly_category_summary(totals: DataFrame, members: DataFrame, year: int) -> DataFrame:
    keys = ["txn_quarter", "category"]
    found = _standard(_of_year(totals, year), _of_year(members, year), "category", keys)
    label = quarter_label("txn_quarter").alias("quarter_label")
    return found.select(
        "txn_quarter", label, "category", *STANDARD, _mean("avg_amount"), "unique_cards"
    ).orderBy("txn_quarter", F.desc("total_amount"))


def quarterly_region(totals: DataFrame, year: int) -> DataFrame:
    found = _summed(_of_year(totals, year), "region", ["txn_quarter", "region"])
    label = quarter_label("txn_quarter").alias("quarter_label")
    return found.select("txn_quarter", label, "region", *STANDARD).orderBy("txn_quarter", F.desc("total_amount"))


def qoq_growth(totals: DataFrame, members: DataFrame, year: int) -> DataFrame:
    """Each quarter with its growth over the previous quarter of the year that has data."""
    in_order = Window.orderBy("txn_quarter")  # four rows
    found = _standard(_of_year(totals, year), _of_year(members, year), "day", ["txn_quarter"])
    return found.select(
        "txn_quarter",
        quarter_label("txn_quarter").alias("quarter_label"),
        *STANDARD,
        "unique_cards",
        F.lag("total_amount").over(in_order).alias("prev_amount"),
        F.lag("txn_count").over(in_order).alias("prev_count"),
    ).select(
        "*",
        growth("total_amount", "prev_amount").alias("amount_growth_rate"),
        growth("txn_count", "prev_count").alias("count_growth_rate"),
    ).orderBy("txn_quarter")


