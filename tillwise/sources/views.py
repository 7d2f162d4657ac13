"""The transaction fact built from the star-schema tables (lineitem, orders, ...) and
from the event table, in the column names of `schema.FACT`.

A star-schema transaction is one lineitem; the other tables only look attributes
up by their primary key. So each view joins just the tables whose attributes the
caller asks for: a left lookup on a unique key neither adds nor drops rows, and
skipping an unused one leaves the result as it is. Orders are enriched at order
grain before they meet the much larger lineitem side, and nothing is hinted:
the dimensions grow with the data, so Catalyst and AQE pick broadcast or
sort-merge by measured size and split hot keys.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import expr

from tillwise.domains import APPROVED, CANCELLED, CREDIT, DEBIT, DECLINED

APPROVED_CODE = "F"
STATUS_OF_CODE = {APPROVED_CODE: APPROVED, "O": DECLINED, "P": CANCELLED}
CANCELLED_EVENT = "error"
INSTALLMENT_BY_LINE = {5: 3, 6: 6, 7: 12}


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """An input table, in the schema its files have now."""
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def cents(column: str) -> str:
    """Money as whole cents, so that sums are exact in any order.

    The value has two decimals, so only the noise of the multiplication is removed;
    `rint` does that in one instruction where `round` goes through a BigDecimal.
    """
    return f"cast(rint({column} * 100) as bigint)"


def mask_card(key: str) -> str:
    return f"concat('****-****-****-', cast(1000 + {key} % 9000 as string))"


def _case(column: str, values: dict, default: str = "") -> str:
    branches = " ".join(f"when {key!r} then {value!r}" for key, value in values.items())
    return f"case {column} {branches} {default} end"


TRANSACTION_ID = (
    "concat('TXN', lpad(cast(l_orderkey * 10 + l_linenumber as string), 10, '0'))"
)
FROM_LINEITEM = {
    "transaction_id": TRANSACTION_ID,
    "card_type": "l_linestatus",
    "amount": cents("l_extendedprice"),
    "installment_months": _case("l_linenumber", INSTALLMENT_BY_LINE, "else 0"),
}
FROM_ORDERS = {
    "transaction_ts": "o_orderdate",
    "card_no": mask_card("o_custkey"),
    "approval_status": _case("o_orderstatus", STATUS_OF_CODE),
    "region": "r_name",
}
FROM_PART = {"category": "p_type", "sub_category": "p_brand"}
FROM_SUPPLIER = {"merchant": "s_name"}
TXN_COLUMNS = (*FROM_LINEITEM, *FROM_ORDERS, *FROM_PART, *FROM_SUPPLIER)
#: Texts that are made after the joins, of numbers: these are lighter to shuffle.
MADE_LATE = {"transaction_id": "l_linenumber", "card_no": "o_custkey"}


def _picked(source: dict[str, str], wanted: set[str]) -> list[str]:
    return [MADE_LATE.get(name, f"{text} as {name}") for name, text in source.items() if name in wanted]


def _enriched_orders(
    spark: SparkSession, data_dir: str, wanted: set[str], approved_only: bool
) -> DataFrame:
    orders = table(spark, data_dir, "orders")
    if approved_only:
        # on the stored code, so that the Parquet reader can skip by it
        orders = orders.filter(f"o_orderstatus = '{APPROVED_CODE}'")
    if "region" in wanted:
        home = (
            table(spark, data_dir, "customer")
            .join(table(spark, data_dir, "nation"), expr("c_nationkey = n_nationkey"), "left")
            .join(table(spark, data_dir, "region"), expr("n_regionkey = r_regionkey"), "left")
            .select("c_custkey", "r_name")
        )
        orders = orders.join(home, expr("o_custkey = c_custkey"), "left")
    return orders.selectExpr("o_orderkey", *_picked(FROM_ORDERS, wanted))


def _joined_lines(
    spark: SparkSession,
    data_dir: str,
    line_columns: Iterable[str],
    wanted: set[str],
    approved_only: bool = False,
) -> DataFrame:
    """Lineitem with `line_columns` and the looked-up columns named in `wanted`."""
    lines = table(spark, data_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", *line_columns
    )
    if approved_only or wanted & set(FROM_ORDERS):
        orders = _enriched_orders(spark, data_dir, wanted, approved_only)
        how = "inner" if approved_only else "left"
        lines = lines.join(orders, expr("l_orderkey = o_orderkey"), how)
    if wanted & set(FROM_PART):
        part = table(spark, data_dir, "part").selectExpr("p_partkey", *_picked(FROM_PART, wanted))
        lines = lines.join(part, expr("l_partkey = p_partkey"), "left")
    if wanted & set(FROM_SUPPLIER):
        supplier = table(spark, data_dir, "supplier").selectExpr(
            "s_suppkey", *_picked(FROM_SUPPLIER, wanted)
        )
        lines = lines.join(supplier, expr("l_suppkey = s_suppkey"), "left")
    return lines


def transactions(
    spark: SparkSession,
    data_dir: str,
    columns: Iterable[str] = TXN_COLUMNS,
    approved_only: bool = False,
) -> DataFrame:
    """Transactions with the given columns, joining only the tables these need."""
    columns = list(columns)
    unknown = set(columns) - set(TXN_COLUMNS)
    if unknown:
        raise ValueError(f"unknown transaction columns: {sorted(unknown)}")
    wanted = set(columns)
    line_columns = _picked(FROM_LINEITEM, wanted)
    joined = _joined_lines(spark, data_dir, line_columns, wanted, approved_only)
    late = {**FROM_LINEITEM, **FROM_ORDERS}
    return joined.selectExpr(*[f"{late[name]} as {name}" if name in MADE_LATE else name for name in columns])


def events(spark: SparkSession, data_dir: str, approved_only: bool = False) -> DataFrame:
    """The event table as transactions with hour-level times; errors count as cancelled."""
    stored = table(spark, data_dir, "events")
    if approved_only:
        # on the stored code, so that the Parquet reader can skip by it
        stored = stored.filter(f"event_type is null or event_type <> '{CANCELLED_EVENT}'")
    return stored.selectExpr(
        "cast(event_id as string) as transaction_id",
        "ts as transaction_ts",
        "cast(user_id as string) as card_no",
        f"if(user_id % 2 = 0, '{CREDIT}', '{DEBIT}') as card_type",
        "event_type as category",
        f"{cents('value')} as amount",
        f"if(event_type = '{CANCELLED_EVENT}', '{CANCELLED}', '{APPROVED}') as approval_status",
    )


def _damaged(expression: str, *damage: tuple[int, str]) -> str:
    """`expression`, replaced on the order keys divisible by a step; the first match wins."""
    branches = " ".join(f"when l_orderkey % {step} = 0 then {value}" for step, value in damage)
    return f"case {branches} else {expression} end"


DIRTY = {
    "transaction_id": _damaged(TRANSACTION_ID, (991, "null")),
    "transaction_date": _damaged(
        "cast(transaction_ts as string)",
        (103, "'1998-13-45 00:00:00'"),
        (113, "'2099-01-01 00:00:00'"),
    ),
    "card_no": _damaged(mask_card("l_suppkey"), (107, "'1234-5678-9012-3456'"), (109, "null")),
    "card_type": _damaged("l_linestatus", (137, "'X'")),
    "merchant": _damaged("merchant", (151, "null")),
    "sub_category": _damaged("sub_category", (157, "''")),
    "category": _damaged("category", (97, "null"), (89, "''"), (83, "'null'"), (79, "'UNKNOWN'")),
    "amount_raw": _damaged(
        f"cast({cents('l_extendedprice')} as string)",
        (101, "'-500'"),
        (127, "'0'"),
        (131, "'abc'"),
        (167, "'3000000000'"),
    ),
    "installment_raw": _damaged(
        f"cast({FROM_LINEITEM['installment_months']} as string)", (163, "'x'")
    ),
    "approval_status": _damaged("approval_status", (139, "'unknown'")),
    "region": _damaged("region", (149, "'ATLANTIS'")),
}


def dirty_transactions(
    spark: SparkSession, data_dir: str, columns: Iterable[str] = tuple(DIRTY)
) -> DataFrame:
    """All transactions as raw text, with known damage spread over them by order key.

    Feeds the quality suite: no row is left out, some have broken values.
    `amount_raw` and `installment_raw` are text; see `cast_numbers`.
    """
    columns = list(columns)
    looked_up = {"transaction_ts" if c == "transaction_date" else c for c in columns}
    looked_up -= {"card_no"}  # of the supplier here, by a key lineitem has
    lines = _joined_lines(
        spark, data_dir, ["l_linenumber", "l_linestatus", "l_extendedprice"], looked_up
    )
    return lines.selectExpr(*[f"{DIRTY[name]} as {name}" for name in columns])


def merchant_master(spark: SparkSession, data_dir: str) -> DataFrame:
    """Merchants in good standing: suppliers whose balance is not negative."""
    return (
        table(spark, data_dir, "supplier")
        .filter("s_acctbal >= 0")
        .selectExpr("s_name as merchant")
    )
